"""DuckDB twins of the queries that SQL can express.

Written from the contracts of the queries, not from their plans.  Rules that are
this library's choice (template, line rules, sampling key) are stated again here.
"""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP1 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), escaped AS (
  SELECT *,
    replace(regexp_replace(role, '<(\\*)\|im_(start|end|nl)\|>', '<\\\1|im_\2|>', 'g'), chr(10), '<|im_nl|>') AS safe_role,
    regexp_replace(text, '<(\\*)\|im_(start|end)\|>', '<\\\1|im_\2|>', 'g') AS safe_text
  FROM turns
), joined AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, safe_text) AS listing,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, safe_text) FILTER (role = 'assistant'), '') AS trained,
    string_agg('<|im_start|>' || safe_role || chr(10) || safe_text || '<|im_end|>' || chr(10), '') AS formatted
  FROM escaped GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(listing) AS turns_sha256, length(trained) AS loss_chars,
  sha256(trained) AS loss_sha256, length(formatted) AS formatted_chars, true AS identical
FROM joined
"""

_OP2 = f"""
WITH listed AS (SELECT doc_id, {WORDS} AS words FROM documents),
starts AS (
  SELECT doc_id, unnest(range(1, len(words) - 48)) AS start, words FROM listed WHERE len(words) >= 50
), hashed AS (
  SELECT doc_id, start, md5(array_to_string(words[start:start + 49], ' ')) AS h FROM starts
), gone AS (
  SELECT doc_id, start FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS lowest FROM hashed) WHERE lowest < doc_id
), placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM listed
), judged AS (
  SELECT p.doc_id, word, place,
    coalesce(max(start) OVER (PARTITION BY p.doc_id ORDER BY place ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) > 0 AS covered
  FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.start
), kept AS (
  SELECT doc_id, count(*) FILTER (covered) AS n_removed,
    string_agg(word, ' ' ORDER BY place) FILTER (NOT covered) AS text
  FROM judged GROUP BY doc_id
)
SELECT l.doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM listed l LEFT JOIN kept k USING (doc_id)
"""

_OP4 = r"""
WITH listed AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 6)) AS start, words FROM listed WHERE len(words) >= 8
), hashed AS (
  SELECT doc_id, start, md5(array_to_string(words[start:start + 7], ' ')) AS h FROM windows
), repeated AS (
  SELECT doc_id, start FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, h) AS n FROM hashed) WHERE n > 1
), covered AS (
  SELECT doc_id, sum(gap) AS n_repeat_words FROM (
    SELECT doc_id, least(8, coalesce(lead(start) OVER (PARTITION BY doc_id ORDER BY start) - start, 8)) AS gap FROM repeated
  ) GROUP BY doc_id
), lines AS (
  SELECT doc_id, trim(line, E' \t\n\x0B\x0C\r') AS line FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM listed)
), measured AS (
  SELECT doc_id, line, lower(line) AS low, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words,
    length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
    length(line) - length(translate(line, '#*$%&|<>!^~=_{}[]@', '')) AS noise,
    length(line) - length(translate(line, '|»«•·›→', '')) AS separators
  FROM lines WHERE line <> ''
), judged AS (
  SELECT doc_id, chars,
    regexp_matches(low, 'all rights reserved|click here|cookie policy|enable javascript|licensed under|privacy policy|released under the|sign up for our newsletter|subscribe to our|terms of service|terms of use|this work is licensed')
    OR len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) >= 0.5 * len(words)
    OR (separators > 0 AND separators * 4 >= len(words))
    OR (len(words) < 12 AND NOT regexp_matches(right(line, 4), '[.!?…:;。！？]["''”’»)\]]*\z'))
    OR noise > 0.1::DOUBLE * chars AS failed
  FROM measured
), lost AS (
  SELECT doc_id, coalesce(sum(chars) FILTER (failed), 0) AS lost_chars, sum(chars) AS word_chars FROM judged GROUP BY doc_id
), figures AS (
  SELECT l.doc_id, len(words) AS n_words, coalesce(o.word_chars, 0) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
    len(list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost_chars, 0) AS lost_chars
  FROM listed l LEFT JOIN covered c USING (doc_id) LEFT JOIN lost o USING (doc_id)
)
SELECT doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 2 * lost_chars <= word_chars AS kept,
  lost_chars::BIGINT AS lost_chars
FROM figures
"""

_OP5 = """
WITH coded AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS code FROM documents),
starts AS (
  SELECT doc_id, code, unnest(range(0, length(code) // 2 - 99)) AS start FROM coded WHERE length(code) >= 200
), hashed AS (
  SELECT doc_id, start, md5(substr(code, 2 * start + 1, 200)) AS h FROM starts
), gone AS (
  SELECT doc_id, start FROM (
    SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, start) AS place FROM hashed) WHERE place > 1
), edges AS (
  SELECT doc_id, start, max(start) OVER (PARTITION BY doc_id ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM gone
), numbered AS (
  SELECT doc_id, start, sum(CASE WHEN before IS NULL OR start > before + 100 THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY start) AS span FROM edges
), spans AS (
  SELECT doc_id, span, min(start) AS a, max(start) + 100 AS b,
    lag(max(start) + 100, 1, 0) OVER (PARTITION BY doc_id ORDER BY span) AS kept_from
  FROM numbered GROUP BY doc_id, span
), cut AS (
  SELECT s.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
    string_agg(substr(code, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY span)
      || substr(any_value(code), 2 * max(b) + 1) AS kept
  FROM spans s JOIN coded c USING (doc_id) GROUP BY s.doc_id
)
SELECT c.doc_id, length(code) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, code))) AS kept_sha256
FROM coded c LEFT JOIN cut USING (doc_id)
"""

_OP6 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE)
      / 4503599627370496::DOUBLE AS u,
    0.05::DOUBLE + 0.95::DOUBLE * ((length(translate(coalesce(text, ''), '#*$%&|<>!0123456789', '')) + 1)
      / (length(coalesce(text, '')) + 1)) AS weight
  FROM documents
), sources AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3::DOUBLE WHEN 1 THEN 1::DOUBLE ELSE 2::DOUBLE END AS w
  FROM sized GROUP BY source
), ranked AS (
  SELECT source, source_size, w, 2 * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS budget, sum(w) OVER () AS all_w,
    coalesce(sum(2 * source_size) OVER before, 0) AS capped, coalesce(sum(w) OVER before, 0) AS gone
  FROM sources
  WINDOW before AS (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT min(CASE WHEN (budget - capped) / (all_w - gone) * w <= cap THEN struct_pack(place := capped, level := (budget - capped) / (all_w - gone)) END) AS l
  FROM ranked
), targets AS (
  SELECT source, source_size, least(cap, coalesce(w * l.level, cap)) AS target FROM ranked, level
), epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 1 END AS epochs FROM targets
), running AS (
  SELECT s.doc_id, s.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY -ln(u) / weight, s.doc_id) - s.size / 2 AS middle
  FROM sized s JOIN epochs e ON s.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (size * (epochs + CASE WHEN rest > 0 AND middle <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM running
"""

_OP9 = """
WITH steps AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM steps q JOIN steps c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
) WHERE rank <= 20
"""

_OP10 = r"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingled AS (
  SELECT DISTINCT doc_id, md5(array_to_string(words[start:start + 4], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS start FROM listed WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingled a JOIN shingled b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * common >= 75 * (s.n + t.n - common)
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), lowest AS (
  SELECT a, min(b) AS low FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
  doc_id <= coalesce(low, doc_id) AS kept
FROM listed LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON a = doc_id
"""


def _crc(number: str) -> str:
    """CRC-32 of the decimal digits of ``number``: eight steps for the byte of each digit."""
    step = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    bytes_ = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}), lambda a, b: {step}), 4294967295)"


_OP11 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, {_crc('conv_id')} % 6 AS h,
    list({{'name': md5(length(role) || ':' || role || text), 'size': length(text)}}
      ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS turns
  FROM turns GROUP BY conv_id
), rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
), prefixes AS (
  SELECT conv_id, d AS depth, list_transform(turns[1:d], lambda t: t.name) AS path, turns[d].size AS size, d = len(turns) AS ends
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(size), 0) AS size,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY path
), family AS (
  SELECT n.*, p.conv_id AS parent_conv_id, coalesce(c.n, 0) AS n_children
  FROM nodes n
  LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
  LEFT JOIN (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL) c ON c.path = n.path
), below AS (
  SELECT path[1:d] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM family) GROUP BY ALL
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM family JOIN below USING (path)
"""

_OP13 = f"""
WITH hashed AS (
  SELECT doc_id, {WORDS} AS w, {_crc('doc_id')} AS h FROM documents
), sized AS (
  SELECT *, len(w) AS n, h // 10 AS g FROM hashed
), planned AS (
  SELECT *, h % 10 = 0 AND n > 0 AS plants, CASE WHEN n > 0 THEN g % n END AS a FROM sized
), listed AS (
  SELECT doc_id, n, CASE WHEN plants THEN list_transform(range(0, n), lambda i:
      w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE w END AS words
  FROM planned
), grams AS (
  -- Words i and i + p are equal for six or more i in a row in every run.
  SELECT doc_id, n, i, words[i + 1:i + 6] AS gram FROM (SELECT doc_id, n, words, unnest(range(0, n - 5)) AS i FROM listed WHERE n >= 12)
), met AS (
  SELECT x.doc_id, x.i, y.i - x.i AS p FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i
  WHERE 2 * (y.i - x.i) <= x.n
), stretches AS (
  SELECT doc_id, p, min(i) AS start, max(i) + 6 - min(i) + p AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM met) GROUP BY doc_id, p, island
), runs AS (
  SELECT doc_id, start, length, min(p) AS period FROM stretches WHERE length >= 2 * p AND length >= 12 GROUP BY doc_id, start, length
), summed AS (
  SELECT doc_id, count(*) AS n_runs, arg_min({{'start': start, 'length': length, 'period': period}}, (-length, start, period)) AS best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listing
  FROM runs GROUP BY doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS place FROM runs
), kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.place) AS text
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(0, n)) AS place FROM listed) p
  LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place
  WHERE g.place IS NULL GROUP BY p.doc_id
)
SELECT l.doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
  1000 * best.length // best.period AS exponent_milli, sha256(coalesce(listing, '')) AS runs_sha256,
  sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM listed l LEFT JOIN summed USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

ORACLE = {
    "op1_chat_format": _OP1,
    "op2_substring_rlz": _OP2,
    "op4_quality_rules": _OP4,
    "op5_suffix_dedup": _OP5,
    "op6_source_mixing": _OP6,
    "op9_ball_tree_topk": _OP9,
    "op10_setsketch_dedup": _OP10,
    "op11_prefix_trie": _OP11,
    "op13_periodic_runs": _OP13,
}
