"""The same results in plain SQL, written independently for DuckDB.

Views build on each other by name; ``sql`` puts those a statement needs in
front of it.  Text is taken apart token by token in relations here, while the
Spark side works on arrays inside a row.
"""

from __future__ import annotations

import re

from clientele import schemas
from clientele.functions import wordlists as L
from clientele.plans.queries import AS_OF, FRACTION, LEXICON


def _quoted(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def _pattern(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SPACE = r"\s\p{Z}\x1c-\x1f\x85"
_LONE = r"""\[\](){}<>"«»“”‘’„`;@#$%&?!*"""
_HANG = "(?:" + "|".join(
    "".join("\\" + c for c in m) for m in sorted(L.HANGING_PUNCTUATION, key=len, reverse=True)
) + ")"
_SHARE = int(FRACTION * 2**32)
_HALF = 2**31
_COMPLIMENTS = ",\n".join(
    f"(floor(abs(c_acctbal))::BIGINT + {i}) % {10 + i} AS {c}" for i, c in enumerate(schemas.COMPLIMENTS)
)


def _bucket(column: str) -> str:
    return f"('0x' || substr(md5({column}), 1, 8))::BIGINT"


def _map_text(key: str, value: str) -> str:
    return f"string_agg({key} || '=' || {value}, ';' ORDER BY {key})"


def _sentiment_views(name: str, source: str) -> dict[str, str]:
    """Label per (rid, text) of ``source``, by tokens, lags and sums."""
    lead, trail = rf"^{_HANG}([^[:punct:]]{{2,}})$", rf"^([^[:punct:]]{{2,}}){_HANG}$"
    boosters = _quoted(L.INTENSIFIERS + L.DAMPENERS)
    idioms = " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in L.IDIOMS.items())
    pairs = _quoted(L.DAMPENER_PAIRS)

    def look_back(k: int, score: str, damping: float) -> str:
        emphatic = {
            1: "FALSE",
            2: "(w2 = 'never' AND w1 IN ('so', 'this'))",
            3: "((w3 = 'never' AND w2 IN ('so', 'this')) OR w1 IN ('so', 'this'))",
        }[k]
        strength = {1: 1.0, 2: 1.5, 3: 1.25}[k]
        push = f"""CASE WHEN l{k} IN {_quoted(L.INTENSIFIERS)} THEN {L.BOOST}::DOUBLE
                        WHEN l{k} IN {_quoted(L.DAMPENERS)} THEN {-L.BOOST}::DOUBLE END"""
        loud = f"""CASE WHEN mixed AND u{k} THEN CASE WHEN {score} > 0 THEN {L.CAPS_BOOST}::DOUBLE
                        ELSE {-L.CAPS_BOOST}::DOUBLE END ELSE 0::DOUBLE END"""
        sign = f"CASE WHEN {score} < 0 THEN -1::DOUBLE ELSE 1::DOUBLE END"
        factor = f"""CASE WHEN {emphatic} THEN {strength}::DOUBLE
                          WHEN l{k} IN {_quoted(L.NEGATIONS)} OR contains(l{k}, 'n''t')
                          THEN {L.NEGATION_FACTOR}::DOUBLE ELSE 1::DOUBLE END"""
        return f"({score} + coalesce((({push}) * ({sign}) + ({loud})) * {damping}::DOUBLE, 0)) * ({factor})"

    def idiom(phrase: str) -> str:
        return f"CASE {phrase} {idioms} END"

    def step(k: int) -> str:
        damping = L.DISTANCE_DAMPING[k - 1]
        return f"CASE WHEN p >= {k} AND x{k} IS NULL THEN {look_back(k, f's{k - 1}', damping)} ELSE s{k - 1} END"

    v = name
    return {
        f"{v}_raw": f"""SELECT rid, unnest(parts) AS part, generate_subscripts(parts, 1) AS ord FROM (
            SELECT rid, regexp_split_to_array(text, {_pattern(f'[{_SPACE}]+')}) AS parts
            FROM {source} WHERE text IS NOT NULL)""",
        f"{v}_tok": f"""SELECT rid, w, lower(w) AS lw, upper(w) = w AND lower(w) <> w AS up,
            row_number() OVER (PARTITION BY rid ORDER BY ord) - 1 AS p
            FROM (SELECT rid, ord, CASE
                WHEN regexp_matches(part, {_pattern(lead)}) THEN regexp_replace(part, {_pattern(lead)}, '\\1')
                WHEN regexp_matches(part, {_pattern(trail)}) THEN regexp_replace(part, {_pattern(trail)}, '\\1')
                ELSE part END AS w FROM {v}_raw WHERE length(part) > 1)""",
        f"{v}_ctx": f"""SELECT t.*, x.valence AS x0,
            bool_or(up) OVER r AND bool_or(NOT up) OVER r AS mixed,
            min(p) FILTER (WHERE lw = 'but') OVER r AS but_at,
            {", ".join(f"lag(w, {k}) OVER o AS w{k}, lag(lw, {k}) OVER o AS l{k}, lag(up, {k}) OVER o AS u{k}, lag(x.valence, {k}) OVER o AS x{k}" for k in (1, 2, 3))},
            lead(w, 1) OVER o AS n1, lead(w, 2) OVER o AS n2, lead(lw, 1) OVER o AS nl1
            FROM {v}_tok t LEFT JOIN lexicon x ON t.lw = x.word
            WINDOW r AS (PARTITION BY rid), o AS (PARTITION BY rid ORDER BY p)""",
        f"{v}_first": f"""SELECT * FROM {v}_ctx WHERE x0 IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY rid, w ORDER BY p) = 1""",
        f"{v}_s0": f"""SELECT *, x0 + CASE WHEN mixed AND up THEN CASE WHEN x0 > 0
            THEN {L.CAPS_BOOST}::DOUBLE ELSE {-L.CAPS_BOOST}::DOUBLE END ELSE 0::DOUBLE END AS s0 FROM {v}_first""",
        f"{v}_s1": f"SELECT *, {step(1)} AS s1 FROM {v}_s0",
        f"{v}_s2": f"SELECT *, {step(2)} AS s2 FROM {v}_s1",
        f"{v}_s3": f"SELECT *, {step(3)} AS s3 FROM {v}_s2",
        f"{v}_s4": f"""SELECT *, CASE WHEN p >= 3 AND x3 IS NULL THEN coalesce(
                {idiom("w || ' ' || n1 || ' ' || n2")}, {idiom("w || ' ' || n1")},
                {idiom("w1 || ' ' || w")}, {idiom("w2 || ' ' || w1 || ' ' || w")},
                {idiom("w2 || ' ' || w1")}, {idiom("w3 || ' ' || w2 || ' ' || w1")},
                {idiom("w3 || ' ' || w2")}, s3)
                + CASE WHEN w3 || ' ' || w2 IN {pairs} OR w2 || ' ' || w1 IN {pairs}
                  THEN {-L.BOOST}::DOUBLE ELSE 0::DOUBLE END
            ELSE s3 END AS s4 FROM {v}_s3""",
        f"{v}_scored": f"""SELECT rid, w, CASE
            WHEN lw IN {boosters} OR (lw = 'kind' AND coalesce(nl1 = 'of', FALSE)) THEN 0::DOUBLE
            ELSE s4 * CASE WHEN l1 = 'least' AND x1 IS NULL AND NOT coalesce(l2 IN ('at', 'very'), FALSE)
                THEN {L.NEGATION_FACTOR}::DOUBLE ELSE 1::DOUBLE END END AS score FROM {v}_s4""",
        f"{v}_total": f"""SELECT rid, list_reduce(list(score * CASE WHEN but_at IS NULL OR p = but_at THEN 1::DOUBLE
                WHEN p < but_at THEN 0.5::DOUBLE ELSE 1.5::DOUBLE END ORDER BY p),
                lambda x, y: x + y, 0::DOUBLE) AS total
            FROM {v}_ctx JOIN {v}_scored USING (rid, w) GROUP BY rid""",
        f"{v}_loud": f"""SELECT rid, total + sign(total) * (
                least(length(text) - length(replace(text, '!', '')), {L.MAX_EXCLAMATIONS}) * {L.EXCLAMATION_WEIGHT}::DOUBLE
                + CASE WHEN asks <= 1 THEN 0::DOUBLE WHEN asks <= 3 THEN asks * {L.QUESTION_WEIGHT}::DOUBLE
                  ELSE {L.MAX_QUESTION_WEIGHT}::DOUBLE END) AS s
            FROM (SELECT rid, text, coalesce(total, 0::DOUBLE) AS total,
                length(text) - length(replace(text, '?', '')) AS asks
                FROM {source} LEFT JOIN {v}_total USING (rid) WHERE text IS NOT NULL)""",
        f"{v}_label": f"""SELECT rid, CASE WHEN c >= {L.POSITIVE_FROM}::DOUBLE THEN 'positive'
                WHEN c <= {L.NEGATIVE_UP_TO}::DOUBLE THEN 'negative' ELSE 'neutral' END AS sentiment
            FROM (SELECT rid, coalesce(round(s / sqrt(s * s + {L.NORMALISER}::DOUBLE), 4), 0) AS c
                FROM {source} LEFT JOIN {v}_loud USING (rid))""",
    }


def _word_views(name: str, source: str) -> dict[str, str]:
    """The ten most frequent words per (rid, text) of ``source``."""
    text = "lower(text)"
    for pattern, by in [
        (r"\.{2,}|--|''", " "),
        (rf"[{_LONE}]", " "),
        (rf"[{_SPACE}]", " "),
        (r"[:,]+(\D|\z)", r" \1"),
        (r"\.([ :,]|\z)", r" \1"),
        (r"([^' ])(?:n't|'(?:s|m|d|ll|re|ve)?)( |\z)", r"\1 \2"),
    ]:
        text = f"regexp_replace({text}, {_pattern(pattern)}, '{by}', 'g')"
    v = name
    return {
        f"{v}_split": f"""SELECT rid, unnest(parts) AS part, generate_subscripts(parts, 1) AS ord
            FROM (SELECT rid, string_split({text}, ' ') AS parts FROM {source} WHERE text IS NOT NULL)""",
        f"{v}_word": f"""SELECT rid, ord * 2 + n AS ord, parts[n] AS word FROM (
                SELECT rid, ord, CASE part WHEN 'cannot' THEN ['can', 'not'] WHEN 'gimme' THEN ['gim', 'me']
                    WHEN 'lemme' THEN ['lem', 'me'] WHEN 'gonna' THEN ['gon', 'na'] WHEN 'wanna' THEN ['wan', 'na']
                    WHEN 'gotta' THEN ['got', 'ta'] ELSE [part] END AS parts FROM {v}_split),
                (VALUES (1), (2)) AS halves(n) WHERE n <= len(parts)""",
        f"{v}_rank": f"""SELECT rid, word, row_number() OVER (
                PARTITION BY rid ORDER BY count(*) DESC, min(ord)) AS place
            FROM {v}_word WHERE regexp_full_match(word, '\\p{{L}}+') AND word NOT IN {_quoted(L.STOP_WORDS)}
            GROUP BY rid, word""",
        f"{v}_top": f"""SELECT rid, word, place FROM {v}_rank WHERE place <= 10""",
        f"{v}_list": f"""SELECT rid, coalesce(string_agg(word, ',' ORDER BY place), '') AS frequent_words
            FROM {source} LEFT JOIN {v}_top USING (rid) GROUP BY rid""",
    }


_TIME = "'%Y-%m-%d %H:%M:%S'"
VIEWS: dict[str, str] = {
    "lexicon": "SELECT * FROM (VALUES "
    + ", ".join(f"('{w}', {x}::DOUBLE)" for w, x in LEXICON.items())
    + ") AS lexicon(word, valence)",
    "user_orders": f"""SELECT o_custkey, count(*) AS review_count, min(o_orderdate) AS yelping_since,
        string_agg(DISTINCT year(o_orderdate)::VARCHAR, ',' ORDER BY year(o_orderdate)::VARCHAR) AS years,
        sum(1 + o_orderkey % 5)::BIGINT / count(*)::DOUBLE AS average_stars FROM orders GROUP BY o_custkey""",
    "users": f"""SELECT 'u' || c_custkey AS user_id, c_name AS name,
        coalesce(review_count, 0) AS review_count, yelping_since,
        floor(abs(c_acctbal))::BIGINT AS useful, floor(abs(c_acctbal))::BIGINT % 100 AS funny,
        floor(abs(c_acctbal))::BIGINT % 37 AS cool,
        coalesce(years, '') || CASE WHEN c_custkey % 7 = 0 THEN ',20,20'
            WHEN c_custkey % 11 = 0 THEN ',201,20125' ELSE '' END AS elite,
        greatest(c_custkey % 13, 1)::BIGINT AS friends_count, c_custkey % 50 AS fans, average_stars,
        {_COMPLIMENTS} FROM customer LEFT JOIN user_orders ON c_custkey = o_custkey""",
    "places": """SELECT 'b' || p_partkey AS business_id, p_name AS name, p_brand || ' street' AS address,
        'Size=' || p_size || ';Type=' || p_type AS attributes,
        'Monday=' || (p_partkey % 12) || ':0-18:0' AS hours,
        CASE WHEN p_partkey % 50 <> 0 THEN replace(p_name, ' ', ', ') || ', ' || p_type
            || CASE WHEN p_partkey % 10 = 3 THEN ', Food,Drink' ELSE '' END END AS listed,
        replace(listed, ', ', ',') AS categories,
        n_name AS city, 'S' || n_regionkey AS state,
        n_nationkey * 2.0::DOUBLE + (p_partkey % 10) / 4.0::DOUBLE AS latitude,
        n_nationkey * -3.0::DOUBLE + (p_partkey % 8) / 8.0::DOUBLE AS longitude,
        p_partkey % 2 AS is_open, lpad((p_partkey % 100000)::VARCHAR, 5, '0') AS postal_code,
        p_size::BIGINT AS review_count, 1 + (p_partkey % 9) / 2.0::DOUBLE AS stars
        FROM part JOIN nation ON p_partkey % 25 = n_nationkey""",
    "reviews": """SELECT concat_ws('-', 'l', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS review_id,
        NULL AS doc_id, 'u' || o_custkey AS user_id, 'b' || l_partkey AS business_id,
        CASE WHEN l_partkey % 40 <> 0 THEN 1 + (l_quantity - 1) % 5 END::DOUBLE AS stars,
        o_orderdate AS date, l_linenumber::BIGINT AS useful, l_linenumber::BIGINT % 2 AS funny,
        0::BIGINT AS cool, NULL::VARCHAR AS text FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        UNION ALL
        SELECT 'd' || doc_id, doc_id, 'u' || o_custkey, 'b' || (doc_id % 200), (1 + doc_id % 5)::DOUBLE,
        o_orderdate, doc_id % 9, doc_id % 4, doc_id % 3, text FROM documents JOIN orders ON doc_id = o_orderkey""",
    "visits": """SELECT r.user_id, r.stars, p.* EXCLUDE (stars) FROM reviews r JOIN places p USING (business_id)""",
    "doc_text": "SELECT doc_id AS rid, text FROM documents",
    **_sentiment_views("ds", "doc_text"),
    **_word_views("dw", "doc_text"),
    "tips": f"""SELECT 'u' || conv_id AS user_id, 'b' || (conv_id % 200) AS business_id,
        turn AS compliment_count, text, 'u' || conv_id || '-' || turn AS rid,
        CASE WHEN conv_id % 11 <> 0 THEN strftime(DATE '2020-01-01' + (conv_id % 365)::INT, {_TIME}) END AS date
        FROM conversations""",
    **_sentiment_views("ts", "tips"),
    "labelled": """SELECT r.*, coalesce(d.sentiment, 'neutral') AS sentiment FROM reviews r
        LEFT JOIN ds_label d ON r.doc_id = d.rid""",
    "sampled": f"SELECT DISTINCT user_id FROM reviews WHERE {_bucket('user_id')} < {_SHARE}",
    "f_activity": """SELECT user_id, min(date) AS first_seen, max(date) AS last_seen,
        date_diff('day', min(date), max(date)) AS date_diff,
        count(DISTINCT business_id) AS different_business_count,
        sum(stars) / count(stars) AS avg_rating, min(stars) AS min_stars, max(stars) AS max_stars
        FROM reviews GROUP BY user_id""",
    "category_rows": """SELECT user_id, stars, unnest(string_split(listed, ', ')) AS category
        FROM visits WHERE listed IS NOT NULL""",
    "category_n": """SELECT user_id, category, count(*) AS n, sum(stars) / count(stars) AS mean
        FROM category_rows GROUP BY user_id, category""",
    "f_categories": f"SELECT user_id, {_map_text('category', 'n')} AS category_map FROM category_n GROUP BY user_id",
    "f_ratings": f"""SELECT user_id, {_map_text('category', 'mean')} AS category_avg_stars
        FROM category_n WHERE mean IS NOT NULL AND NOT isnan(mean) GROUP BY user_id""",
    "city_point": """SELECT city, arg_min(latitude, business_id) AS latitude,
        arg_min(longitude, business_id) AS longitude FROM places GROUP BY city""",
    "city_n": """SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, city) AS place
        FROM (SELECT user_id, city, count(*) AS n FROM visits WHERE city IS NOT NULL GROUP BY user_id, city)""",
    "f_area": """SELECT user_id, max(c.city) FILTER (WHERE place = 1) AS user_city,
        coalesce(string_agg(c.city || '=' || n, ';' ORDER BY c.city) FILTER (WHERE place > 1), '') AS travel_map,
        max(latitude) FILTER (WHERE place = 1) AS latitude, max(longitude) FILTER (WHERE place = 1) AS longitude
        FROM city_n c JOIN city_point USING (city) GROUP BY user_id""",
    "sentiment_n": "SELECT user_id, sentiment, count(*) AS n FROM labelled GROUP BY ALL",
    "f_sentiments": f"SELECT user_id, {_map_text('sentiment', 'n')} AS sentiment_map FROM sentiment_n GROUP BY user_id",
    "word_n": "SELECT user_id, word, count(*) AS n FROM reviews JOIN dw_top ON doc_id = rid GROUP BY ALL",
    "f_words": f"SELECT user_id, {_map_text('word', 'n')} AS frequent_words_map FROM word_n GROUP BY user_id",
    "profile": """SELECT * FROM users JOIN f_activity USING (user_id) JOIN f_categories USING (user_id)
        JOIN f_ratings USING (user_id) JOIN f_area USING (user_id) JOIN f_sentiments USING (user_id)
        JOIN f_words USING (user_id)""",
    "profile_left": """SELECT u.*, a.* EXCLUDE (user_id),
        CASE WHEN a.user_id IS NOT NULL THEN coalesce(category_map, '') END AS category_map,
        CASE WHEN a.user_id IS NOT NULL THEN coalesce(category_avg_stars, '') END AS category_avg_stars,
        user_city, travel_map, latitude, longitude, sentiment_map,
        CASE WHEN a.user_id IS NOT NULL THEN coalesce(frequent_words_map, '') END AS frequent_words_map
        FROM users u LEFT JOIN f_activity a USING (user_id) LEFT JOIN f_categories USING (user_id)
        LEFT JOIN f_ratings USING (user_id) LEFT JOIN f_area USING (user_id)
        LEFT JOIN f_sentiments USING (user_id) LEFT JOIN f_words USING (user_id)""",
    "pivoted": """SELECT p.*, coalesce(positive, 0) AS positive_sentiment, coalesce(negative, 0) AS negative_sentiment,
        coalesce(neutral, 0) AS neutral_sentiment FROM profile p LEFT JOIN (SELECT user_id,
            max(n) FILTER (WHERE sentiment = 'positive') AS positive,
            max(n) FILTER (WHERE sentiment = 'negative') AS negative,
            max(n) FILTER (WHERE sentiment = 'neutral') AS neutral FROM sentiment_n GROUP BY user_id) USING (user_id)""",
    "segment": """SELECT * FROM profile WHERE friends_count >= 2 AND average_stars BETWEEN 2 AND 4
        AND review_count BETWEEN 5 AND 40 AND date_diff BETWEEN 100 AND 2400 AND useful >= 100""",
    "category_of_user": "SELECT p.*, category AS category_name, n AS category_count FROM profile p JOIN category_n USING (user_id)",
    "elite_of_user": "SELECT user_id, unnest(string_split(elite, ',')) AS token FROM profile",
    "event_rows": f"""SELECT 'e' || event_id AS review_id, 'u' || user_id AS user_id,
        'b' || json_extract_string(props, '$.k') AS business_id, value AS stars, event_type AS text,
        strftime(ts, {_TIME}) AS date, event_id % 9 AS useful, event_id % 4 AS funny, event_id % 3 AS cool,
        event_id, ts FROM events""",
    "checkin_rows": f"""SELECT business_id, strftime(ts, {_TIME})
        || CASE WHEN event_id % 3 >= 1 THEN ',' || strftime(ts + INTERVAL 1 DAY, {_TIME}) ELSE '' END
        || CASE WHEN event_id % 3 >= 2 THEN ',' || strftime(ts + INTERVAL 2 DAY, {_TIME}) ELSE '' END AS date
        FROM event_rows""",
}
VIEWS["doc_reviews"] = f"""SELECT 'd' || doc_id AS review_id, source AS user_id, 'b' || (doc_id % 200) AS business_id,
    (1 + doc_id % 5)::DOUBLE AS stars, doc_id % 9 AS useful, doc_id % 4 AS funny, doc_id % 3 AS cool,
    strftime(DATE '2020-01-01' + (doc_id % 1000)::INT, {_TIME}) AS date, text, sentiment, frequent_words
    FROM documents JOIN ds_label s ON doc_id = s.rid JOIN dw_list w ON doc_id = w.rid"""

# Cities told apart by their state.
VIEWS["towns"] = "SELECT * REPLACE (city || ', ' || state AS city) FROM places WHERE city IS NOT NULL"
VIEWS["town_n"] = """SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, city) AS place
    FROM (SELECT user_id, city, count(*) AS n FROM reviews JOIN towns USING (business_id) GROUP BY ALL)"""
VIEWS["town_point"] = """SELECT city, arg_min(latitude, business_id) AS latitude, arg_min(longitude, business_id) AS longitude
    FROM towns GROUP BY city"""

# Event reviews as they are sent, three times, with the watermark that each time meets.
VIEWS["marked_events"] = """SELECT *, (event_id % 11 = 3 AND own = 1) OR (event_id % 11 = 7 AND own = 2) AS withheld
    FROM (SELECT *, date::TIMESTAMP AS seen, least(3, ceil(day(date::TIMESTAMP) / 10.0))::BIGINT AS own FROM event_rows)"""
VIEWS["sent_events"] = """SELECT own AS k, * FROM marked_events WHERE NOT withheld
    UNION ALL SELECT own, * FROM marked_events WHERE NOT withheld AND event_id % 7 = 0
    UNION ALL SELECT own + 1, * FROM marked_events WHERE NOT withheld AND event_id % 5 = 0 AND own < 3
    UNION ALL SELECT 3, * FROM marked_events WHERE withheld"""
VIEWS["watermarks"] = """SELECT t.k, coalesce(max(seen) - INTERVAL 4 DAYS, TIMESTAMP '1970-01-01') AS watermark
    FROM (VALUES (1), (2), (3), (4)) t(k) LEFT JOIN sent_events s ON s.k < t.k GROUP BY t.k"""


def sql(statement: str) -> str:
    """``statement`` with the views it mentions, directly or through others."""
    needed: set[str] = set()
    open_texts = [statement]
    while open_texts:
        for word in set(re.findall(r"\w+", open_texts.pop())) & VIEWS.keys() - needed:
            needed.add(word)
            open_texts.append(VIEWS[word])
    if not needed:
        return statement
    order, seen = [], set()

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for word in re.findall(r"\w+", VIEWS[name]):
            if word in VIEWS and word != name:
                visit(word)
        order.append(name)

    for name in VIEWS:
        if name in needed:
            visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order) + "\n" + statement


def _times(*columns: str) -> str:
    return ", ".join(f"strftime({c}, {_TIME}) AS {c}" for c in columns)


_STAMPS = ("yelping_since", "first_seen", "last_seen")


def _columns(names, prefix: str = "") -> str:
    return ", ".join(
        f"strftime({prefix}{c}, {_TIME}) AS {c}" if c in _STAMPS else prefix + c for c in names
    )


_PROFILE = _columns(schemas.PROFILE_COLUMNS)
_REPORT = _columns(schemas.REPORT_COLUMNS)
_TOTAL = "(positive_sentiment + neutral_sentiment + negative_sentiment)"
_RAW_REVIEW = f"""SELECT review_id, user_id, business_id, stars, useful, funny, cool, text,
    strftime(date, {_TIME}) AS date FROM reviews"""


def _status(days: int) -> str:
    today = f"DATE '{AS_OF}'"
    return f"""SELECT user_id, {_times('first_seen', 'last_seen')}, CASE
        WHEN date_diff('day', first_seen, {today}) <= {days} THEN 'New'
        WHEN date_diff('day', last_seen, {today}) <= {days}
            AND date_diff('day', first_seen, last_seen) >= 365 THEN 'Loyal'
        WHEN date_diff('day', last_seen, {today}) > {days} THEN 'Lapsed' END AS user_status FROM profile"""


_STEPS = [
    ("Original data", "", "TRUE"),
    ("Filter: ''Number of Friends''", "friends_count BETWEEN 2 AND max(friends_count)", "friends_count >= 2"),
    ("Filter: ''Average Stars Given''", "average_stars BETWEEN 2 AND 4", "average_stars BETWEEN 2 AND 4"),
    ("Filter: ''Number of Review Given''", "review_count BETWEEN 5 AND 40", "review_count BETWEEN 5 AND 40"),
    ("Filter: ''Active Days''", "date_diff BETWEEN 100 AND 2400", "date_diff BETWEEN 100 AND 2400"),
    ("Filter: ''People Find Useful''", "useful BETWEEN 100 AND max(useful)", "useful >= 100"),
]
_FUNNEL = " UNION ALL ".join(
    f"""SELECT {i + 1}::BIGINT AS stage, '{label}' AS label,
    '{_STEPS[i + 1][0] if i + 1 < len(_STEPS) else 'Result'}' AS flows_to, '{text}' AS statement,
    (SELECT count(*) FROM profile WHERE {' AND '.join(c for _, _, c in _STEPS[: i + 1])}) AS rows"""
    for i, (label, text, _) in enumerate(_STEPS)
)
_BOUNDS = " UNION ALL ".join(
    f'SELECT \'{c}\' AS "column", max({c})::DOUBLE AS max_value, ceil(max({c}))::BIGINT AS last_step FROM profile'
    for c in ("friends_count", "average_stars", "review_count", "date_diff", "useful")
)
_USER = ", ".join([
    "user_id", "name", "review_count", f"strftime(yelping_since, {_TIME}) AS yelping_since", "useful",
    "funny", "cool", "elite", "fans", "average_stars", *schemas.COMPLIMENTS, "friends_count",
])


def _popular(rows: str, name: str, n: int) -> str:
    return f"""SELECT {name} AS name, sum(n)::BIGINT AS total FROM {rows}
        WHERE user_id IN (SELECT user_id FROM segment) GROUP BY 1 ORDER BY total DESC, name LIMIT {n}"""


def _top(n: int) -> str:
    return f"""SELECT category_name, sum(category_count)::BIGINT AS category_count FROM category_of_user
        GROUP BY 1 ORDER BY category_count DESC, category_name LIMIT {n}"""


_MODEL = f"""SELECT b.user_id, record_count, review_count, positive_sentiment, negative_sentiment,
        neutral_sentiment, categories, category_count, elite_years, user_status
        FROM (SELECT user_id, count(*) AS record_count FROM labelled GROUP BY user_id) b
        LEFT JOIN pivoted USING (user_id)
        LEFT JOIN (SELECT user_id, count(*) AS categories, sum(n)::BIGINT AS category_count
            FROM category_n JOIN profile USING (user_id) GROUP BY user_id) c USING (user_id)
        LEFT JOIN (SELECT user_id, count(*) AS elite_years
            FROM elite_of_user GROUP BY user_id) e USING (user_id)
        LEFT JOIN ({_status(10)}) s USING (user_id)"""


ORACLE: dict[str, str] = {name: sql(text) for name, text in {
    "prim_project": "SELECT user_id, business_id FROM reviews",
    "src_json_roundtrip": _RAW_REVIEW,
    "src_json_map_schema": "SELECT * EXCLUDE (listed) REPLACE (listed AS categories) FROM places",
    "op_materialize": """SELECT user_id, business_id, count(*) AS visits FROM reviews
        WHERE user_id IN (SELECT user_id FROM sampled) GROUP BY ALL""",
    "sink_table": f"SELECT {_PROFILE} FROM profile",
    "sample_users_hash": "SELECT user_id FROM sampled",
    "sample_top_fraction": f"""SELECT user_id FROM (SELECT user_id, row_number() OVER (
            ORDER BY count(*) DESC, {_bucket('user_id')}, user_id) AS place, count(*) OVER () AS users
        FROM reviews GROUP BY user_id) WHERE place <= ceil({FRACTION}::DOUBLE * users)""",
    "sample_business": "SELECT DISTINCT business_id FROM reviews WHERE user_id IN (SELECT user_id FROM sampled)",
    "sample_semi_join": """SELECT review_id, user_id, stars FROM reviews
        WHERE user_id IN (SELECT user_id FROM sampled)""",
    "clean_users": f"SELECT {_USER} FROM users",
    "clean_business": "SELECT * EXCLUDE (listed) FROM places",
    "clean_checkins": "SELECT * FROM checkin_rows",
    "clean_tips": "SELECT * EXCLUDE (rid) FROM tips",
    "enrich_reviews": "SELECT * FROM doc_reviews",
    "nlp_sentiment": """SELECT 'd' || rid AS review_id, sentiment FROM ds_label
        UNION ALL SELECT rid, sentiment FROM ts_label""",
    "nlp_sentiment_large": """SELECT CASE rid % 3 WHEN 0 THEN NULL WHEN 1 THEN 'same' ELSE 'd' || rid END AS review_id,
        sentiment FROM ds_label UNION ALL SELECT rid, sentiment FROM ts_label""",
    "nlp_top_words": "SELECT rid AS doc_id, frequent_words FROM dw_list",
    "feat_user_agg": f"SELECT * REPLACE ({_times('first_seen', 'last_seen')}) FROM f_activity",
    "feat_distinct_sketch": """SELECT user_id, count(DISTINCT business_id) AS businesses, TRUE AS close, TRUE AS merges
        FROM reviews GROUP BY user_id""",
    "feat_user_agg_view": f"SELECT * REPLACE ({_times('first_seen', 'last_seen')}) FROM f_activity",
    "feat_category_counts": "SELECT * FROM f_categories",
    "feat_category_avg": "SELECT * FROM f_ratings",
    "feat_area": "SELECT * FROM f_area",
    "feat_area_by_state": """SELECT user_id, max(c.city) FILTER (WHERE place = 1) AS user_city,
        coalesce(string_agg(c.city || '=' || n, ';' ORDER BY c.city) FILTER (WHERE place > 1), '') AS travel_map,
        max(latitude) FILTER (WHERE place = 1) AS latitude, max(longitude) FILTER (WHERE place = 1) AS longitude
        FROM town_n c JOIN town_point USING (city) GROUP BY user_id""",
    "run_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS rows FROM {view}" for name, view in (
            ("review", "reviews"), ("user", "users"), ("friends", "users"), ("business", "places"),
            ("checkin", "checkin_rows"), ("tip", "tips"), ("combined", "profile"))),
    "feat_friends_count": "SELECT user_id, friends_count FROM users",
    "feat_sentiment_map": "SELECT * FROM f_sentiments",
    "feat_frequent_words": "SELECT * FROM f_words",
    "feat_user_words": "SELECT user_id, word, n FROM word_n",
    "profile_merge": f"SELECT {_PROFILE} FROM profile",
    "profile_merge_left": f"SELECT {_PROFILE} FROM profile_left",
    "profile_bucketed": f"SELECT {_PROFILE} FROM profile",
    "profile_incremental": f"SELECT {_PROFILE} FROM profile",
    "profile_streamed": f"SELECT {_PROFILE} FROM profile",
    "pipeline_run": f"SELECT {_PROFILE} FROM profile",
    "pipeline_stream_profile": f"SELECT {_PROFILE} FROM profile",
    "seg_filter_chain": f"SELECT {_PROFILE} FROM segment",
    "seg_filter_eq": f"SELECT {_PROFILE} FROM profile WHERE user_city = 'NATION_7'",
    "seg_filter_in": """SELECT user_id, elite FROM profile
        WHERE list_has_any(string_split(elite, ','), ['1996', '2001'])""",
    "seg_filter_contains": "SELECT user_id, elite FROM profile WHERE elite LIKE '%1997,1999%'",
    "seg_filter_bounds": _BOUNDS,
    "seg_filter_bounds_footers": _BOUNDS,
    "seg_filter_clustered": f"SELECT {_PROFILE} FROM segment",
    "seg_cube": f"""SELECT user_city AS city, user_status AS status, year(yelping_since) AS joined,
        grouping_id(user_city, user_status, year(yelping_since)) AS totals, count(*) AS users,
        sum(review_count)::BIGINT AS review_count, sum(fans)::BIGINT AS fans, sum(useful)::BIGINT AS useful
        FROM profile JOIN (SELECT user_id, user_status FROM ({_status(10)})) USING (user_id)
        GROUP BY CUBE (user_city, user_status, year(yelping_since))""",
    "seg_grouping_sets": f"""SELECT user_city AS city, user_status AS status, year(yelping_since) AS joined,
        grouping_id(user_city, user_status, year(yelping_since)) AS totals, count(*) AS users,
        sum(review_count)::BIGINT AS review_count
        FROM profile JOIN (SELECT user_id, user_status FROM ({_status(10)})) USING (user_id)
        GROUP BY GROUPING SETS ((user_city, user_status), (year(yelping_since)), ())""",
    "seg_funnel": _FUNNEL,
    "seg_popular_categories": _popular("category_n", "category", 20),
    "seg_popular_words": _popular("word_n", "word", 20),
    "seg_elite_years": """SELECT token AS year, count(*) AS elite_users FROM elite_of_user
        WHERE token NOT IN ('', '20') AND user_id IN (SELECT user_id FROM segment) GROUP BY token""",
    "seg_preview": f"""SELECT {_PROFILE} FROM segment ORDER BY md5('7:' || user_id), user_id LIMIT 5""",
    "seg_emotions": """SELECT sentiment AS emotion, sum(n)::BIGINT AS reviews,
        sum(n)::BIGINT / (sum(sum(n)) OVER ())::DOUBLE AS share FROM sentiment_n
        WHERE user_id IN (SELECT user_id FROM segment) GROUP BY sentiment""",
    "seg_geo_points": "SELECT latitude, longitude FROM segment WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
    "seg_export": f"SELECT {_PROFILE} FROM segment",
    "bi_user_status": _status(30),
    "bi_user_status_short": _status(10),
    "bi_sentiment_pivot": f"SELECT {_REPORT}, positive_sentiment, negative_sentiment, neutral_sentiment FROM pivoted",
    "bi_sentiment_ratio": f"""SELECT user_id, {_TOTAL} AS total_sentiment,
        CASE WHEN {_TOTAL} = 0 THEN 0 ELSE positive_sentiment / {_TOTAL}::DOUBLE END AS positive_ratio,
        CASE WHEN {_TOTAL} = 0 THEN 0 ELSE neutral_sentiment / {_TOTAL}::DOUBLE END AS neutral_ratio,
        negative_sentiment / nullif({_TOTAL}, 0)::DOUBLE * 100 AS negative_percent FROM pivoted""",
    "bi_sentiment_pct": " UNION ALL ".join(
        f"""SELECT '{s}_percent' AS measure,
        sum({s}_sentiment)::BIGINT / sum({_TOTAL})::DOUBLE * 100 AS percent FROM pivoted"""
        for s in ("positive", "negative", "neutral")
    ),
    "bi_sentiment_by_year": """SELECT year(yelping_since) AS year,
        sum(positive_sentiment)::BIGINT AS positive_sentiment, sum(negative_sentiment)::BIGINT AS negative_sentiment,
        sum(neutral_sentiment)::BIGINT AS neutral_sentiment FROM pivoted GROUP BY 1""",
    "bi_sentiment_corr": """SELECT round(corr(positive_sentiment, negative_sentiment), 6) AS positive_negative,
        round(corr(positive_sentiment, neutral_sentiment), 6) AS positive_neutral,
        round(corr(negative_sentiment, neutral_sentiment), 6) AS negative_neutral FROM pivoted""",
    "bi_category_long": f"""SELECT {_columns([c for c in schemas.REPORT_COLUMNS if c != 'category_map'])},
        category_name, category_count FROM category_of_user""",
    "bi_variant_pivot": f"SELECT {_REPORT}, positive_sentiment, negative_sentiment, neutral_sentiment FROM pivoted",
    "bi_variant_long": f"""SELECT {_columns([c for c in schemas.REPORT_COLUMNS if c != 'category_map'])},
        category_name, category_count FROM category_of_user""",
    "bi_category_reviews": """SELECT category_name, sum(review_count)::BIGINT AS user_reviews_in_category
        FROM category_of_user GROUP BY 1""",
    "bi_top_categories": _top(500),
    "bi_category_dist": _top(30),
    "bi_elite_years": "SELECT user_id, try_cast(token AS BIGINT) AS elite_year FROM elite_of_user",
    "bi_elite_years_text": "SELECT user_id, token AS elite_year FROM elite_of_user",
    "bi_elite_years_wide": f"""SELECT {_REPORT}, try_cast(token AS BIGINT) AS elite_year
        FROM profile JOIN elite_of_user USING (user_id)""",
    "bi_reviews_by_year": """SELECT year(yelping_since) AS year, sum(review_count)::BIGINT AS review_count
        FROM profile GROUP BY 1""",
    "bi_reviews_by_review_year": "SELECT year(date) AS year, count(*) AS reviews FROM reviews GROUP BY 1",
    "bi_activity_heatmap": """SELECT day_bin, review_bin, count(*) AS users, sum(review_count)::BIGINT AS reviews
        FROM (SELECT floor(date_diff / 100.0)::BIGINT AS day_bin, floor(review_count / 50.0)::BIGINT AS review_bin,
            review_count FROM profile) WHERE day_bin BETWEEN 1 AND 49 OR day_bin BETWEEN 51 AND 55 GROUP BY 1, 2""",
    "bi_business_bins": """SELECT floor(different_business_count / 60.0)::BIGINT AS business_bin,
        count(*) AS users FROM profile GROUP BY 1""",
    "bi_key_skew": """SELECT count(*) AS keys, sum(n)::BIGINT AS rows, max(n) AS largest,
        max(n) / sum(n)::DOUBLE AS largest_share, quantile_cont(n, 0.5)::DOUBLE AS median,
        quantile_cont(n, 0.99)::DOUBLE AS p99
        FROM (SELECT business_id, count(*) AS n FROM reviews GROUP BY business_id)""",
    "bi_skew_sketch": """(SELECT 'business' AS kind, business_id AS name, count(*) AS amount FROM reviews
        GROUP BY business_id ORDER BY amount DESC, name LIMIT 10)
        UNION ALL SELECT 'quantile', p, 1 FROM (VALUES ('0.1'), ('0.5'), ('0.9'), ('0.99')) t(p)""",
    "bi_model_join": _MODEL,
    "bi_model_join_bucketed": _MODEL,
    "stream_decode": """SELECT * EXCLUDE (event_id, ts) FROM event_rows WHERE event_id % 97 <> 0
        UNION ALL SELECT CASE WHEN FALSE THEN '' END, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
        FROM event_rows WHERE event_id % 97 = 0""",
    "stream_dedup": """SELECT DISTINCT review_id, user_id, business_id, stars, text, date, useful, funny, cool
        FROM sent_events JOIN watermarks USING (k) WHERE seen > watermark""",
    "stream_daily": f"""SELECT strftime(date_trunc('day', seen), {_TIME}) AS day, count(*) AS reviews, count(stars) AS rated,
            round(sum(stars), 2) AS stars_sum
        FROM sent_events JOIN watermarks USING (k)
        WHERE date_trunc('day', seen) + INTERVAL 1 DAY > watermark
            AND date_trunc('day', seen) + INTERVAL 1 DAY <= (SELECT watermark FROM watermarks WHERE k = 4)
        GROUP BY 1""",
    "stream_file_sink": "SELECT * FROM checkin_rows",
    "stream_tips": "SELECT * EXCLUDE (rid) FROM tips",
    "stream_enrich": f"SELECT * FROM doc_reviews WHERE {_bucket('user_id')} < {_HALF}",
    "stream_replay": "SELECT * EXCLUDE (event_id, ts) FROM event_rows",
}.items()}
