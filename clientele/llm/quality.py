"""Quality rules, line first.

Every line with a word is judged on its own; lines that fail a rule are removed,
and a document that loses too large a part of its word characters is rejected,
as is one that fails the base rules.

Line rules
    punctuation   a line of under ``MIN_OPEN_WORDS`` words ends in a closing mark,
                  and at most ``MAX_NOISE`` of any line's characters are noise
    navigation    separators are fewer than one to ``WORDS_PER_SEPARATOR`` words
    boilerplate   none of the fixed phrases occurs, and under ``MAX_STUTTER`` of the
                  words equal the word before

Repeated windows are counted inside the row: window hashes in an array, a sort
only for the documents that repeat one.  Nothing is exploded or shuffled, and
whole texts are judged.

Defined results: null, empty and blank texts have no words and fail the base
rules; repeated rows are judged each for itself; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.words import SPACE_RUN, SPACES, WORD, let, total, words

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
NOISE = "#*$%&|<>!^~=_{}[]@"
MAX_NOISE = 0.1
SEPARATORS = "|»«•·›→"
WORDS_PER_SEPARATOR = 4
MIN_OPEN_WORDS = 12
MAX_STUTTER = 0.5
MAX_LOST = 0.5
# Looked for in the last characters of a line.
CLOSING_CHARS = 4
CLOSING = r"""[.!?…:;。！？]["'”’»)\]]*\z"""
# Fixed phrases of pages around a text, in lower case.
BOILERPLATE = (
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "licensed under",
    "privacy policy",
    "released under the",
    "sign up for our newsletter",
    "subscribe to our",
    "terms of service",
    "terms of use",
    "this work is licensed",
)


def _chars(text: Column) -> Column:
    """Characters of the words of a text."""
    return F.length(F.regexp_replace(text, SPACE_RUN, ""))


def _count(text: Column, marks: str) -> Column:
    """Occurrences of ``marks``; most texts have none and are only searched."""
    some = text.rlike("[" + "".join("\\" + m for m in marks) + "]")
    return F.when(some, F.length(text) - F.length(F.translate(text, marks, ""))).otherwise(0)


def judge_line(line: Column, chars: Column) -> Column:
    """Name of the first rule that ``line`` (trimmed, with a word) fails, or null."""
    noisy = _count(line, NOISE) > F.lit(MAX_NOISE) * chars
    lowered = let(F.lower(line), lambda low: reduce(or_, [low.contains(p) for p in BOILERPLATE]))
    closed = F.substring(line, -CLOSING_CHARS, CLOSING_CHARS).rlike(CLOSING)

    def verdict(listed: Column) -> Column:
        n_words = F.size(listed)
        stutter = F.size(F.filter(listed, lambda w, i: (i > 0) & (w == F.get(listed, i - 1))))
        crossed = let(_count(line, SEPARATORS), lambda n: (n > 0) & (n * WORDS_PER_SEPARATOR >= n_words))
        return (
            F.when(lowered | (stutter >= MAX_STUTTER * n_words), "boilerplate")
            .when(crossed, "navigation")
            .when((~closed & (n_words < MIN_OPEN_WORDS)) | noisy, "punctuation")
        )

    return let(words(line), verdict)


def judged_lines(text: Column) -> Column:
    """Lines with a word: array of (line, chars of words, failed rule or null)."""
    lines = F.transform(F.split(text, "\n"), lambda s: F.btrim(s, F.lit(SPACES)))

    def judged(line: Column) -> Column:
        return let(_chars(line), lambda n: F.struct(
            line.alias("line"), n.alias("chars"), judge_line(line, n).alias("failed")))

    return let(lines, lambda trimmed: F.transform(F.filter(trimmed, lambda s: s != ""), judged))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    with_word = F.filter(F.split(text, "\n"), lambda s: s.rlike(WORD))
    return let(with_word, lambda s: F.size(s) - F.size(F.array_distinct(s)))


def repeated_words(listed: Column, window: int = WINDOW) -> Column:
    """Words covered by windows whose sequence occurs twice or more."""
    def window_hashes(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - window)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)]))

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, i: F.least(
            F.lit(window), F.coalesce(F.get(places, i + 1) - p, F.lit(window))))
        return total(gaps)

    def count(found: Column) -> Column:
        ordered = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(rows: Column) -> Column:
            kept = F.filter(rows, lambda r, i: (
                F.coalesce(F.get(rows, i - 1)["h"] == r["h"], F.lit(False))
                | F.coalesce(F.get(rows, i + 1)["h"] == r["h"], F.lit(False))
            ))
            return let(F.sort_array(F.transform(kept, lambda r: r["i"])), covered)

        return F.when(F.size(F.array_distinct(found)) < F.size(found), let(ordered, repeated)).otherwise(0)

    hashed = F.transform(listed, lambda w: F.xxhash64(w))
    return F.when(
        F.size(listed) >= window, let(hashed, lambda h: let(window_hashes(h), count))
    ).otherwise(0).cast("long")


def clean_lines(docs: DataFrame, max_lost: float = MAX_LOST) -> DataFrame:
    """Base figures, verdict and cleaned text of every document.

    Returns doc_id, cleaned (lines that passed, joined by line feeds), failed
    (names of the rules that removed lines, in line order), lost (share of word
    characters removed) and the base columns.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select("doc_id", text.alias("text"))
    counted = texts.select(
        "doc_id",
        let(words(F.col("text")), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeated_words(w).alias("n_repeat_words"),
        )).alias("of_words"),
        _count(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        duplicate_lines(F.col("text")).cast("long").alias("n_dup_lines"),
        judged_lines(F.col("text")).alias("lines"),
    )
    judged = counted.select(
        "doc_id", "of_words.n_words", "n_symbols", "n_dup_lines", "of_words.n_repeat_words",
        let(F.col("lines"), lambda s: F.struct(
            F.array_join(F.transform(F.filter(s, lambda x: x["failed"].isNull()), lambda x: x["line"]), "\n").alias("cleaned"),
            F.transform(F.filter(s, lambda x: x["failed"].isNotNull()), lambda x: x["failed"]).alias("failed"),
            total(F.transform(F.filter(s, lambda x: x["failed"].isNotNull()), lambda x: x["chars"])).alias("lost_chars"),
            total(F.transform(s, lambda x: x["chars"])).alias("word_chars"),
        )).alias("verdict"),
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    word_chars = F.col("verdict.word_chars")
    lost = F.when(word_chars > 0, F.col("verdict.lost_chars") / word_chars).otherwise(0.0)
    return judged.select(
        "doc_id", "n_words", word_chars.alias("word_chars"), "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & (lost <= max_lost)).alias("kept"),
        "verdict.cleaned", "verdict.failed", "verdict.lost_chars", lost.alias("lost"),
    )
