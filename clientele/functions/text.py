"""Words of a text and its most frequent words, as plain Column expressions.

Everything here works inside one row: no token ever leaves the row it came
from, so the text column is scanned once and never shuffled, and no Python
worker is started.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clientele.functions.columns import let
from clientele.functions.wordlists import STOP_WORDS

# White space, ASCII and beyond.
SPACE = r"\s\p{Z}\x1c-\x1f\x85"
# Characters that always stand alone.
LONE = r"""\[\](){}<>"«»“”‘’„`;@#$%&?!*"""
# What ends a word: a space, a lone character, a dash, an ellipsis, doubled
# quotes, a comma or colon not followed by a digit, a full stop not followed
# by more of the word.
_AFTER_STOP = rf"[{SPACE}:,{LONE}]|--|''|\z"
BREAK = rf"(?=[{SPACE}{LONE}]|\z|[,:](?!\d)|\.(?:\.|{_AFTER_STOP})|--|'')"
# A word may also end in a contraction: it|'s, they|'ll, the dogs|'.
ENDING = rf"'(?:s|m|d|ll|re|ve)?{BREAK}"
# Spoken contractions that are two words, and do|n't.
FUSED = rf"(?:can(?=not{BREAK})|(?:gim|lem)(?=me{BREAK})|(?:gon|wan)(?=na{BREAK})|got(?=ta{BREAK}))"
NEGATED = rf"\p{{L}}+(?=n't{BREAK})"
# Anything else up to the next break: numbers, hyphenated words, addresses.
OTHER = rf"(?:[^{SPACE}{LONE}.,:'\-]|\.(?!\.|{_AFTER_STOP})|[,:](?=\d)|-(?!-)|'(?!'))++"
# The text is read left to right; group 1 holds the purely alphabetic words.  A space
# is taken along with what follows it: alone, it would fail every alternative first.
LEXER = rf" ?+(?:({FUSED}|\p{{L}}++(?={BREAK}|{ENDING})|{NEGATED})|\.\.++|--|''|{OTHER})"


def words(text: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    """Lower-case alphabetic words of ``text`` in order, without stop words."""
    found = F.regexp_extract_all(F.lower(text), F.lit(LEXER), F.lit(1))
    return F.filter(found, lambda w: ~w.isin(["", *stop_words]))


def most_common(items: Column, k: int) -> Column:
    """The ``k`` most frequent entries of an array; the earlier one wins a tie.

    Plain sorting brings equal words together, so the counts are the distances
    between run starts.  Positions are looked up only for the words above the
    kth count; those level with it follow in the order of the text.
    """

    def counted(ordered: Column) -> Column:
        starts = F.filter(
            F.transform(ordered, lambda w, i: F.when((i == 0) | (w != F.get(ordered, i - 1)), i)),
            lambda i: i.isNotNull(),
        )
        return let(starts, lambda s: F.transform(s, lambda start, n: F.struct(
            (start - F.coalesce(F.get(s, n + 1), F.size(ordered))).alias("minus_count"),
            F.get(ordered, start).alias("w"),
        )))

    def words_of(entries: Column) -> Column:
        return F.transform(entries, lambda e: e["w"])

    def top(counts: Column, cut: Column) -> Column:
        above = F.filter(counts, lambda c: cut.isNull() | (c["minus_count"] < cut))
        placed = F.transform(above, lambda c: F.struct(
            c["minus_count"].alias("minus_count"), F.array_position(items, c["w"]).alias("first"), c["w"].alias("w"),
        ))
        level = words_of(F.filter(counts, lambda c: c["minus_count"] == cut))
        in_text_order = F.array_intersect(F.array_distinct(items), level)
        return let(words_of(F.sort_array(placed)), lambda first: F.concat(
            first, F.slice(in_text_order, F.lit(1), F.lit(k) - F.size(first))))

    def chosen(counts: Column) -> Column:
        kth = F.get(F.sort_array(F.transform(counts, lambda c: c["minus_count"])), F.lit(k - 1))
        return let(kth, lambda cut: top(counts, cut))

    return let(F.sort_array(items), lambda ordered: let(counted(ordered), chosen))


def top_words(text: Column, k: int = 10, stop_words: list[str] = STOP_WORDS) -> Column:
    """The ``k`` most frequent words of a text; no words for a missing text."""
    found = let(words(text, stop_words), lambda found: most_common(found, k))
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(found)
