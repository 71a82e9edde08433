"""Rule-based sentiment (VADER, Hutto & Gilbert 2014) as Column expressions.

A text's valence words are looked up in a caller-given lexicon; capitals,
boosters, negations, idioms, "but", "!" and "?" around them adjust the score,
which is then squashed to (-1, 1).  All of it happens inside the row.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions import wordlists as L
from clientele.functions.columns import let
from clientele.functions.text import SPACE

# Largest lexicon that is sent along with the plan; bigger ones are joined.
MAX_INLINE_WORDS = 20_000

# Any of the fixed hanging marks, longer ones first; one look at the next character
# keeps letters and spaces from trying them all.
_HANGING = "(?=[" + "".join("\\" + c for c in sorted({m[0] for m in L.HANGING_PUNCTUATION})) + "])(?:" + "|".join(
    "".join("\\" + c for c in mark) for mark in sorted(L.HANGING_PUNCTUATION, key=len, reverse=True)
) + ")"
_END = rf"(?![^{SPACE}])"
_PLAIN = rf"[^\p{{Punct}}{SPACE}]{{2,}}+"
# A word of two characters or more, with the space before it; one hanging mark before
# or after it goes.
_WORD = (
    rf" ?+(?:{_HANGING}(?={_PLAIN}{_END}))?"
    rf"({_PLAIN}(?=(?:{_HANGING})?{_END})|[^{SPACE}]{{2,}}+)"
    rf"(?:{_HANGING}{_END})?"
)

Valence = Callable[[Column], Column]


@dataclass(frozen=True)
class Lexicon:
    """Valences by word: ``data`` is evaluated once per row and ``find`` looks a
    word up in it, null when it is unknown."""

    data: Column
    find: Callable[[Column, Column], Column]


def spoken_words(text: Column) -> Column:
    """Words as written (case kept), one hanging punctuation mark removed."""
    return F.regexp_extract_all(text, F.lit(_WORD), F.lit(1))


def is_shouted(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


def _occurrences(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _emphasis(text: Column) -> Column:
    shouts = F.least(_occurrences(text, "!"), F.lit(L.MAX_EXCLAMATIONS)) * F.lit(L.EXCLAMATION_WEIGHT)
    asks = _occurrences(text, "?")
    doubt = (
        F.when(asks <= 1, 0.0)
        .when(asks <= 3, asks * F.lit(L.QUESTION_WEIGHT))
        .otherwise(L.MAX_QUESTION_WEIGHT)
    )
    return shouts + doubt


class _Context:
    """The words of one text and what surrounds position ``i``."""

    def __init__(self, written: Column, lowered: Column, mixed_case: Column, valence: Valence):
        self.written, self.lowered = written, lowered
        self.mixed_case, self.valence = mixed_case, valence

    def word(self, i: Column) -> Column:
        return F.get(self.written, i)

    def lower(self, i: Column) -> Column:
        return F.get(self.lowered, i)

    def phrase(self, i: Column, first: int, last: int) -> Column:
        return F.concat_ws(" ", *[self.word(i + d) for d in range(first, last + 1)])

    def shouted(self, i: Column) -> Column:
        return self.mixed_case & is_shouted(self.word(i))

    def is_modifier(self, i: Column) -> Column:
        """Boosters, dampeners and the "kind" of "kind of" carry no valence."""
        here = self.lower(i)
        return here.isin(L.INTENSIFIERS + L.DAMPENERS) | (
            (here == "kind") & F.coalesce(self.lower(i + 1) == "of", F.lit(False))
        )

    def boost(self, i: Column, k: Column, score: Column) -> Column:
        """Push from the booster ``k`` words back, in the direction of the score."""
        before = self.lower(i - k)
        push = F.when(before.isin(L.INTENSIFIERS), L.BOOST).when(before.isin(L.DAMPENERS), -L.BOOST)
        push = push * F.when(score < 0, -1.0).otherwise(1.0) + F.when(
            self.shouted(i - k), F.when(score > 0, L.CAPS_BOOST).otherwise(-L.CAPS_BOOST)
        ).otherwise(0.0)
        damping = F.element_at(F.array(*[F.lit(d) for d in L.DISTANCE_DAMPING]), k)
        return F.coalesce(push * damping, F.lit(0.0))

    def negation(self, i: Column, k: Column) -> Column:
        """Factor for a negation ``k`` words back; "never so" strengthens."""
        before = self.lower(i - k)
        negated = before.isin(L.NEGATIONS) | before.contains("n't")

        def emphatic(back: int) -> Column:
            return self.word(i - back).isin("so", "this")

        def never(back: int) -> Column:
            return self.word(i - back) == "never"

        return (
            F.when((k == 2) & never(2) & emphatic(1), 1.5)
            .when((k == 3) & ((never(3) & emphatic(2)) | emphatic(1)), 1.25)
            .when(negated, L.NEGATION_FACTOR)
            .otherwise(1.0)
        )

    def idiom(self, i: Column, score: Column) -> Column:
        """Valence of an idiom that ends at, runs through or starts at ``i``."""
        table = F.create_map(*[F.lit(x) for pair in L.IDIOMS.items() for x in pair])

        def known(first: int, last: int) -> Column:
            complete = F.lit(True) if last <= 0 else i + last < F.size(self.written)
            return F.when(complete, F.try_element_at(table, self.phrase(i, first, last)))

        spans = [(0, 2), (0, 1), (-1, 0), (-2, 0), (-2, -1), (-3, -1), (-3, -2)]
        replaced = F.coalesce(*[known(a, b) for a, b in spans], score)
        hedged = self.phrase(i, -3, -2).isin(L.DAMPENER_PAIRS) | self.phrase(i, -2, -1).isin(
            L.DAMPENER_PAIRS
        )
        return replaced + F.when(hedged, -L.BOOST).otherwise(0.0)

    def least(self, i: Column) -> Column:
        """ "least good" negates; "at least" and "very least" do not."""
        plain = F.coalesce(self.lower(i - 2).isin("at", "very"), F.lit(False))
        negates = (self.lower(i - 1) == "least") & self.valence(self.lower(i - 1)).isNull() & ~plain
        return F.when(negates, L.NEGATION_FACTOR).otherwise(1.0)

    def score(self, i: Column, base: Column) -> Column:
        """Valence of the word at ``i`` after all rules on what precedes it."""
        loud = base + F.when(
            self.shouted(i), F.when(base > 0, L.CAPS_BOOST).otherwise(-L.CAPS_BOOST)
        ).otherwise(0.0)

        def look_back(score: Column, k: Column) -> Column:
            applies = (i >= k) & self.valence(self.lower(i - k)).isNull()
            pushed = (score + self.boost(i, k, score)) * self.negation(i, k)
            moved = let(pushed, lambda p: F.when(k == 3, self.idiom(i, p)).otherwise(p))
            return F.when(applies, moved).otherwise(score)

        return F.aggregate(F.array(F.lit(1), F.lit(2), F.lit(3)), loud, look_back) * self.least(i)

    def total(self) -> Column:
        """Sum over all words; a repeated word scores as at its first place.

        Each different word is scored once, however often it is used.
        """
        hits = F.filter(
            F.transform(self.lowered, lambda w, p: F.struct(p.alias("p"), self.valence(w).alias("v"))),
            lambda h: h["v"].isNotNull(),
        )
        turn = F.array_position(self.lowered, F.lit("but")).cast("int") - 1

        def place(words: Column, word: Column) -> Column:
            return F.array_position(words, word).cast("int") - 1

        def scored(word: Column) -> Column:
            return let(place(self.written, word), lambda i: F.when(self.is_modifier(i), 0.0).otherwise(
                self.score(i, self.valence(self.lower(i)))
            ))

        def weight(p: Column, but: Column) -> Column:
            return F.when(but < 0, 1.0).when(p < but, 0.5).when(p > but, 1.5).otherwise(1.0)

        def add_up(hits: Column, different: Column, scores: Column, but: Column) -> Column:
            def add(total: Column, hit: Column) -> Column:
                score = F.get(scores, place(different, self.word(hit["p"])))
                return total + score * weight(hit["p"], but)

            return F.aggregate(hits, F.lit(0.0), add)

        def of_hits(hits: Column) -> Column:
            different = F.array_distinct(F.transform(hits, lambda h: self.word(h["p"])))
            return let(different, lambda d: let(F.transform(d, scored), lambda scores: let(
                turn, lambda but: add_up(hits, d, scores, but)
            )))

        return let(hits, of_hits)


def compound(text: Column, lexicon: Lexicon) -> Column:
    """Compound score in (-1, 1), four decimals; 0 for a missing text."""

    def total(written: Column, valence: Valence) -> Column:
        mixed = F.exists(written, is_shouted) & F.exists(written, lambda w: ~is_shouted(w))
        lowered = F.transform(written, F.lower)
        return let(lowered, lambda low: let(
            mixed, lambda m: _Context(written, low, m, valence).total()
        ))

    def squash(total: Column) -> Column:
        loud = total + F.signum(total) * _emphasis(text)
        return let(loud, lambda s: F.round(s / F.sqrt(s * s + F.lit(L.NORMALISER)), 4))

    summed = let(lexicon.data, lambda data: let(
        spoken_words(text), lambda words: total(words, lambda w: lexicon.find(data, w))
    ))
    return F.when(text.isNull(), 0.0).otherwise(F.coalesce(let(summed, squash), F.lit(0.0)))


def label(score: Column) -> Column:
    return (
        F.when(score >= L.POSITIVE_FROM, "positive")
        .when(score <= L.NEGATIVE_UP_TO, "negative")
        .otherwise("neutral")
    )


def inline_lexicon(words: DataFrame) -> Lexicon | None:
    """A lexicon of (word, valence) small enough to travel with the plan.

    Texts are looked up in lower case, the lexicon's words are taken as written.
    The words are grouped by hash into a constant array of small maps, so a
    lookup reads one slot and compares a handful of words.  Returns None when
    there are more than ``MAX_INLINE_WORDS``.
    """
    unique = words.groupBy("word").agg(F.max("valence").alias("valence"))
    rows = unique.select("word", "valence", F.hash("word").alias("hash")).limit(MAX_INLINE_WORDS + 1).collect()
    if len(rows) > MAX_INLINE_WORDS:
        return None
    slots = max(1, len(rows) // 2)
    table: list[dict[str, float]] = [{} for _ in range(slots)]
    for row in rows:
        table[row["hash"] % slots][row["word"]] = row["valence"]
    constant = F.from_json(F.lit(json.dumps(table)), "array<map<string,double>>")

    def find(data: Column, word: Column) -> Column:
        return F.try_element_at(F.get(data, F.pmod(F.hash(word), F.lit(slots))), word)

    return Lexicon(constant, find)


def joined_lexicon(df: DataFrame, words: DataFrame, text: str) -> tuple[DataFrame, Lexicon]:
    """``df`` with the valences of each row's own words, for any lexicon size.

    Only the words of a text that the lexicon knows come back from the join, as
    one small map per text.  Texts are told by their MD5: what they say depends
    on nothing else, so rows need no key, and equal texts are looked up once.
    """
    known = words.groupBy("word").agg(F.max("valence").alias("valence"))
    said = F.array_distinct(F.transform(spoken_words(F.col(text)), F.lower))
    named = F.md5(F.col(text))
    found = (
        df.select(named.alias("text_name"), F.explode(said).alias("word"))
        .join(known, "word")
        .groupBy("text_name")
        .agg(F.map_from_entries(F.collect_set(F.struct("word", "valence"))).alias("known_words"))
    )
    return df.join(found, named == found["text_name"], "left"), Lexicon(F.col("known_words"), F.try_element_at)
