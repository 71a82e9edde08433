"""The sentiment expressions against the published rule, word by word."""

import math
import re
import string

import pytest
from pyspark.sql import functions as F

from clientele.functions import sentiment as S
from clientele.functions import wordlists as L
from clientele.operators import cleaning

LEXICON = {
    "good": 1.9, "great": 3.1, "bad": -2.5, "terrible": -2.1, "love": 3.2, "hate": -2.7,
    "nice": 1.8, "ass": -2.5, "bomb": -2.2, "kind": 2.4, "fine": 0.8, "no": -1.2, "happy": 2.7,
    "shit": -2.6, "kiss": 1.8, "death": -2.9, "so": 0.3, "least": 0.0,
}
BOOSTERS = {w: L.BOOST for w in L.INTENSIFIERS} | {
    w: -L.BOOST for w in L.DAMPENERS + L.DAMPENER_PAIRS
}


def split_words(text):
    out = []
    for token in text.split():
        if len(token) < 2:
            continue
        for mark in L.HANGING_PUNCTUATION:
            for core in {token.removeprefix(mark) if token.startswith(mark) else "",
                         token.removesuffix(mark) if token.endswith(mark) else ""}:
                if len(core) > 1 and not set(core) & set(string.punctuation):
                    token = core
        out.append(token)
    return out


def plain_compound(text, lexicon):
    words = split_words(text)
    low = [w.lower() for w in words]
    capitals = sum(w.isupper() for w in words)
    mixed = 0 < capitals < len(words)
    scores = []
    for item in words:
        i = words.index(item)
        if item.lower() in BOOSTERS or (
            item.lower() == "kind" and i + 1 < len(words) and low[i + 1] == "of"
        ):
            scores.append(0.0)
            continue
        if item.lower() not in lexicon:
            scores.append(0.0)
            continue
        v = lexicon[item.lower()]
        if item.isupper() and mixed:
            v += L.CAPS_BOOST if v > 0 else -L.CAPS_BOOST
        for back in (1, 2, 3):
            if i < back or low[i - back] in lexicon:
                continue
            before, s = words[i - back], 0.0
            if before.lower() in BOOSTERS:
                s = BOOSTERS[before.lower()] * (-1 if v < 0 else 1)
                if before.isupper() and mixed:
                    s += L.CAPS_BOOST if v > 0 else -L.CAPS_BOOST
            v += s * (1, 0.95, 0.9)[back - 1]
            negated = before.lower() in L.NEGATIONS or "n't" in before.lower()
            near = [words[i - k] if i >= k else "" for k in range(4)]
            if back == 2 and near[2] == "never" and near[1] in ("so", "this"):
                v *= 1.5
            elif back == 3 and ((near[3] == "never" and near[2] in ("so", "this")) or near[1] in ("so", "this")):
                v *= 1.25
            elif negated:
                v *= L.NEGATION_FACTOR
            if back == 3:
                for a, b in ((1, 0), (2, 0), (2, 1), (3, 1), (3, 2)):
                    phrase = " ".join(words[i - a : i - b + 1])
                    if phrase in L.IDIOMS:
                        v = L.IDIOMS[phrase]
                        break
                for ahead in (1, 2):
                    if i + ahead < len(words):
                        v = L.IDIOMS.get(" ".join(words[i : i + ahead + 1]), v)
                if {f"{near[3]} {near[2]}", f"{near[2]} {near[1]}"} & BOOSTERS.keys():
                    v -= L.BOOST
        if i > 0 and low[i - 1] == "least" and "least" not in lexicon:
            if not (i > 1 and low[i - 2] in ("at", "very")):
                v *= L.NEGATION_FACTOR
        scores.append(v)
    if "but" in low:
        turn = low.index("but")
        scores = [s * (0.5 if p < turn else 1.5 if p > turn else 1) for p, s in enumerate(scores)]
    total = math.fsum(scores)
    extra = min(text.count("!"), 4) * 0.292
    asks = text.count("?")
    extra += 0 if asks < 2 else asks * 0.18 if asks <= 3 else 0.96
    total += extra if total > 0 else -extra if total < 0 else 0
    return round(total / math.sqrt(total * total + 15), 4)


SENTENCES = [
    "good", "The food was good.", "The food was GOOD", "ALL CAPS GOOD", "very good", "VERY good food",
    "extremely very good", "really quite very good", "slightly bad", "kind of good", "it was kind of good",
    "the kind people of town", "not good", "isn't good", "this is not so good", "never so good",
    "it was never this good at all", "never been so good", "without doubt good", "hardly a good place",
    "the food was good but the service was terrible", "but good", "good but", "BUT it was good",
    "great! great! great!", "great!!!!!!", "bad?", "bad??", "bad???", "bad????", "good :) great",
    "at least good", "very least good", "least good", "it is least good", "the least bad thing",
    "that movie was the bomb", "he is a bad ass", "he is such a bad ass dude", "yeah right good man",
    "this was the kiss of death for me", "you know this shit is the shit", "they live hand to mouth good times",
    "it is just enough good", "more or less sort of good thing", "no good", "no, good", "I don't hate it",
    "(great) \"good\" 'good' -good good- good...", "good,bad", "love love hate", "Love LOVE hate so much",
    "I love it so very much but NOT the hate!", "", "x", "nothing here", "fine fine bad",
    "It wasn’t good", "so good this bad", "despite all good things bad happened and no one was happy",
    "UTTERLY bad service and ABSOLUTELY hate it", "Utterly BAD", "good bad\ttext\ngreat",
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(
        [(str(i), t) for i, t in enumerate(SENTENCES)] + [("none", None)], "review_id string, text string"
    )


def lexicon_frame(spark, lexicon):
    return spark.createDataFrame(list(lexicon.items()), "word string, valence double")


@pytest.mark.parametrize("dropped", [(), ("least", "so", "no"), ("kind", "bomb", "ass", "kiss")])
def test_rule(spark, texts, dropped):
    lexicon = {w: v for w, v in LEXICON.items() if w not in dropped}
    valence = S.inline_lexicon(lexicon_frame(spark, lexicon))
    rows = texts.select("text", S.compound(F.col("text"), valence).alias("c")).collect()
    for row in rows:
        expected = 0.0 if row.text is None else plain_compound(row.text, lexicon)
        assert row.c == pytest.approx(expected, abs=1.01e-4), row.text


def test_words(spark, texts):
    for row in texts.where("text IS NOT NULL").select("text", S.spoken_words(F.col("text")).alias("w")).collect():
        assert row.w == split_words(row.text), row.text


def test_documents_score_like_the_rule(spark):
    lexicon = {"the": 0.9, "of": -0.7, "and": 1.3, "was": -1.9, "de": -0.4, "und": -0.9, "los": 1.4}
    valence = S.inline_lexicon(lexicon_frame(spark, lexicon))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for row in docs.select("text", S.compound(F.col("text"), valence).alias("c")).collect():
        assert row.c == pytest.approx(plain_compound(row.text, lexicon), abs=1.01e-4)


def test_labels_include_their_bounds(spark):
    df = spark.createDataFrame([(0.05,), (0.0499,), (-0.05,), (-0.0499,), (0.0,)], "c double")
    labels = [r[0] for r in df.select(S.label(F.col("c"))).collect()]
    assert labels == ["positive", "neutral", "negative", "neutral", "neutral"]


def test_a_large_lexicon_is_joined_with_the_same_result(spark, texts, monkeypatch):
    lexicon = lexicon_frame(spark, LEXICON)
    small = cleaning.with_sentiment(texts, lexicon).collect()
    monkeypatch.setattr(S, "MAX_INLINE_WORDS", 3)
    assert S.inline_lexicon(lexicon) is None
    large = cleaning.with_sentiment(texts, lexicon)
    assert "Join" in large._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, large.select("review_id", "text", "sentiment").collect())) == sorted(map(str, small))


def test_text_is_scored_without_python_or_shuffle(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("review_id", F.col("doc_id"))
    plan = cleaning.with_sentiment(docs, lexicon_frame(spark, LEXICON))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow", plan)


def test_lexicon_words_are_taken_as_written(spark):
    """Emoticons may differ by case only; texts are looked up in lower case."""
    valence = S.inline_lexicon(lexicon_frame(spark, {":D": 2.3, ":d": 1.2, "Good": 3.0}))
    df = spark.createDataFrame([("so :D",), ("Good",)], "text string")
    got = [r.c for r in df.select(S.compound(F.col("text"), valence).alias("c")).collect()]
    assert got == [pytest.approx(plain_compound("so :D", {":d": 1.2}), abs=1e-4), 0.0]


def test_missing_text_is_not_looked_up(spark):
    """A review without a text costs no words and no lexicon."""
    refuse = S.Lexicon(F.raise_error(F.lit("looked up")).cast("string"), lambda data, word: data.cast("double"))
    rows = spark.createDataFrame([(None,), (None,)], "text string")
    assert [r[0] for r in rows.select(S.compound(F.col("text"), refuse)).collect()] == [0.0, 0.0]


def test_hanging_marks_before_and_after_spaces(spark):
    said = " 'well'  (no) !!great!!  ok, x 'y' \"fine\" ---a- a--bb  "
    rows = spark.createDataFrame([(said,), ("",), ("  ",), ("ab",)], "text string")
    got = [r[0] for r in rows.select(S.spoken_words(F.col("text"))).collect()]
    assert got == [split_words(said), [], [], ["ab"]]
