"""Suffix-tree scores against a model with plain dictionaries, and the base against counting."""

import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clientele.llm import suffixtree
from clientele.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


class Plain:
    def __init__(self, texts, depth, gain):
        self.depth = depth
        self.grams = [Counter() for _ in range(depth + 2)]
        read = [tokens(t) for t in texts]
        for t in read:
            self.grams[1].update((w,) for w in t)
        self.n, self.v = sum(self.grams[1].values()), len(self.grams[1])
        floor, _ = suffixtree.floors(self.n)
        for length in range(2, depth + 2):
            for t in read:
                for i in range(len(t) - length + 1):
                    gram = tuple(t[i:i + length])
                    if all(self.grams[1][(w,)] >= floor for w in gram):
                        self.grams[length][gram] += 1
            self.grams[length] = Counter({g: c for g, c in self.grams[length].items() if c >= floor})
        self.states = {}
        for length in range(1, depth + 1):
            by = {}
            for gram, c in self.grams[length + 1].items():
                by.setdefault(gram[:-1], {})[gram[-1]] = c
            for context, following in by.items():
                c, known = self.grams[length][context], sum(following.values())
                rest = (c - known + 1) / (c + 1)
                gained = (c - known) * math.log(rest)
                for w, k in following.items():
                    below = self.probability(context[1:], w)
                    gained += k * math.log((k / (c + 1) + rest * below) / below)
                if gained > gain * math.log(max(2, self.n)):
                    self.states[context] = (c, rest, following)

    def probability(self, history, word):
        """In the state of the longest suffix of ``history`` that is one."""
        out = (self.grams[1][(word,)] + 1) / (self.n + self.v + 1)
        for length in range(1, min(self.depth, len(history)) + 1):
            state = self.states.get(tuple(history[-length:]))
            if state:
                c, rest, following = state
                out = following.get(word, 0) / (c + 1) + rest * out
        return out

    def scores(self, text):
        read = tokens(text)
        base = sum(math.log10((self.grams[1][(w,)] + 1) / (self.n + self.v + 1)) for w in read)
        return base, sum(math.log10(self.probability(read[:i], w)) for i, w in enumerate(read))


def texts(seed, n=260):
    """Words that follow from the one or two words before them."""
    rng = random.Random(seed)
    follow = {}
    out = []
    for i in range(n):
        words = ["W0", "w1"]
        while len(words) < rng.randrange(3, 90):
            seen = follow.setdefault(tuple(words[-2:]), [f"w{rng.randrange(30)}" for _ in range(2)])
            words.append(rng.choice(seen) if rng.random() < 0.8 else f"w{rng.randrange(40)}")
        if i % 9 == 0:
            words.append(f"once{i}")
        out.append(rng.choice([" ", "\n"]).join(words))
    return [*out, None, "", " \t "]


@pytest.mark.parametrize("seed, depth, gain", [(1, 3, 2.0), (2, 2, 0.5), (3, 1, 2.0)])
def test_against_dictionaries(spark, documents, seed, depth, gain):
    rows = list(enumerate(texts(seed)))
    held = F.col("doc_id") % 4 == 1
    out = suffixtree.score_documents(documents(rows).repartition(5), ["doc_id"], held, depth, gain).collect()
    plain = Plain([t for i, t in rows if i % 4 != 1], depth, gain)
    assert plain.states and any(len(s) == depth for s in plain.states)
    by_id = {r["row"]["doc_id"]: r for r in out}
    assert len(by_id) == len(rows)
    for i, text in rows:
        r, (base, score) = by_id[i], plain.scores(text)
        assert r["held_out"] is (i % 4 == 1) and r["train_tokens"] == plain.n
        assert r["n_tokens"] == len(tokens(text))
        assert r["n_known"] == sum(plain.grams[1][(w,)] > 0 for w in tokens(text))
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-9)


def test_states_are_distributions():
    plain = Plain(texts(4), 3, 0.5)
    words = [w for (w,) in plain.grams[1]]
    for state in plain.states:
        total = sum(plain.probability(state, w) for w in words) + plain.probability(state, b"never seen")
        assert total == pytest.approx(1)


def test_query_and_held_out_gain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in QUERIES["op12_suffix_tree"](spark, SF).collect()}
    assert len(got) == len(docs)
    held = {d["doc_id"] for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 7 == 2}
    plain = Plain([d["text"] for d in docs if d["doc_id"] not in held], suffixtree.DEPTH, suffixtree.GAIN)
    for d in docs:
        r, (base, score) = got[d["doc_id"]], plain.scores(d["text"])
        assert r["held_out"] is (d["doc_id"] in held) and r["train_tokens"] == plain.n
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-9)
    out = [got[i] for i in held]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_nothing_to_learn_from(spark, documents):
    rows = suffixtree.score_documents(documents([(1, "a b"), (2, None)]), ["doc_id"], F.lit(True)).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in rows} == {
        (3, 0, 0, 0, 0), (1, 0, 0, 0, 0)}


def test_odd_rows(spark, odd_documents):
    out = suffixtree.score_documents(odd_documents, ["doc_id", "row", "text"], suffixtree.held_out(F.col("doc_id"))).collect()
    assert len(out) == odd_documents.count()
    for r in out:
        assert r["row"]["row"] == "x" and r["n_tokens"] == len((r["row"]["text"] or "").encode().split()) + 1
        assert r["held_out"] is (r["row"]["doc_id"] is not None and zlib.crc32(str(r["row"]["doc_id"]).encode()) % 7 == 2)


@pytest.mark.parametrize("head, heavy", [(0, 1 << 19), (7, 60), (1 << 18, 15), (1 << 18, 200)])
def test_what_is_held_or_dealt_changes_nothing(spark, documents, monkeypatch, head, heavy):
    """Frequent words and contexts of many tokens take other paths to the same scores."""
    rows = list(enumerate([*texts(5), *["w1 w2 w3 w4 w5"] * 40]))
    held = F.col("doc_id") % 4 == 1
    monkeypatch.setattr(suffixtree, "_HEAD", head)
    monkeypatch.setattr(suffixtree, "_HEAVY", heavy)
    out = suffixtree.score_documents(documents(rows).repartition(5), ["doc_id"], held, 3, 0.5).collect()
    plain = Plain([t for i, t in rows if i % 4 != 1], 3, 0.5)
    by_id = {r["row"]["doc_id"]: r for r in out}
    assert len(out) == len(by_id) == len(rows)
    for i, text in rows:
        r, (base, score) = by_id[i], plain.scores(text)
        assert r["n_known"] == sum(plain.grams[1][(w,)] > 0 for w in tokens(text))
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-9)


def test_grams_count_alike_in_small_and_large_corpora(spark, documents):
    """Five times a phrase are learned, however many other tokens there are."""
    phrase = "alpha beta gamma delta"
    for others in (200, 40_000):
        rows = [(i, phrase) for i in range(5)] + [(5 + k, " ".join(f"x{k}_{i}" for i in range(others // 4))) for k in range(4)]
        out = suffixtree.score_documents(documents(rows), ["doc_id"], F.lit(False)).collect()
        by_id = {r["row"]["doc_id"]: r for r in out}
        assert by_id[0]["train_tokens"] > others and by_id[0]["score"] > by_id[0]["base_score"] + 3
    assert suffixtree.floors(10) == suffixtree.floors(10**12)


def test_no_documents(spark, documents):
    assert suffixtree.score_documents(documents([(1, "a")]).limit(0), ["doc_id"], F.lit(False)).collect() == []


def test_chunks_are_never_shuffled_to_counts(spark, documents, monkeypatch):
    """Counts of heavy grams go to the files of the chunks, however many they are."""
    for name, value in (("_HEAVY", 15), ("_CHUNK", 300), ("_BUCKET", 2000)):
        monkeypatch.setattr(suffixtree, name, value)
    rows = list(enumerate(texts(6)))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        out = suffixtree.score_documents(documents(rows).repartition(3), ["doc_id"], F.col("doc_id") % 4 == 1, 3, 0.5)
        plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
        by_id = {r["row"]["doc_id"]: r["score"] for r in out.collect()}
    finally:
        spark.conf.unset(threshold)
    (scan,) = [i for i, line in enumerate(plan) if "FileScan" in line and "codes#" in line]
    assert "Bucketed: true" in plan[scan]
    assert "Sort [chunk#" in "".join(plan[scan - 4:scan]) and not any("Exchange" in line for line in plan[scan - 4:scan])
    plain = Plain([t for i, t in rows if i % 4 != 1], 3, 0.5)
    assert all(by_id[i] == pytest.approx(plain.scores(t)[1], rel=1e-9) for i, t in rows)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]
