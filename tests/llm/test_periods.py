"""Periodic runs against a scan of every period."""

import hashlib
import random
import zlib

import pytest

from clientele.llm import periods
from clientele.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(words, at_least=12):
    """Runs (start, length, period), by start, then period."""
    best = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - p:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j < len(words) - p and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(at_least, 2 * p):
                best.setdefault((i, j + p - i), p)
            i = j
    return sorted(((s, n, p) for (s, n), p in best.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_texts(seed, n=60):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        words, alphabet = [], rng.choice([1, 2, 3, 40])
        while len(words) < rng.randrange(1, 300):
            unit = [f"w{rng.randrange(alphabet)}" for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 16, 17, 31]))]
            words += (unit * rng.choice([1, 1, 2, 3, 6]))[: rng.randrange(1, 120)]
        texts.append(" ".join(words))
    return texts


def check(df, texts, at_least):
    rows = {r["row"]["doc_id"]: r for r in df.collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        words = (text or "").split()
        runs = brute(words, at_least)
        assert [tuple(r) for r in rows[i]["runs"]] == runs
        assert rows[i]["n_words"] == len(words) and rows[i]["collapsed"] == collapsed(words, runs)


@pytest.mark.parametrize("tile_words", [8, 32, 1 << 16])
@pytest.mark.parametrize("at_least", [4, 12, 20])
def test_against_scan(spark, documents, tile_words, at_least):
    texts = periodic_texts(at_least)
    df = periods.collapse_runs(documents(list(enumerate(texts))).repartition(3), at_least, tile_words)
    check(df, texts, at_least)


def test_tiles_cover_every_interval():
    for n in (9, 40, 333, 5000):
        for low in (1, 2, 4, 8, 16, 64, 256, 1024):
            least = max(12, 2 * low)
            spans = [(s, e) for a, b, s, e in periods.tiles(n, 16) if a <= low < b]
            for start in range(0, n - least - 2 * low, 7):
                assert any(s <= start and start + least + 2 * low <= e for s, e in spans)


def test_one_word_again_and_again(spark, documents):
    """A very long text of one word has one run, although every period fits."""
    n = 300_000
    row = periods.collapse_runs(documents([(0, "a " * n)]), tile_words=1 << 12).first()
    assert [tuple(r) for r in row["runs"]] == [(0, n, 1)] and row["collapsed"] == "a"


def test_odd_rows(spark, odd_documents):
    rows = periods.collapse_runs(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        assert r["row"]["name"] == "x" and r["n_words"] == len((r["row"]["text"] or "").split())
        assert list(r["runs"]) == [] and r["collapsed"] == " ".join((r["row"]["text"] or "").split())


def test_copies_share_runs(spark, documents):
    """Many copies, null ids among them, come back each."""
    text = "x y z " * 10 + "end"
    rows = [(None if i % 2 else i, text) for i in range(500)]
    got = periods.collapse_runs(documents(rows).repartition(7)).collect()
    assert len(got) == 500
    assert {(tuple(map(tuple, r["runs"])), r["collapsed"]) for r in got} == {(((0, 30, 3),), "x y z end")}


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    planted = 0
    for d in docs:
        words = [w.decode() for w in (d["text"] or "").encode().split()]
        h = zlib.crc32(str(d["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a, planted = g % n, planted + 1
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        best = min(((-m, s, p) for s, m, p in runs), default=None)
        listed = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
        r = got[d["doc_id"]]
        assert r["n_runs"] == len(runs)
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (
            (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4)
        assert r["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert planted > 5
