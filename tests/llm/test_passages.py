"""Substring and suffix deduplication against counting every window."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from clientele.llm import anchors, substrings, suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 2**63


def passages(seed, n=40):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)] + ["é", "日本", "x#"]
    shared = [" ".join(rng.choice(vocabulary) for _ in range(k)) for k in (30, 49, 50, 51, 60, 90, 200)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            text = rng.choice(shared)
            if rng.random() < 0.4:
                words = text.split()
                text = " ".join(words[rng.randrange(len(words)):])
            parts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 30))), text]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(parts)))
    rows += [(n, rows[3][1]), (n + 1, "ab " * 300), (n + 2, "ab " * 300 + "z"), (n + 3, "é" * 400)]
    rng.shuffle(rows)
    return rows


def brute_words(rows):
    first, out = {}, []
    listed = [(LAST if i is None else i, i, WORD.findall(t or "")) for i, t in rows]
    for key, _, words in listed:
        for s in range(len(words) - 49):
            window = tuple(words[s:s + 50])
            first[window] = min(first.get(window, LAST + 1), key)
    for key, i, words in listed:
        gone = set()
        for s in range(len(words) - 49):
            if first[tuple(words[s:s + 50])] < key:
                gone.update(range(s, s + 50))
        kept = " ".join(w for n, w in enumerate(words) if n not in gone)
        out.append((str(i), len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def brute_bytes(rows):
    first, out = {}, []
    data = [(LAST if i is None else i, i, (t or "").encode()) for i, t in rows]
    for key, _, text in data:
        for s in range(len(text) - 99):
            first[text[s:s + 100]] = min(first.get(text[s:s + 100], (LAST + 1, 0)), (key, s))
    for key, i, text in data:
        gone = bytearray(len(text))
        for s in range(len(text) - 99):
            if first[text[s:s + 100]] < (key, s):
                gone[s:s + 100] = b"\1" * 100
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        spans = sum(1 for n, g in enumerate(gone) if g and not (n and gone[n - 1]))
        out.append((str(i), len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def by_words(docs):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest())
                  for r in substrings.remove_repeated_passages(docs).collect())


def by_bytes(docs):
    return sorted((str(r["row"]["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
                  for r in suffixes.remove_repeated_strings(docs).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_words(documents, seed):
    rows = passages(seed)
    assert by_words(documents(rows)) == brute_words(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(documents, seed):
    rows = passages(seed)
    assert by_bytes(documents(rows)) == brute_bytes(rows)


def test_odd_documents(odd_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert by_words(odd_documents) == brute_words(rows)
    assert by_bytes(odd_documents) == brute_bytes(rows)
    assert suffixes.cut_texts(odd_documents).columns == odd_documents.columns


def test_factors_point_at_equal_words(documents):
    rows = passages(5)
    texts = {i: WORD.findall(t) for i, t in rows}
    for r in substrings.remove_repeated_passages(documents(rows)).collect():
        for f in r["factors"]:
            if f["ref_doc"] is not None:
                own = texts[r["doc_id"]][f["start"]:f["start"] + f["length"]]
                assert f["length"] >= 50 and f["ref_doc"] < r["doc_id"]
                assert own == texts[f["ref_doc"]][f["ref_start"]:f["ref_start"] + f["length"]]


def test_equal_windows_pick_equal_anchors(monkeypatch):
    """Whatever surrounds a window and wherever pieces are cut."""
    rng = np.random.default_rng(1)
    tokens = anchors.mixed(rng.integers(0, 50, 4000, dtype=np.uint64))
    tokens[3000:3200] = tokens[100:300]
    hashes = anchors.RollingHash(12345)

    def picks():
        runs = anchors.anchored_runs(tokens, np.array([1500, 0, 2500]), 40, 6, hashes)
        begin = np.array([0, 1500, 1500])
        return {int(begin[t] + s): (int(a - s), int(g)) for t, f, l, a, g in zip(*runs, strict=True) for s in range(f, l + 1)}

    whole = picks()
    assert sorted(whole) == [*range(0, 1461), *range(1500, 3961)]
    assert all(whole[100 + k] == whole[3000 + k] for k in range(161))
    monkeypatch.setattr(anchors, "PIECE", 100)
    assert picks() == whole


def test_buckets_in_small_pieces(monkeypatch):
    """Runs of one anchor that are sorted in many pieces still find their first."""
    rng = random.Random(3)
    base = bytes(rng.choice(b"abcd") for _ in range(160))
    rows = [(7, doc, 1, 10 * start, 5, base[:100 + rng.randrange(0, 60)]) for doc in range(30) for start in range(2)]
    names = ["gram", "doc", "part", "start", "offset", "bytes"]
    def found(limit):
        monkeypatch.setattr(suffixes, "_SORT_BYTES", limit)
        batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)
        gone = {}
        for out in suffixes._repeated(iter([batch])):
            for doc, _, a, b in zip(*(c.to_pylist() for c in out.columns), strict=True):
                gone.setdefault(doc, set()).update(range(a, b))
        return gone

    assert found(10**9) == found(1) == found(500)


def test_whole_copies_refer_to_their_bearer(documents):
    text = " ".join(f"w{i}" for i in range(60))
    out = {r["doc_id"]: r["factors"] for r in substrings.remove_repeated_passages(
        documents([(3, text), (7, text), (9, text)])).collect()}
    assert out[3] == []
    assert [tuple(f) for f in out[7]] == [tuple(f) for f in out[9]] == [(0, 60, 3, 0)]
