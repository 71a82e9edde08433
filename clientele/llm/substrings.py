"""Substring deduplication by relative Lempel-Ziv parsing, over words.

Every document is parsed against all documents with smaller ids: a factor is a
run of words that stands in one of them.  Factors shorter than a window of
``WINDOW`` words stay literal; longer ones are duplicate spans.

The reference is indexed in blocks, the hash partitions of all windows that can
repeat: windows whose anchor (see ``anchors``) also occurs in another document.
Text of its own is settled by its anchors, one row for about twenty words.  Each
indexed window knows its earliest document and a place in it.  Parsing walks a
document's found windows in order and extends a factor as long as the next window's
earliest place is the next one of the same document; a factor is not the longest
match.  Where it breaks off, the next window starts another, so that windows across a
factor boundary are looked up like all others and no covered word is missed.

The earliest place of a window is a minimum with map-side combining, and the
join that brings it back is split where a passage is frequent.

Words are compared by 64-bit hashes, windows by 96 bits of two independent ones.

Defined results: null and blank texts have no words; texts under ``WINDOW``
words lose none; rows that repeat a doc_id never count as earlier than each
other; null ids come after all others; words keep their form and are joined by
one space; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.anchors import RollingHash, Runs, anchored_runs, distinct_in_text
from clientele.llm.contents import by_content
from clientele.llm.words import word_count, words

WINDOW = 50
GRAM = 6
_AT_LEAST_A_WINDOW = (
    rf"\A[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){{{WINDOW - 1}}}[^\x20\x09-\x0D]")
# Words parsed together in a task; a longer document is one group.
_GROUP_WORDS = 100_000
_FACTORS = "array<struct<start: int, length: int, ref_doc: bigint, ref_start: int>>"
_GRAMS, _FIRST, _SECOND = RollingHash(0x9E3779B97F4A7C15), RollingHash(0xC2B2AE3D27D4EB4F), RollingHash(0xD6E8FEB86659FD93)


def _word_hashes(text: str) -> np.ndarray:
    # bytes.split cuts at exactly the six separators of words.
    found = text.encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def _grouped(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, word hashes and lengths of successive groups of a batch's texts."""
    hashes, first, held = [], 0, 0
    for row, text in enumerate(batch.column("text")):
        hashes.append(_word_hashes(text.as_py()))
        held += len(hashes[-1])
        if held >= _GROUP_WORDS:
            yield first, np.concatenate(hashes), np.fromiter(map(len, hashes), np.int64)
            hashes, first, held = [], row + 1, 0
    if hashes:
        yield first, np.concatenate(hashes), np.fromiter(map(len, hashes), np.int64)


def _runs(tokens: np.ndarray, lengths: np.ndarray) -> Runs:
    return anchored_runs(tokens, lengths, WINDOW, GRAM, _GRAMS)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs = batch.column("doc").to_numpy()
        for first, tokens, lengths in _grouped(batch):
            runs = _runs(tokens, lengths)
            rows, _ = distinct_in_text(runs.text, runs.gram)
            yield pa.RecordBatch.from_arrays(
                [pa.array(runs.gram[rows]), pa.array(docs[first + runs.text[rows]])], ["gram", "doc"])


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, parts = batch.column("doc").to_numpy(), batch.column("part").to_numpy()
        shared = np.unique(batch.column("grams").flatten().to_numpy())
        for first, tokens, lengths in _grouped(batch):
            runs = _runs(tokens, lengths)
            begins = np.cumsum(lengths) - lengths
            hit = np.isin(runs.gram, shared)
            text, start, last = runs.text[hit], runs.first[hit], runs.last[hit]
            counts = last - start + 1
            step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            of, place = np.repeat(text, counts), np.repeat(start, counts) + step
            if not len(of):
                continue
            name = _FIRST(tokens, WINDOW).view(np.int64)
            rows, _ = distinct_in_text(of, name[begins[of] + place])
            of, place = of[rows], place[rows]
            at = begins[of] + place
            yield pa.RecordBatch.from_arrays([
                pa.array(name[at]), pa.array(_SECOND(tokens, WINDOW)[at].view(np.int64).astype(np.int32)),
                pa.array(docs[first + of]), pa.array(parts[first + of]), pa.array(place.astype(np.int32)),
            ], ["h", "g", "doc", "part", "place"])


def _everywhere(found: np.ndarray, text: str) -> np.ndarray:
    """``found`` with the other places at which the text has the same windows."""
    names = _FIRST(_word_hashes(text), WINDOW)
    known, of = np.unique(names[found[:, 0]], return_index=True)
    at = np.minimum(np.searchsorted(known, names), len(known) - 1)
    places = np.flatnonzero(known[at] == names)
    return np.column_stack([places, found[of[at[places]], 1:]])


def parse(found: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Factors (start, length, ref_doc, ref_start) from found windows in order.

    ``found`` has columns place, ref_doc, ref_place, sorted by place.
    """
    if not len(found):
        return []
    place, doc, ref = found.T
    breaks = np.flatnonzero(np.r_[True, (np.diff(place) != 1) | (np.diff(doc) != 0) | (np.diff(ref) != 1)])
    ends = np.r_[breaks[1:], len(place)] - 1
    return [(int(place[a]), int(place[b] - place[a]) + WINDOW, int(doc[a]), int(ref[a]))
            for a, b in zip(breaks, ends, strict=True)]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept, factors = [], [], [], []
        for text, part, hits in zip(batch.column("text"), batch.column("part").to_pylist(), batch.column("found"), strict=True):
            listed = text.as_py().encode("utf-8", "surrogatepass").split()
            rows = np.empty((0, 3), dtype=np.int64)
            if hits.is_valid:
                columns = [hits.values.field(i).to_numpy() for i in range(4)]
                rows = np.stack([c[columns[0] == part].astype(np.int64) for c in columns[1:]], axis=1)
                rows = _everywhere(rows, text.as_py()) if len(rows) else rows
            found = parse(rows)
            edge = np.zeros(len(listed) + 1, dtype=np.int64)
            for start, length, _, _ in found:
                edge[start] += 1
                edge[start + length] -= 1
            stay = np.cumsum(edge[:-1]) == 0
            n_words.append(len(listed))
            n_removed.append(int(len(listed) - stay.sum()))
            kept.append(b" ".join([listed[i] for i in np.flatnonzero(stay)]).decode("utf-8", "surrogatepass"))
            factors.append([dict(zip(("start", "length", "ref_doc", "ref_start"), f, strict=True)) for f in found])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())]))
        yield pa.RecordBatch.from_arrays([
            batch.column("row").field(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
            pa.array(kept, pa.string()), pa.array(factors, kind),
        ], ["doc_id", "n_words", "n_removed", "kept", "factors"])


def remove_repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text) and factors of every document.

    A later copy of a whole text has one factor, the whole text of its bearer.
    """
    n_words = word_count(F.col("text"))
    # The pattern looks no further than the words it needs.
    is_long = F.col("text").rlike(_AT_LEAST_A_WINDOW)
    short, copies, bearers = by_content(docs, ["doc_id"], is_long, n_words=n_words)
    # All three uses take the same columns, so that the texts are shuffled once.
    anchors = bearers.mapInArrow(_anchor_rows, "gram long, doc long")
    shared = anchors.groupBy("gram").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high")
    lists = (
        anchors.join(shared.select("gram"), "gram", "left_semi")
        .groupBy("doc").agg(F.collect_set("gram").alias("grams"))
    )
    windows = bearers.join(lists, "doc").mapInArrow(
        _window_rows, "h long, g int, doc long, part int, place int")
    index = windows.groupBy("h", "g").agg(
        F.min("doc").alias("ref_doc"), F.min_by("place", "doc").alias("ref_place"), F.max("doc").alias("high"),
    ).where("ref_doc < high").drop("high")
    found = (
        windows.join(index, ["h", "g"]).where("doc > ref_doc")
        .groupBy("doc").agg(F.collect_list(F.struct("part", "place", "ref_doc", "ref_place")).alias("found"))
    )
    parsed = bearers.join(found, "doc", "left").mapInArrow(
        _parsed, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_removed long, kept string, factors {_FACTORS}")
    whole = F.array(F.struct(
        F.lit(0).alias("start"), F.col("n_words").cast("int").alias("length"),
        F.col("first").alias("ref_doc"), F.lit(0).alias("ref_start")))
    return (
        parsed
        .unionByName(copies.select(
            "row.doc_id", "n_words", F.col("n_words").alias("n_removed"), F.lit("").alias("kept"),
            whole.cast(_FACTORS).alias("factors")))
        .unionByName(short.select(
            "row.doc_id", n_words.alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
            F.array_join(words(F.col("text")), " ").alias("kept"), F.array().cast(_FACTORS).alias("factors")))
    )
