"""Exact removal of repeated byte strings by sorted, sampled suffixes.

A byte goes if it lies in a string of ``LENGTH`` bytes that starts earlier, too:
in a document with a smaller id, or before in the same one.

Sorting every suffix would move each text a hundred times.  Instead suffixes are
sampled at anchors (see ``anchors``): equal strings pick the same anchor at the
same offset, so only suffixes that start at equal anchors have to meet.  An
anchor stands for the run of strings that picked it and travels with the bytes
of that run.  Anchors that occur once are settled by a count and carry no bytes.

Sampled splitters range-partition the anchored suffixes by their leading bytes;
ranges never cut between suffixes with equal anchors.  A bucket sorts its strings by most significant 8-byte words first, going on only
with those still equal to another (a multikey quicksort over words), and the
earliest of equal strings stays.  Strings of a run whose bytes as a whole repeat
an earlier run are settled without sorting.  Removed runs from different buckets meet per document, where
those that touch across boundaries become one span.

Comparison is exact; hashes only choose anchors and group equal runs.

Defined results: null text has no bytes; rows that repeat a doc_id do not count
as earlier than each other at equal starts; null ids come after all others;
copies of a whole text lose all bytes if there are ``LENGTH``; an empty table
gives no rows; other columns are ignored.  The strings of one anchor are sorted
in one task, in pieces: it keeps the different runs of that anchor in memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.anchors import RollingHash, Runs, anchored_runs, distinct_in_text
from clientele.llm.contents import by_content
from clientele.llm.setsketch import mixed

LENGTH = 100
GRAM = 20
_GROUP_BYTES = 500_000
# Bytes of different runs that are sorted together.
_SORT_BYTES = 1_500_000
# Documents whose anchors are looked at for splitters, about.
SPLITTER_DOCS = 2000
_GRAMS = RollingHash(0x9E3779B97F4A7C15)
_BYTE_TOKENS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
# Offsets of the 8-byte words that cover a string; the last two overlap.
_WORD_OFFSETS = [*range(0, LENGTH - 8, 8), LENGTH - 8]


def _grouped(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and lengths of successive groups of a batch's texts."""
    texts, first, held = [], 0, 0
    for row, text in enumerate(batch.column("text")):
        texts.append(text.as_buffer() if hasattr(text, "as_buffer") else text.as_py().encode())
        held += len(texts[-1])
        if held >= _GROUP_BYTES:
            yield first, np.frombuffer(b"".join(texts), np.uint8), np.fromiter(map(len, texts), np.int64)
            texts, first, held = [], row + 1, 0
    if texts:
        yield first, np.frombuffer(b"".join(texts), np.uint8), np.fromiter(map(len, texts), np.int64)


def _runs(data: np.ndarray, lengths: np.ndarray) -> Runs:
    return anchored_runs(_BYTE_TOKENS[data], lengths, LENGTH, GRAM, _GRAMS)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs = batch.column("doc").to_numpy()
        for first, data, lengths in _grouped(batch):
            runs = _runs(data, lengths)
            rows, n = distinct_in_text(runs.text, runs.gram)
            yield pa.RecordBatch.from_arrays(
                [pa.array(runs.gram[rows]), pa.array(docs[first + runs.text[rows]]), pa.array(n.astype(np.int32))],
                ["gram", "doc", "n"])


def _leading(raw: bytes, places: np.ndarray) -> np.ndarray:
    """The first eight bytes of the suffixes at ``places``, as numbers in byte order."""
    return np.frombuffer(b"".join([raw[a:a + 8] for a in places]), ">u8").astype(np.uint64)


def _lead_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, data, lengths in _grouped(batch):
            runs = _runs(data, lengths)
            # One in sixteen will do, chosen by content.
            few = runs.gram % 16 == 0
            begins = np.cumsum(lengths) - lengths
            leads = _leading(data.tobytes(), (begins[runs.text] + runs.anchor)[few])
            yield pa.RecordBatch.from_arrays([pa.array(leads.view(np.int64))], ["lead"])


def sampled_splitters(docs: DataFrame, buckets: int) -> np.ndarray:
    """Leading bytes that cut the anchored suffixes of about ``SPLITTER_DOCS``
    documents, chosen by hash of their id, into even ranges."""
    n = docs.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(2**32))
    few = docs.where(draw < F.lit(int(2**32 * min(1.0, SPLITTER_DOCS / max(n, 1)))))
    texts = few.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    leads = [r["lead"] for r in texts.mapInArrow(_lead_rows, "lead long").collect()]
    found = np.sort(np.array(leads, dtype=np.int64).view(np.uint64))
    return found[np.arange(1, buckets) * len(found) // buckets] if len(found) else found


def _run_rows(splitters: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, parts = batch.column("doc").to_numpy(), batch.column("part").to_numpy()
            shared = np.unique(batch.column("grams").flatten().to_numpy())
            for first, data, lengths in _grouped(batch):
                runs = _runs(data, lengths)
                hit = np.isin(runs.gram, shared)
                text, start, last, anchor, gram = (column[hit] for column in runs)
                begins = (np.cumsum(lengths) - lengths)[text]
                raw = data.tobytes()
                cut = [raw[a:b] for a, b in zip(begins + start, begins + last + LENGTH, strict=True)]
                bucket = np.searchsorted(splitters, _leading(raw, begins + anchor), side="right")
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket.astype(np.int32)), pa.array(gram), pa.array(docs[first + text]), pa.array(parts[first + text]),
                    pa.array(start.astype(np.int32)), pa.array((anchor - start).astype(np.int32)), pa.array(cut, pa.binary()),
                ], ["bucket", "gram", "doc", "part", "start", "offset", "bytes"])

    return run


def equal_strings(data: np.ndarray, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each string of ``LENGTH`` bytes, the first position in ``starts`` of an equal
    one of its group, found by sorting words, most significant first."""
    n = len(starts)
    first = np.arange(n)
    if n < 2:
        return first
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    word = np.zeros(len(data), dtype=np.uint64)
    for k in range(8):
        word |= padded[k:k + len(data)] << np.uint64(56 - 8 * k)
    left = np.argsort(group, kind="stable")
    classes = group[left]
    for offset in _WORD_OFFSETS:
        key = word[starts[left] + offset]
        order = np.lexsort((key, classes))
        left, classes, key = left[order], classes[order], key[order]
        fresh = np.r_[True, (classes[1:] != classes[:-1]) | (key[1:] != key[:-1])]
        # Strings equal to no other are done.
        single = fresh & np.r_[fresh[1:], True]
        classes = np.cumsum(fresh)[~single]
        left = left[~single]
        if not len(left):
            return first
    heads = np.flatnonzero(np.r_[True, classes[1:] != classes[:-1]])
    sizes = np.diff(np.r_[heads, len(left)])
    first[left] = np.repeat(np.minimum.reduceat(left, heads), sizes)
    return first


class Rows(NamedTuple):
    """Runs of one bucket by column; ``data`` holds their bytes one behind the other."""

    gram: np.ndarray
    doc: np.ndarray
    part: np.ndarray
    start: np.ndarray
    offset: np.ndarray
    size: np.ndarray
    data: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch) -> Rows:
        columns = [batch.column(c).to_numpy().astype(np.int64) for c in ("gram", "doc", "part", "start", "offset")]
        cut = batch.column("bytes")
        ends = np.frombuffer(cut.buffers()[1], np.int32)[cut.offset:cut.offset + len(cut) + 1].astype(np.int64)
        data = np.frombuffer(cut.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]] if len(cut) else np.empty(0, np.uint8)
        return Rows(*columns, np.diff(ends), data)

    @staticmethod
    def joined(parts: list[Rows]) -> Rows:
        return Rows(*map(np.concatenate, zip(*parts, strict=True)))

    def take(self, at: np.ndarray) -> Rows:
        begins = np.cumsum(self.size) - self.size
        return Rows(*(c[at] for c in self[:6]), self.data[_spread(begins[at], self.size[at])])


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` of each start, ``count`` numbers each, in order."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


def _first_equal_run(rows: Rows) -> np.ndarray:
    """For each run the first one with the same anchor, offset and bytes."""
    ends = np.cumsum(rows.size)
    raw = memoryview(rows.data.tobytes())
    digests = [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip((ends - rows.size).tolist(), ends.tolist(), strict=True)]
    names = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    key = mixed(names[:, 0] ^ mixed(rows.gram.view(np.uint64)) ^ rows.offset.astype(np.uint64))
    _, earliest, of = np.unique(key, return_index=True, return_inverse=True)
    first = earliest[of]
    same = (names[first] == names).all(axis=1) & (rows.size[first] == rows.size)
    same &= (rows.gram[first] == rows.gram) & (rows.offset[first] == rows.offset)
    return np.where(same, first, np.arange(len(first)))


def _removed(rows: Rows, n_seen: int) -> tuple[tuple[np.ndarray, ...], Rows]:
    """Removed runs (doc, part, start, end) of ``rows`` after the first ``n_seen``,
    which were dealt with before; and the different runs of the last anchor."""
    number = np.arange(len(rows.gram))
    origin = _first_equal_run(rows)
    different = np.flatnonzero(origin == number)
    lone = rows.take(different)
    counts = lone.size - LENGTH + 1
    owner = np.repeat(np.arange(len(different)), counts)
    places = _spread(np.cumsum(lone.size) - lone.size, counts)
    first = equal_strings(lone.data, places, np.unique(lone.gram, return_inverse=True)[1][owner])
    # A string goes if the first equal one lies elsewhere, which can only be before.
    start = _spread(lone.start, counts)
    gone = (lone.doc[owner] != lone.doc[owner][first]) | (start != start[first])
    at = np.flatnonzero(gone & (different[owner] >= n_seen))
    heads = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(owner[at]) != 0)]) if len(at) else at
    tails = np.r_[heads[1:], len(at)] - 1 if len(at) else at
    strings = (lone.doc[owner[at[heads]]], lone.part[owner[at[heads]]], start[at[heads]], start[at[tails]] + LENGTH)
    # A run that repeats an earlier one goes whole.
    again = np.flatnonzero((origin != number) & (number >= n_seen))
    again = again[(rows.doc[again] != rows.doc[origin[again]]) | (rows.start[again] != rows.start[origin[again]])]
    whole = (rows.doc[again], rows.part[again], rows.start[again], rows.start[again] + rows.size[again])
    kept = lone.take(np.flatnonzero(lone.gram == rows.gram[-1]))
    return tuple(map(np.concatenate, zip(strings, whole, strict=True))), kept


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit(found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        kinds = (np.int64, np.int32, np.int32, np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(c.astype(k)) for c, k in zip(found, kinds, strict=True)], ["doc", "part", "start", "end"])

    held: list[Rows] = []
    n_seen, size = 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(Rows.of(batch))
        size += len(held[-1].data)
        if size >= _SORT_BYTES:
            found, seen = _removed(Rows.joined(held), n_seen)
            yield emit(found)
            # The next batch may go on with the same anchor.
            held, n_seen, size = [seen], len(seen.gram), 0
    if held:
        yield emit(_removed(Rows.joined(held), n_seen)[0])


def _snapped(data: bytes, start: int, end: int) -> tuple[int, int]:
    """The part of a span that cuts no UTF-8 character."""
    while start < end and data[start] & 0xC0 == 0x80:
        start += 1
    while start < end < len(data) and data[end] & 0xC0 == 0x80:
        end -= 1
    return start, end


def _cutter(whole_characters: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            parts = batch.column("part").to_pylist()
            for text, part, spans in zip(batch.column("text"), parts, batch.column("spans"), strict=True):
                data = text.as_py().encode("utf-8", "surrogatepass")
                pieces, done, count = [], 0, 0
                for a, b in _merged(spans, part):
                    if whole_characters:
                        a, b = _snapped(data, a, b)
                    if a < b:
                        pieces.append(data[done:a])
                        done = b
                        count += 1
                pieces.append(data[done:])
                rest = b"".join(pieces)
                n_bytes.append(len(data))
                n_removed.append(len(data) - len(rest))
                n_spans.append(count)
                kept.append(rest)
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary()),
            ], ["row", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def _merged(spans: pa.ListScalar, part: int) -> list[tuple[int, int]]:
    """Spans of one text in order, those that touch or overlap as one."""
    if not spans.is_valid:
        return []
    of, start, end = (spans.values.field(i).to_numpy() for i in range(3))
    own = of == part
    order = np.argsort(start[own], kind="stable")
    start, reach = start[own][order], np.maximum.accumulate(end[own][order])
    if not len(start):
        return []
    heads = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
    return list(zip(start[heads].tolist(), reach[np.r_[heads[1:], len(start)] - 1].tolist(), strict=True))


def remove_repeated_strings(docs: DataFrame, carry: list[str] | None = None, whole_characters: bool = False) -> DataFrame:
    """row (the carried columns), n_bytes, n_removed, n_spans and kept (binary).

    ``whole_characters`` leaves characters whole of which only a part repeats, so
    that what is kept is UTF-8 again.
    """
    carry = carry or ["doc_id"]
    n_bytes = F.octet_length("text").cast("long")
    short, copies, bearers = by_content(docs, carry, n_bytes >= LENGTH, n_bytes=n_bytes)
    # All three uses take the same columns, so that the texts are shuffled once.
    anchors = bearers.mapInArrow(_anchor_rows, "gram long, doc long, n int")
    shared = anchors.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1")
    lists = (
        anchors.join(shared.select("gram"), "gram", "left_semi")
        .groupBy("doc").agg(F.collect_set("gram").alias("grams"))
    )
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = bearers.join(lists, "doc").mapInArrow(
        _run_rows(sampled_splitters(docs, buckets)), "bucket int, gram long, doc long, part int, start int, offset int, bytes binary")
    spans = (
        runs.repartitionById(buckets, "bucket").drop("bucket").sortWithinPartitions("gram", "doc", "start")
        .mapInArrow(_repeated, "doc long, part int, start int, end int")
        .groupBy("doc").agg(F.collect_list(F.struct("part", "start", "end")).alias("spans"))
    )
    found = bearers.join(spans, "doc", "left")
    cut = found.mapInArrow(
        _cutter(whole_characters),
        f"row {dict(found.dtypes)['row']}, n_bytes long, n_removed long, n_spans long, kept binary")
    nothing = F.lit(0).cast("long")
    return (
        cut
        .unionByName(copies.select(
            "row", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
            F.lit("").cast("binary").alias("kept")))
        .unionByName(short.select(
            "row", n_bytes.alias("n_bytes"), nothing.alias("n_removed"), nothing.alias("n_spans"),
            F.col("text").cast("binary").alias("kept")))
    )


def cut_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text``, and ``n_chars`` as it is then."""
    rest = [c for c in docs.columns if c != "text"]
    cut = remove_repeated_strings(docs, rest, whole_characters=True)
    out = cut.select("row.*", F.col("kept").cast("string").alias("text")).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
