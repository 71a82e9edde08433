"""Periodic runs of words: tiles per octave of periods, stitched per document and period.

A run is a stretch of words with smallest period q, at least ``at_least`` and
2 q words long, that no neighbouring word extends.  Words i and i + p are equal
all along a stretch of period p, so a run shows as an interval of such i, at
least as long as its period (``shortest``).

*Tiles.*  Periods are taken by octaves [P, 2P).  A document is exploded into
overlapping tiles, whose width grows with the octave (the octaves of short
periods share the narrowest tiles), so that each octave reads a document about
once and a tile never grows with its document, only with its periods.

*Boundaries.*  Inside a tile, an interval of an octave covers a whole block
between two boundaries, K words apart, K being P / 2 or less.  Blocks of
1, 2, 4, ... words are named, equal blocks of one tile alike.  A boundary and a
period are looked at when the block there has the same name p words on;
neighbouring boundaries that agree form one interval, and the Z-values of its
first boundary (backwards) and last one (forwards), the lengths over which the
text read from the boundary and from p words on agree, give its exact ends.
Names are numbers of equal blocks, not hashes, so nothing has to be checked
again.

*Stitching.*  An interval that goes beyond a tile is found in each, and
neighbouring tiles overlap by what it takes to find it.  Fragments are shuffled
by text and period, and joined where they touch.  Of runs that are the same
stretch the smallest period is kept.

Only texts with a fragment are shuffled; equal texts (by MD5) share their
fragments.  Finding is done once for the texts without any fragment, which leave
at once, and once for the others: the alternative, to send or store all texts,
moves the corpus.  A document is one Spark value (2 GB at most), its tiles are
solved one by one in the task that reads it.

Defined results: null, empty and blank texts have no words and no runs; repeated
rows, null ids and ties count each for itself, since results depend on the text
alone; an empty table gives no rows; all columns come back inside ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

AT_LEAST = 12
# Words of the narrowest tiles; a wider tile has TILE_PERIODS times its least period.
TILE_WORDS = 1 << 16
TILE_PERIODS = 8
# Words of small documents that are named together, and comparisons made at a time.
_BATCH_WORDS = 1 << 18
_COMPARED = 1 << 21

RUN = "struct<start:long,length:long,period:long>"
_FRAGMENTS = "array<struct<period:long,start:long,stop:long>>"


def shortest(period, at_least: int = AT_LEAST):
    """The least number of i with equal words i and i + period in a run."""
    return np.maximum(period, at_least - period)


def _block(octave: int, at_least: int) -> int:
    """Words between boundaries: every interval of the octave covers a whole block."""
    least = min(int(shortest(p, at_least)) for p in {octave, 2 * octave - 1, *range(octave, min(2 * octave, at_least + 1))})
    words = 1
    while 4 * words - 1 <= least:
        words *= 2
    return words


class _Names:
    """Names of the blocks of 1, 2, 4, ... words; -1 for blocks that occur once.

    ``codes`` starts and ends with words of their own, so that no block that is
    named reaches an end.
    """

    def __init__(self, codes: np.ndarray):
        self.of = {1: self._repeated(codes, np.arange(len(codes)), len(codes))}
        self.last = len(codes) - 1

    @staticmethod
    def _repeated(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        numbers, _ = pd.factorize(values)
        often = np.bincount(numbers)[numbers] > 1 if len(numbers) else np.zeros(0, bool)
        names = np.full(n, -1, dtype=np.int64)
        names[at[often]] = numbers[often]
        return names

    def level(self, words: int) -> np.ndarray:
        if words not in self.of:
            half = self.level(words // 2)
            at = np.flatnonzero(half >= 0)
            at = at[at + words // 2 <= self.last]
            at = at[half[at + words // 2] >= 0]
            pairs = half[at] * (half.max(initial=0) + 1) + half[at + words // 2]
            self.of[words] = self._repeated(pairs, at, len(half))
        return self.of[words]

    def agree(self, words: int, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Whether the blocks at ``at`` and ``period`` words on are equal."""
        names = self.level(words)
        inside = (at >= 0) & (at + period <= self.last)
        here = names[np.where(inside, at, 0)]
        return inside & (here >= 0) & (here == names[np.where(inside, at + period, 0)])


def _z_forward(names: _Names, at: np.ndarray, period: np.ndarray, block: int) -> np.ndarray:
    """How far, below ``block`` words, the text from ``at`` and ``period`` words on agree."""
    end, step = at.copy(), block // 2
    while step:
        end = np.where(names.agree(step, end, period), end + step, end)
        step //= 2
    return end


def _z_backward(names: _Names, at: np.ndarray, period: np.ndarray, block: int) -> np.ndarray:
    """The same, read backwards from before ``at``."""
    start, step = at.copy(), block // 2
    while step:
        start = np.where(names.agree(step, start - step, period), start - step, start)
        step //= 2
    return start


def _octave(names: _Names, octave: int, at_least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of equal words (period, start, stop) for the periods [octave, 2 octave)."""
    block = _block(octave, at_least)
    level = names.level(block)
    boundaries = np.arange(0, len(level), block)
    boundaries = boundaries[level[boundaries] >= 0]
    found_at, found_period = [], []
    periods = np.arange(octave, 2 * octave)
    step = max(1, _COMPARED // octave)
    for low in range(0, len(boundaries), step):
        some = boundaries[low:low + step]
        there = np.minimum(some[:, None] + periods[None, :], names.last)
        row, column = np.nonzero(level[there] == level[some][:, None])
        found_at.append(some[row])
        found_period.append(periods[column])
    if not found_at:
        return (np.empty(0, np.int64),) * 3
    at, period = np.concatenate(found_at), np.concatenate(found_period)
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    leads = np.r_[True, (period[1:] != period[:-1]) | (at[1:] != at[:-1] + block)] if len(at) else np.zeros(0, bool)
    first = np.flatnonzero(leads)
    last = np.r_[first[1:], len(at)][: len(first)] - 1
    period = period[first]
    start = _z_backward(names, at[first], period, block)
    stop = _z_forward(names, at[last] + block, period, block)
    long_enough = stop - start >= shortest(period, at_least)
    return period[long_enough], start[long_enough], stop[long_enough]


def tile_fragments(codes: np.ndarray, low: int, high: int, at_least: int = AT_LEAST) -> np.ndarray:
    """Rows (period, start, stop) of the intervals of a tile, for periods of octaves from ``low`` below ``high``.

    A multiple of a smaller period of the same stretch is left out.
    """
    names = _Names(np.concatenate([[-1], codes, [-2]]))
    parts, octave = [], low
    while octave < high and 2 * octave <= len(codes):
        if not (names.level(max(1, _block(octave, at_least))) >= 0).any():
            break
        period, start, stop = _octave(names, octave, at_least)
        parts.append(np.stack([period, start - 1, stop - 1], axis=1))
        octave *= 2
    found = np.concatenate(parts) if parts else np.empty((0, 3), dtype=np.int64)
    if len(found) > 1:
        # The smallest period of each stretch comes first among those that share it.
        end = found[:, 0] + found[:, 2]
        order = np.lexsort((found[:, 0], end, found[:, 1]))
        found, end = found[order], end[order]
        leads = np.r_[True, (found[1:, 1] != found[:-1, 1]) | (end[1:] != end[:-1])]
        least = found[np.flatnonzero(leads), 0][np.cumsum(leads) - 1]
        found = found[leads | (found[:, 0] % least != 0)]
    return found


def tiles(n_words: int, tile_words: int = TILE_WORDS, at_least: int = AT_LEAST) -> Iterator[tuple[int, int, int, int]]:
    """(low, high, start, stop): the octaves from ``low`` below ``high`` read words ``start`` to ``stop``.

    Starts lie ``core`` words apart; a tile goes on for as long as the shortest
    interval and the longest period of its octaves.
    """
    high = 1
    while TILE_PERIODS * high < tile_words:
        high *= 2
    low, core = 1, tile_words
    while low * 2 <= n_words:
        beyond = max(2 * high, at_least) + 2 * high
        for start in range(0, n_words, core):
            yield low, high, start, min(n_words, start + core + beyond)
            if start + core + beyond >= n_words:
                break
        low, high = high, 2 * high
        core = max(tile_words, TILE_PERIODS * low)


def text_fragments(texts: list[list[bytes]], at_least: int, tile_words: int) -> list[np.ndarray]:
    """The fragments (period, start, stop) of each list of words.

    Documents of one tile are named together, each with words of its own.
    """
    out: list[np.ndarray] = [np.empty((0, 3), dtype=np.int64)] * len(texts)
    small: list[int] = []

    def solve(several: list[int]) -> None:
        lengths = np.array([len(texts[i]) for i in several])
        words = pa.array([w for i in several for w in texts[i]], pa.binary()).dictionary_encode()
        codes = words.indices.to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(several)), lengths)
        codes = owner * len(words.dictionary) + codes
        # One word between documents that no other equals.
        apart = np.insert(codes, np.cumsum(lengths), -3 - np.arange(len(several)))
        offsets = np.cumsum(np.r_[0, lengths + 1])
        found = tile_fragments(apart, 1, 1 << 62, at_least)
        of = np.searchsorted(offsets, found[:, 1], side="right") - 1
        order = np.argsort(of, kind="stable")
        found, of = found[order], of[order]
        found[:, 1:] -= offsets[of][:, None]
        for i, part in zip(several, np.split(found, np.searchsorted(of, np.arange(1, len(several)))), strict=True):
            out[i] = part

    gathered = 0
    for i, words in enumerate(texts):
        if len(words) < at_least:
            continue
        if len(words) <= tile_words:
            small.append(i)
            gathered += len(words)
            if gathered >= _BATCH_WORDS:
                solve(small)
                small, gathered = [], 0
            continue
        codes = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
        parts = []
        for low, high, start, stop in tiles(len(words), tile_words, at_least):
            part = tile_fragments(codes[start:stop], low, high, at_least)
            part[:, 1:] += start
            parts.append(part)
        out[i] = np.concatenate(parts)
    if small:
        solve(small)
    return out


def _pieces(batch: pa.RecordBatch, bytes_each: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of bounded text, whatever the length of a row allows."""
    sizes = pa.compute.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > bytes_each:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows:
        yield batch.slice(start)


def _finder(at_least: int, tile_words: int, with_fragments: bool):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _pieces(whole):
                texts = [t.as_py().split() for t in batch.column("text")]
                found = text_fragments(texts, at_least, tile_words)
                chosen = [i for i, part in enumerate(found) if bool(len(part)) is with_fragments]
                rows = batch.column("row").take(pa.array(chosen, pa.int64()))
                if with_fragments:
                    parts = [found[i] for i in chosen]
                    flat = np.concatenate(parts) if parts else np.empty((0, 3), dtype=np.int64)
                    fragments = pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()),
                        pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], ["period", "start", "stop"]))
                    text = batch.column("text").take(pa.array(chosen, pa.int64()))
                    yield pa.RecordBatch.from_arrays([rows, text, fragments], ["row", "text", "fragments"])
                else:
                    joined = pa.array([b" ".join(texts[i]) for i in chosen], pa.binary())
                    n_words = pa.array([len(texts[i]) for i in chosen], pa.int64())
                    yield pa.RecordBatch.from_arrays([rows, n_words, joined], ["row", "n_words", "collapsed"])

    return find


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words that no run contains after its first period."""
    for batch in batches:
        counts, joined = [], []
        for text, runs in zip(batch.column("text"), batch.column("runs"), strict=True):
            words = text.as_py().split()
            change = np.zeros(len(words) + 1, dtype=np.int64)
            for run in runs.as_py():
                change[run["start"] + run["period"]] += 1
                change[run["start"] + run["length"]] -= 1
            kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
            counts.append(len(words))
            joined.append(b" ".join([words[i] for i in kept]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(counts, pa.int64()), batch.column("runs"), pa.array(joined, pa.binary())],
            ["row", "n_words", "runs", "collapsed"])


def stitch(fragments: DataFrame, at_least: int = AT_LEAST) -> DataFrame:
    """Runs of every ``name`` from the fragments (name, period, start, stop) of its tiles."""
    by_period = Window.partitionBy("name", "period").orderBy("start", "stop")
    before = by_period.rowsBetween(Window.unboundedPreceding, -1)
    joined = (
        fragments.distinct()
        .withColumn("reached", F.max("stop").over(before))
        .withColumn("opens", (F.col("reached").isNull() | (F.col("start") > F.col("reached"))).cast("int"))
        .withColumn("piece", F.sum("opens").over(by_period.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("name", "period", "piece").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
        .where(F.col("stop") - F.col("start") >= F.greatest(F.col("period"), F.lit(at_least) - F.col("period")))
        .groupBy("name", "start", (F.col("stop") - F.col("start") + F.col("period")).alias("length"))
        .agg(F.min("period").alias("period"))
    )
    run = F.sort_array(F.collect_list(F.struct("start", "period", "length")))
    return joined.groupBy("name").agg(
        F.transform(run, lambda r: F.struct(r["start"], r["length"], r["period"])).alias("runs"))


def collapse_runs(docs: DataFrame, at_least: int = AT_LEAST, tile_words: int = TILE_WORDS) -> DataFrame:
    """``row`` (all columns of ``docs``), n_words, runs (by start, then period) and the
    ``collapsed`` text: the words outside repeated periods, joined by one space."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.struct("*").alias("row"), text.alias("text"))
    row = f"row {rows.dtypes[0][1]}"
    plain = (
        rows.mapInArrow(_finder(at_least, tile_words, False), f"{row}, n_words long, collapsed binary")
        .withColumn("runs", F.array().cast(f"array<{RUN}>"))
    )
    # A row's name tells its text; all copies of a text have the same fragments.
    found = rows.mapInArrow(
        _finder(at_least, tile_words, True), f"{row}, text binary, fragments {_FRAGMENTS}"
    ).withColumn("name", F.md5("text"))
    runs = stitch(found.select("name", F.inline("fragments")), at_least)
    periodic = found.select("row", "text", "name").join(runs, "name").select("row", "text", "runs")
    collapsed = periodic.mapInArrow(_collapse, f"{row}, n_words long, runs array<{RUN}>, collapsed binary")
    return plain.unionByName(collapsed).withColumn("collapsed", F.col("collapsed").cast("string"))
