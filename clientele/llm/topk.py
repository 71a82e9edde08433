"""Exact top-k by inner product: a ball tree per shard, branch and bound.

The top levels of one ball tree, built on a sample of ``SAMPLE_ROWS`` vectors at
most, divide all vectors into cells; large cells are dealt into shards of about
``SHARD_ROWS``.  The sample only divides: every vector is indexed, and the radius
of a cell is that of all its vectors.  Each shard builds a ball tree of its own; a
node bounds the inner product of a query with everything below it by
``q . centre + |q| * radius``.  A query visits leaves in the order of their
bounds and stops at the first one that cannot beat its current kth score.

Searching goes in two rounds.  In the first, every query searches the shard it
lies in itself, which gives it a kth score.  In the second, it goes to the shards
of those cells only whose bound reaches that shared score: the others are dropped
before anything is shuffled, and candidates stay in their shards.  A shard that
more than ``BLOCK_QUERIES`` queries ask is searched block by block of them.
Answers are merged per query.

Cells are 4,096 at most; their centres and radii are all that is gathered and
handed to the tasks.  Shards and blocks have fixed sizes and grow in number, and a
task holds one shard and one block.

Scores are exact integers at any size: where the norms show that float64 sums are
exact they are used, then 64-bit integers, then Python's; a score that does not
fit 64 bits is an error, as is a component.

Defined results: vectors that are null or hold a null or non-finite component
take no part, nor do rows without an id; rows that repeat id and vector count
once; a row is never an answer to a query with its own id; ties go to the smaller
id; shorter vectors count as padded with zeros; a query with fewer candidates
returns them all; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientele.sources.files import cut_lineage

SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
LEAF_ROWS = 64
SAMPLE_ROWS = 32_768
MAX_CELLS = 4096
FOUND = "query_id long, query_hash long, vec_id long, score long"
_LONG = 2**63


def usable(vector: Column) -> Column:
    """True for vectors without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def whole_steps(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, as integers; an error where one does not fit 64 bits."""
    def step(x: Column) -> Column:
        y = scale * x.cast("double")
        # Beyond 53 bits a double is whole, so it fits before rounding down if it does after.
        fits = (y >= -float(_LONG)) & (y < float(_LONG))
        return F.when(fits, F.floor(y).cast("long")).otherwise(
            F.raise_error(F.lit("a vector component does not fit 64 bits")).cast("long"))

    return F.transform(vector, step)


def _norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))


def _slack(norms: np.ndarray, reach: float, width: int) -> np.ndarray:
    """More than rounding can take off a bound or a score whose factors have these norms."""
    return 1 + norms * reach * 1e-15 * (width + 16)


class ExactScores:
    """Inner products of rows of two integer matrices, exact.

    The norms decide once how they are computed, since no partial sum exceeds
    their product.  A score above 64 bits is an error; one below them is -2**63,
    an error where it is an answer (``search``).
    """

    def __init__(self, queries: np.ndarray, points: np.ndarray):
        largest = _norms(queries).max(initial=0) * _norms(points).max(initial=0) * (1 + 1e-9)
        kind = np.float64 if largest < 2**53 else np.int64 if largest < _LONG else object
        self.queries, self.points, self.kind = queries.astype(kind), points.astype(kind), kind
        # Score and row together order as one 64-bit number.
        self.packs = largest * (len(points) + 1) < 2**62

    def __call__(self, of: np.ndarray, rows: np.ndarray, skipped: np.ndarray) -> np.ndarray:
        scores = self.queries[of] @ self.points[rows].T
        if self.kind is object and scores.size:
            scores = np.where(skipped, 0, scores)
            if scores.max() >= _LONG:
                raise OverflowError("a score does not fit 64 bits")
            scores = np.maximum(scores, -_LONG)
        return scores.astype(np.int64)


class _Best:
    """The ``k`` best rows of every query so far, ties to the smaller row."""

    def __init__(self, n_queries: int, k: int, n_rows: int, packs: bool):
        self.n, self.k, self.packs = n_rows, k, packs
        # Packed, or scores with their rows; -1 is no row yet.
        self.scores = np.full((n_queries, k), -_LONG, dtype=np.int64)
        self.rows = None if packs else np.full((n_queries, k), -1, dtype=np.int64)

    def add(self, of: np.ndarray, scores: np.ndarray, rows: np.ndarray, skipped: np.ndarray) -> np.ndarray:
        """Adds ``rows`` to the queries ``of``; their kth scores, the lowest number where there are fewer."""
        if self.packs:
            packed = scores * self.n + (self.n - 1 - rows)
            packed[skipped] = -_LONG
            merged = np.concatenate([self.scores[of], packed], axis=1)
            best = np.partition(merged, merged.shape[1] - self.k, axis=1)[:, -self.k:]
            self.scores[of] = best
            least = best.min(axis=1)
            return np.where(least > -_LONG, least // self.n, -_LONG)
        merged = np.concatenate([self.scores[of], scores], axis=1)
        row = np.concatenate([self.rows[of], np.where(skipped, -1, rows)], axis=1)
        last = np.lexsort((-row, merged, row >= 0), axis=1)[:, -self.k:]
        self.rows[of], self.scores[of] = np.take_along_axis(row, last, 1), np.take_along_axis(merged, last, 1)
        return np.where((self.rows[of] >= 0).all(axis=1), self.scores[of].min(axis=1), -_LONG)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, row and score of every answer."""
        query, place = np.nonzero(self.scores > -_LONG if self.packs else self.rows >= 0)
        score = self.scores[query, place]
        if self.packs:
            return query, self.n - 1 - score % self.n, score // self.n
        if (score == -_LONG).any():
            raise OverflowError("a score does not fit 64 bits")
        return query, self.rows[query, place], score


class BallTree:
    """Leaves of a ball tree over the rows of a matrix, with the path to each."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.points = points.astype(np.float64)
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self.children: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray] = []
        self.leaf_rows = leaf_rows
        self._grow(np.arange(len(points)))

    def _grow(self, rows: np.ndarray) -> int:
        node, below = len(self.centres), self.points[rows]
        centre = below.mean(axis=0)
        self.centres.append(centre)
        self.radii.append(float(np.sqrt(((below - centre) ** 2).sum(axis=1).max())))
        self.rows.append(rows)
        self.children.append(None)
        if len(rows) > self.leaf_rows:
            axis = int(np.argmax(below.max(axis=0) - below.min(axis=0))) if below.shape[1] else 0
            half = len(rows) // 2
            order = np.argpartition(below[:, axis], half) if below.shape[1] else np.arange(len(rows))
            self.children[node] = (self._grow(rows[order[:half]]), self._grow(rows[order[half:]]))
        return node

    def leaf_bounds(self, queries: np.ndarray, kth: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Rows of each leaf and each query's upper bound there.

        Walks down from the root; queries whose kth score a node cannot reach do
        not descend, and their bound below it is minus infinity.
        """
        queries = queries.astype(np.float64)
        norms = _norms(queries)
        leaves, bounds = [], []

        def bound(node: int, of: np.ndarray) -> np.ndarray:
            reach = self.radii[node] + float(np.sqrt((self.centres[node] ** 2).sum()))
            upper = queries[of] @ self.centres[node] + norms[of] * self.radii[node]
            return upper + _slack(norms[of], reach, queries.shape[1])

        def walk(node: int, of: np.ndarray, parent: np.ndarray) -> None:
            upper = np.minimum(bound(node, of), parent)
            alive = upper >= kth[of]
            of, upper = of[alive], upper[alive]
            if not len(of):
                return
            if self.children[node] is None:
                column = np.full(len(queries), -np.inf)
                column[of] = upper
                leaves.append(self.rows[node])
                bounds.append(column)
            else:
                for child in self.children[node]:
                    walk(child, of, upper)

        walk(0, np.arange(len(queries)), np.full(len(queries), np.inf))
        return leaves, np.stack(bounds, axis=1) if bounds else np.empty((len(queries), 0))


def search(ids: np.ndarray, points: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
           kth: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best ``k`` of each query among ``points``, as (query row, id, score).

    ``kth`` holds scores already reached elsewhere; lower ones are left out.
    """
    order = np.argsort(ids, kind="stable")
    ids, points = ids[order], points[order]
    tree = BallTree(points)
    leaves, bounds = tree.leaf_bounds(queries, kth)
    score_of = ExactScores(queries, points)
    # Rows stand in the order of their ids.
    best = _Best(len(queries), k, len(ids), score_of.packs)
    reached = kth.copy()
    visit = np.argsort(-bounds, axis=1, kind="stable")
    for turn in range(len(leaves)):
        leaf = visit[:, turn]
        active = np.flatnonzero(bounds[np.arange(len(queries)), leaf] >= reached)
        active = active[np.isfinite(bounds[active, leaf[active]])]
        if not len(active):
            break
        by_leaf = active[np.argsort(leaf[active], kind="stable")]
        starts = np.flatnonzero(np.r_[True, np.diff(leaf[by_leaf]) != 0])
        for of in np.split(by_leaf, starts[1:]):
            rows = leaves[leaf[of[0]]]
            own = ids[rows][None, :] == query_ids[of][:, None]
            kth_here = best.add(of, score_of(of, rows, own), rows, own)
            reached[of] = np.where(kth_here > -_LONG, np.maximum(reached[of], kth_here), reached[of])
    query_row, row, score = best.found()
    # As numbers both are rounded alike, so no score that reaches kth is left out.
    keep = score.astype(np.float64) >= kth[query_row]
    return query_row[keep], ids[row[keep]], score[keep]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _searched(k: int):
    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(candidates) or not len(queries):
            return pd.DataFrame({"query_id": [], "query_hash": [], "vec_id": [], "score": []}).astype("int64")
        width = max(map(len, [*candidates["vector"], *queries["query"]]))
        row, ids, score = search(
            candidates["vec_id"].to_numpy(np.int64), _matrix(candidates["vector"], width),
            queries["query_id"].to_numpy(np.int64), _matrix(queries["query"], width),
            queries["kth"].to_numpy(np.float64), k,
        )
        return pd.DataFrame({
            "query_id": queries["query_id"].to_numpy(np.int64)[row],
            "query_hash": queries["query_hash"].to_numpy(np.int64)[row],
            "vec_id": ids, "score": score,
        })

    return run


@dataclass
class Cells:
    """The top of a ball tree: splits (axis, threshold, below, above; a cell is written as
    -1 - cell) with the centre of every cell, and the radius of all its vectors once known."""

    splits: list[tuple[int, float, int, int]]
    centres: np.ndarray
    radii: np.ndarray | None = None

    @classmethod
    def divide(cls, sample: np.ndarray, cells: int) -> Cells:
        splits: list[tuple[int, float, int, int]] = []
        centres: list[np.ndarray] = []

        def grow(rows: np.ndarray, wanted: int) -> int:
            spread = rows.max(axis=0) - rows.min(axis=0) if rows.size else np.zeros(1)
            if wanted < 2 or len(rows) < 2 or not spread.max():
                centres.append(rows.mean(axis=0) if len(rows) else np.zeros(sample.shape[1]))
                return -len(centres)
            axis = int(np.argmax(spread))
            values = np.sort(rows[:, axis])
            # The widest gap in the middle half, which leaves groups together.
            low, high = len(values) // 4, len(values) - len(values) // 4
            gap = low + int(np.argmax(np.diff(values[low:high]))) if high - low > 1 else low
            threshold = values[min(gap + 1, len(values) - 1)]
            if threshold == values[0]:
                threshold = values[np.searchsorted(values, values[0], side="right")]
            node = len(splits)
            splits.append((axis, threshold, 0, 0))
            above = rows[:, axis] >= threshold
            splits[node] = (axis, threshold, grow(rows[~above], wanted - wanted // 2), grow(rows[above], wanted // 2))
            return node

        grow(sample.astype(np.float64), cells)
        return cls(splits, np.array(centres))

    def place(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of every row and the distance from its centre."""
        rows = rows.astype(np.float64)
        at = np.zeros(len(rows), dtype=np.int64) if self.splits else np.full(len(rows), -1)
        while (at >= 0).any():
            for node in np.unique(at[at >= 0]):
                axis, threshold, below, above = self.splits[node]
                here = np.flatnonzero(at == node)
                at[here] = np.where(rows[here, axis] >= threshold, above, below)
        cell = -1 - at
        return cell, np.sqrt(((rows - self.centres[cell]) ** 2).sum(axis=1))

    def reached(self, queries: np.ndarray, kth: np.ndarray) -> np.ndarray:
        """Whether a cell (column) may hold a score of ``kth`` or more for a query (row)."""
        queries, norms = queries.astype(np.float64), _norms(queries)
        reach = (self.radii + _norms(self.centres)).max(initial=0)
        upper = queries @ self.centres.T + norms[:, None] * self.radii[None, :]
        held = np.isfinite(self.radii)[None, :]
        return held & (upper + _slack(norms, reach, queries.shape[1])[:, None] >= kth[:, None])


def _placer(sent, width: int):
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell, far = sent.value.place(_matrix(batch["vector"], width))
            yield batch.assign(cell=cell.astype(np.int32), far=far)

    return place


def _pruner(sent, width: int):
    """Repeats every query for the cells that its bound reaches."""

    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 256):
                some = batch.iloc[start:start + 256]
                row, cell = np.nonzero(sent.value.reached(
                    _matrix(some["query"], width), some["kth"].to_numpy(np.float64)))
                yield some.iloc[row].assign(cell=cell.astype(np.int32))

    return prune


def cells_of(rows: DataFrame, n_rows: int, width: int, shard_rows: int) -> Cells:
    """Cells for ``rows``, fitted on a sample drawn by hash."""
    wanted = min(MAX_CELLS, -(-n_rows // shard_rows))
    drawn = F.pmod(F.xxhash64("vector", "vec_id", F.lit("sample")), F.lit(2**40)) < int(min(1, SAMPLE_ROWS / max(1, n_rows)) * 2**40)
    sample = rows.where(drawn).select("vector").limit(2 * SAMPLE_ROWS).toPandas() if wanted > 1 else {"vector": []}
    return Cells.divide(_matrix(sample["vector"], width), wanted)


def exact_top_k(vectors: DataFrame, is_query: Column, k: int,
                shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """Best ``k`` rows for each query row of ``vectors`` (vec_id, vector of integers).

    Returns query_id, rank (from 1), vec_id, score.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(
        vectors.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<long>").alias("vector"),
                F.coalesce(is_query, F.lit(False)).alias("is_query"))
        .dropDuplicates(["vec_id", "vector"])
    )
    n_rows, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    cells = cells_of(rows, n_rows, width, shard_rows)
    placed = cut_lineage(rows.mapInPandas(
        _placer(spark.sparkContext.broadcast(cells), width),
        "vec_id long, vector array<long>, is_query boolean, cell int, far double"))
    # One row a cell.
    held = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()
    cells.radii = np.full(len(cells.centres), -np.inf)
    for r in held:
        cells.radii[r["cell"]] = r["radius"]
    parts = F.broadcast(spark.createDataFrame(
        [(r["cell"], -(-r["n"] // shard_rows)) for r in held], "cell int, parts int"))
    sharded = placed.join(parts, "cell").withColumn(
        "part", F.pmod(F.xxhash64("vec_id", "vector"), F.col("parts")).cast("int"))
    candidates = sharded.select("cell", "part", "vec_id", "vector")
    queries = sharded.where("is_query").select(
        F.col("cell").alias("home"), F.col("part").alias("home_part"), F.col("vec_id").alias("query_id"),
        F.xxhash64("vector").alias("query_hash"), F.col("vector").alias("query"),
    )

    def answers(asking: DataFrame) -> DataFrame:
        """Searches shards (cell, part), each with the queries that ask it, block by block."""
        blocks = asking.groupBy("cell", "part").agg(F.ceil(F.count("*") / block_queries).cast("int").alias("blocks"))
        block = F.pmod(F.xxhash64("query_id", "query_hash"), F.col("blocks")).cast("int")
        by = ["asked_cell", "asked_part", "asked_block"]
        of_queries = asking.join(blocks, ["cell", "part"]).select(
            F.col("cell").alias(by[0]), F.col("part").alias(by[1]), block.alias(by[2]),
            "query_id", "query_hash", "query", "kth")
        of_shards = candidates.join(blocks, ["cell", "part"]).select(
            "cell", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "vec_id", "vector")
        return of_shards.groupBy("cell", "part", "block").cogroup(of_queries.groupBy(*by)).applyInPandas(_searched(k), FOUND)

    nothing_yet = F.lit(float("-inf")).alias("kth")
    at_home = cut_lineage(answers(queries.select(
        "query_id", "query_hash", "query", nothing_yet, F.col("home").alias("cell"), F.col("home_part").alias("part"))))
    key = ["query_id", "query_hash"]
    shared = at_home.groupBy(*key).agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("kth"))
    started = queries.join(shared, key, "left").withColumn("kth", F.coalesce("kth", nothing_yet))
    kept = ", ".join(f"{c} {t}" for c, t in started.dtypes)
    asking = (
        started.mapInPandas(_pruner(spark.sparkContext.broadcast(cells), width), f"{kept}, cell int")
        .join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .where((F.col("cell") != F.col("home")) | (F.col("part") != F.col("home_part")))
        .select("query_id", "query_hash", "query", "kth", "cell", "part")
    )
    best = Window.partitionBy(*key).orderBy(F.col("score").desc(), "vec_id")
    return (
        at_home.unionByName(answers(asking))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
