import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientele.llm import topk


def brute(rows, k, step):
    rows = [(i, np.array(v)) for i, v in sorted(set((i, tuple(v)) for i, v in rows))]
    width = max((len(v) for _, v in rows), default=0)
    padded = [(i, np.r_[v, np.zeros(width - len(v))]) for i, v in rows]
    out = set()
    for q, v in padded:
        if q % step == 0:
            best = sorted(((-int(v @ w), i) for i, w in padded if i != q))[:k]
            out |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)}
    return out


@pytest.mark.parametrize("spread", [1, 3, 40])
def test_against_brute_force(spark, spread):
    rng = random.Random(spread)
    rows = [(i, [rng.randrange(-spread, spread + 1) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(90)] + [(2000, [1, 2]), (2001, [])] + rows[:5]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>").repartition(3)
    got = topk.exact_top_k(df, F.col("vec_id") % 20 == 0, 7, shard_rows=64, block_queries=9)
    assert {tuple(r) for r in got.collect()} == brute(rows, 7, 20)


def test_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0]), (1, None), (2, [None]), (3, [nan]), (4, [inf]), (5, [2.0]), (None, [9.0]), (6, [-inf])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, vector array<double>, kth string")
    out = topk.exact_top_k(df, F.col("vec_id") == 0, 5).collect()
    assert [tuple(r) for r in out] == [(0, 1, 5, 2)]


def test_search_opens_few_leaves():
    rng = np.random.default_rng(0)
    centres = rng.integers(-50, 50, (40, 16))
    points = (np.repeat(centres, 100, axis=0) + rng.integers(-2, 3, (4000, 16))).astype(float)
    tree = topk.BallTree(points)
    leaves, bounds = tree.leaf_bounds(points[:1], np.array([np.sort(points @ points[0])[-20]]))
    assert np.isfinite(bounds).sum() < 0.2 * sum(c is None for c in tree.children)


def big(seed, bits, n=600, width=8):
    """Vectors whose inner products come near 2**bits, with ties in the last places."""
    rng = np.random.default_rng(seed)
    side = int(2 ** (bits / 2) / np.sqrt(width) * 0.99)
    points = rng.integers(side - 40, side + 1, (n, width))
    points[::3] = -points[::3]
    return [[int(x) for x in p] for p in points]


@pytest.mark.parametrize("bits", [49, 52, 54, 60, 62.5])
def test_large_scores_are_exact(spark, bits):
    rows = list(enumerate(big(int(bits), bits)))
    largest = max(sum(x * x for x in v) for _, v in rows)
    assert largest > 2 ** (bits - 1)
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>").repartition(3)
    got = topk.exact_top_k(df, F.col("vec_id") % 20 == 0, 7, shard_rows=100, block_queries=9)
    expected = set()
    for q, v in rows:
        if q % 20 == 0:
            best = sorted((-sum(x * y for x, y in zip(v, w)), i) for i, w in rows if i != q)[:7]
            expected |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)}
    assert {tuple(r) for r in got.collect()} == expected


def test_search_with_many_rows_and_large_scores():
    """Scores times rows are beyond 64 bits; scores alone are not."""
    rng = np.random.default_rng(3)
    points = rng.integers(-64 * 10**5, 64 * 10**5, (8192, 64))
    row, ids, score = topk.search(np.arange(8192), points, np.arange(40), points[:40], np.full(40, -np.inf), 5)
    exact = points[:40].astype(object) @ points.T.astype(object)
    for q in range(40):
        best = sorted((-int(s), i) for i, s in enumerate(exact[q]) if i != q)[:5]
        assert sorted(zip((-score[row == q]).tolist(), ids[row == q].tolist())) == best


def test_scores_beyond_64_bits_are_an_error(spark):
    side = 2**32
    rows = [(0, [side] * 4), (1, [side] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    with pytest.raises(Exception, match="64 bits"):
        topk.exact_top_k(df, F.col("vec_id") == 0, 3).collect()
    low = spark.createDataFrame([(0, [side] * 4), (1, [-side] * 4)], "vec_id long, vector array<long>")
    with pytest.raises(Exception, match="64 bits"):
        topk.exact_top_k(low, F.col("vec_id") == 0, 3).collect()
    # Large factors whose score fits are no error, nor is what no answer needs.
    side = 2**33
    rows = [(0, [side, 1]), (1, [1, side]), (2, [side, -side]), (3, [0, 5])]
    fits = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    got = [tuple(r) for r in topk.exact_top_k(fits, F.col("vec_id") == 1, 2).collect()]
    assert sorted(got) == [(1, 1, 3, 5 * side), (1, 2, 0, 2 * side)]


def test_components_beyond_64_bits_are_an_error(spark):
    df = spark.createDataFrame([([0.5, -0.01, 3.0],)], "v array<double>")
    assert df.select(topk.whole_steps(F.col("v"), 64)).first()[0] == [32, -1, 192]
    for x in (1e300, -1e300, 2.0**57):
        with pytest.raises(Exception, match="64 bits"):
            spark.createDataFrame([([x],)], "v array<double>").select(topk.whole_steps(F.col("v"), 64)).collect()
    low = spark.createDataFrame([([-(2.0**57)],)], "v array<double>").select(topk.whole_steps(F.col("v"), 64)).first()[0]
    assert low == [-(2**63)]


def test_pairs_are_dropped_before_the_shuffle():
    """On clustered vectors a query goes to few cells, and none that it needs is left out."""
    rng = np.random.default_rng(0)
    centres = rng.integers(-400, 400, (40, 16))
    points = np.repeat(centres, 100, axis=0) + rng.integers(-2, 3, (4000, 16))
    cells = topk.Cells.divide(points[rng.permutation(4000)[:1500]], 40)
    cell, far = cells.place(points)
    cells.radii = np.array([far[cell == c].max(initial=-np.inf) for c in range(len(cells.centres))])
    scores = points @ points.T
    kth = np.sort(scores, axis=1)[:, -20].astype(float)
    reached = cells.reached(points, kth)
    assert len(cells.centres) > 20 and reached.mean() < 0.2
    assert reached[np.arange(4000)[:, None], cell[None, :]][scores >= kth[:, None]].all()


def test_one_common_vector_and_one_cell(spark):
    """Equal vectors cannot be divided into cells; they are dealt into shards of one."""
    rows = [(i, [3, 4]) for i in range(500)] + [(1000, [1, 0])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    got = topk.exact_top_k(df, F.col("vec_id") % 100 == 0, 4, shard_rows=50, block_queries=2)
    assert {tuple(r) for r in got.collect()} == brute(rows, 4, 100)


def test_vectors_without_components(spark):
    df = spark.createDataFrame([(0, []), (1, []), (2, [])], "vec_id long, vector array<long>")
    assert [tuple(r) for r in topk.exact_top_k(df, F.col("vec_id") == 0, 3).collect()] == [(0, 1, 1, 0), (0, 2, 2, 0)]
