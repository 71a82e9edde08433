"""Sketches against exact counts: errors within what is stated, merging as good as counting."""

import random

import pytest
from pyspark.sql import functions as F

from clientele.operators import sketches
from clientele.sources import standins

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def visits(spark):
    """Users with 1 to 60,000 different keys, many of them again and again."""
    rng = random.Random(4)
    sizes = {f"u{i}": int(10 ** rng.uniform(0, 4)) for i in range(60)} | {"hot": 60_000, "one": 1}
    users = spark.createDataFrame(list(sizes.items()), "user_id string, n int")
    rows = users.select("user_id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("k"))
    rows = rows.withColumn("business_id", F.concat(F.lit("b"), F.col("k")))
    again = rows.where("k % 3 = 0")
    odd = spark.createDataFrame([("one", None, None), (None, 1, "b1")], "user_id string, k int, business_id string")
    return rows.unionByName(again).unionByName(odd).repartition(6).cache(), sizes


def estimates(sketched):
    return {r["user_id"]: r["n"] for r in sketched.select("user_id", sketches.distinct_estimate().alias("n")).collect()}


def test_distinct_error_is_the_stated_one(visits):
    rows, sizes = visits
    found = estimates(sketches.distinct_sketches(rows, ["user_id"], "business_id"))
    off = [abs(found[u] - n) / n for u, n in sizes.items()]
    assert sum(x <= 2 * sketches.DISTINCT_ERROR for x in off) >= 0.95 * len(off)
    assert found["one"] == 1 and found[None] == 1


def test_real_users_are_close(spark):
    reviews = standins.raw_reviews(spark, SF)
    exact = {r["user_id"]: r["n"] for r in reviews.groupBy("user_id").agg(F.count_distinct("business_id").alias("n")).collect()}
    found = estimates(sketches.distinct_sketches(reviews, ["user_id"], "business_id"))
    close = [abs(found[u] - n) <= sketches.DISTINCT_ERROR * n for u, n in exact.items()]
    assert len(close) > 500 and sum(close) >= 0.95 * len(close)


def test_halves_merge_to_the_whole(visits):
    """By any parts, and over any coarser grouping."""
    rows, _ = visits
    halves = [sketches.distinct_sketches(rows.where(f"k % 2 = {i}"), ["user_id"], "business_id") for i in (0, 1)]
    merged = sketches.merged_sketches(halves[0].unionByName(halves[1]), ["user_id"])
    whole = sketches.distinct_sketches(rows.where("k IS NOT NULL"), ["user_id"], "business_id")
    assert estimates(merged) == estimates(whole)
    total = sketches.merged_sketches(merged, []).select(sketches.distinct_estimate()).first()[0]
    assert abs(total - 60_000) <= 3 * sketches.DISTINCT_ERROR * 60_000


def test_sketches_are_small(visits):
    rows, _ = visits
    sizes = sketches.distinct_sketches(rows, ["user_id"], "business_id").select(F.max(F.length("sketch"))).first()[0]
    assert sizes <= 2 ** sketches.LG_K + 100


def test_heavy_keys_are_found_among_far_more_keys(spark):
    """Ten large keys in 50,000 small ones, with summaries of 4,000: all found, counts within the bound."""
    large = [(f"big{i}", 3000 + 100 * i) for i in range(10)]
    rows = spark.createDataFrame(large, "key string, n int").select("key", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("col")
    small = spark.range(50_000).select(F.concat(F.lit("s"), "id").alias("key"))
    everything = rows.unionByName(small).unionByName(spark.createDataFrame([(None,)] * 9, "key string")).repartition(8)
    found = {r["key"]: r["rows"] for r in sketches.heavy_keys(everything, "key", 10, tracked=4000).collect()}
    bound = everything.count() / 4000 * 4 / 3
    assert set(found) == {k for k, _ in large}
    assert all(0 <= found[k] - n <= bound for k, n in large)


def test_heavy_keys_need_no_shuffle_of_keys(spark):
    """One summary a task reaches the single exchange."""
    rows = spark.range(0, 100_000, 1, 8).select((F.col("id") % 5000).cast("string").alias("key"))
    plan = sketches.heavy_keys(rows, "key", 10)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key" not in plan and plan.count("Exchange SinglePartition") == 1


def test_quantiles_within_their_error(spark):
    rows = spark.range(0, 200_000, 1, 8).select((F.col("id") * F.col("id") % 99_991).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(None,)] * 5, "v long"))
    found = sketches.quantiles(rows, "v", (0.01, 0.25, 0.5, 0.9, 0.999))
    spans = sketches.rank_span(rows, "v", found).collect()
    error = 2 * sketches.RANK_ERROR
    assert len(spans) == 5
    assert all(s["below"] - error <= s["probability"] <= s["up_to"] + error for s in spans)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "user_id string, business_id string, v long")
    assert sketches.distinct_sketches(none, ["user_id"], "business_id").count() == 0
    assert sketches.heavy_keys(none, "business_id", 3).count() == 0
