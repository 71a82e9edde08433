"""Connected components of an edge table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.sources.files import remove, scratch_dir


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of ``edges`` (a, b): the smallest node reachable.

    Alternates two steps until nothing changes.  In the large step every node
    hands its smallest neighbour to its larger ones, in the small step to its
    smaller ones; each writes one edge per edge read, so a star of any size stays
    as large as it is, and the number of rounds grows with the logarithm of a
    component's diameter.  Hubs meet their edges in joins that can be split.
    A round is a written table, and is removed when the next one is there.
    """
    spark = edges.sparkSession
    folder = scratch_dir(spark, "components")

    def written(table: DataFrame, number: int) -> DataFrame:
        table.write.parquet(f"{folder}/{number}")
        return spark.read.parquet(f"{folder}/{number}")

    current = written(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), 0)
    last, number = None, 0
    while True:
        now = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == last:
            break
        last, number = now, number + 1
        current = written(_small_step(_large_step(current)), number)
        remove(spark, f"{folder}/{number - 1}")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()


def _large_step(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    lowest = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("low"))
    moved = both.where("b > a").join(lowest, F.col("a") == F.col("node"))
    # The node itself keeps its edge to its lowest neighbour.
    kept = lowest.where("low < node").select(F.col("node").alias("a"), F.col("low").alias("b"))
    return moved.select(F.col("b").alias("a"), F.col("low").alias("b")).union(kept).where("a != b").distinct()


def _small_step(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    moved = edges.join(lowest, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    kept = lowest.select(F.col("node").alias("a"), F.col("low").alias("b"))
    return moved.union(kept).where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
