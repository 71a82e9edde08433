"""Sharding by longest processing time: near equal bytes, groups kept together.

Documents with equal texts form a group and share a shard.  Groups go, largest
first, to the least-loaded shard, which a heap gives.  The heap sees a bounded
number of items whatever the size of the table: every group above 1/512 of a
shard's mean load is an item of its own (there can be at most 512 per shard),
and all smaller groups are bound by hash into 256 bundles per shard, which the
heap places whole.

Slots count the documents of a shard without gaps.  They are numbered within
each partition of the written assignment and offset by the counts of the
partitions before, so no task sorts a whole shard.

Defined results: a null text counts as no bytes, and null texts are a group
apart from empty ones; rows that repeat a doc_id are separate rows with slots of
their own; an empty table gives no rows; a single group larger than a shard's
mean load stays whole; other columns are ignored.  Groups are told apart by a
64-bit hash of the text: a collision would only keep two groups together.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientele.sources.files import cut_lineage

SHARDS = 24
LARGE_PER_SHARD = 512
BUNDLES_PER_SHARD = 256
ROW_BYTES = 8


def longest_first(sizes: list[tuple[int, object]], shards: int) -> dict:
    """Item to shard: items by size, largest first, each to the lightest shard."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for size, item in sorted(sizes, key=lambda p: (-p[0], str(p[1]))):
        load, shard = heapq.heappop(heap)
        placed[item] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Adds nothing to the texts: returns doc_id, size, text_crc32, shard, slot."""
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    rows = cut_lineage(docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(text, text.isNull()).alias("text_hash"),
    ))
    bundles = shards * BUNDLES_PER_SHARD
    groups = rows.groupBy("text_hash").agg(F.sum("size").alias("bytes"))
    all_bytes = rows.agg(F.sum("size")).first()[0] or 0
    limit = all_bytes // (shards * LARGE_PER_SHARD)
    # At most shards * LARGE_PER_SHARD groups can exceed the limit, by its definition.
    large = F.col("bytes") > limit
    bundle = F.pmod(F.col("text_hash"), F.lit(bundles))
    items = (
        groups.select(
            large.alias("is_large"),
            F.when(large, F.col("text_hash")).otherwise(bundle).alias("item"),
            "bytes",
        )
        .groupBy("is_large", "item").agg(F.sum("bytes").alias("bytes"))
        .collect()
    )
    placed = longest_first([(r["bytes"], (r["is_large"], r["item"])) for r in items], shards)
    table = spark.createDataFrame(
        [(kind, item, shard) for (kind, item), shard in placed.items()],
        "is_large boolean, item long, shard int",
    )
    # Both tables have at most LARGE_PER_SHARD and BUNDLES_PER_SHARD rows per shard.
    of_group = F.broadcast(table.where("is_large").select(F.col("item").alias("text_hash"), F.col("shard").alias("own")))
    of_bundle = F.broadcast(table.where("not is_large").select(F.col("item").alias("bundle"), F.col("shard").alias("shared")))
    placed_rows = (
        rows.withColumn("bundle", bundle)
        .join(of_group, "text_hash", "left")
        .join(of_bundle, "bundle", "left")
        .select(
            "doc_id", "size", "text_crc32",
            F.coalesce("own", "shared").alias("shard"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    return number_slots(cut_lineage(placed_rows))


def number_slots(rows: DataFrame) -> DataFrame:
    """Gapless slot per shard from ``shard`` and ``row`` (partition and place)."""
    part = F.shiftright("row", 33)
    parts = rows.groupBy("shard", part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "part").orderBy("row")
    return (
        rows.withColumn("part", part)
        .withColumn("place", F.row_number().over(within))
        .join(offsets, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("place") - 1).cast("long").alias("slot"))
    )
