"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key whose rate is its quality weight; the
smallest keys come first.  A source's budget is met by whole epochs (every
document once) and then by the prefix of its documents, in key order, whose
running word count reaches what is left.  The prefix ends where the middle of
the next document lies beyond the budget, so a source misses its target by half
a document at most.

The order is never built as a whole: keys fall into ``BUCKETS`` ranges per
source, running sums over the ranges find the one in which the budget ends, and
only that one is sorted.  The result is a cut per source, with which choosing a
document is a row-local comparison.

Targets: sources in code point order, null last, weigh ``WEIGHTS`` in rotation
and share ``SHARE`` times all words; no target exceeds ``MAX_EPOCHS`` times its
source, the excess going to the others by weight.

Defined results: null text has size 0 and weight like empty text; a source
without words has target 0 and its documents are taken once; rows that repeat a
doc_id draw the same key and are taken or left together; ties of keys go to the
smaller doc_id; an empty table gives no rows; columns with other names, also
those of the plan, are left alone.  Reruns agree: keys depend on ``seed`` and
doc_id only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientele.llm.words import word_count
from clientele.operators.dimension import small_side
from clientele.sources.files import cut_lineage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
BUCKETS = 4096
SEED = "mix-1"
# Characters that speak against running prose, for the quality weight.
NOISE = "#*$%&|<>!0123456789"
FIRST_ID = -(2**63)


def quality_weight(text: Column) -> Column:
    """0.05 to 1: the share of characters that are not noise."""
    chars = F.length(F.coalesce(text, F.lit("")))
    clean = F.length(F.translate(F.coalesce(text, F.lit("")), NOISE, ""))
    return F.lit(0.05) + F.lit(0.95) * ((clean + 1) / (chars + 1))


def sampling_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """Exponential variate with rate ``weight``, fixed by seed and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    uniform = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))
    return -F.log(uniform) / weight


def _bucket(key: Column) -> Column:
    return F.least(F.floor((1 - F.exp(-key)) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")


def measured(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size and sampling key of every document."""
    text = F.col("text").cast("string")
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        word_count(text).alias("size"),
        sampling_key(F.col("doc_id"), quality_weight(text), seed).alias("key"),
    )


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs=MAX_EPOCHS) -> DataFrame:
    """Target words of each source; one row per source throughout."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    place = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)) + 1)
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        sources.withColumn("cap", F.col("source_size") * float(max_epochs))
        .withColumn("budget", F.sum("source_size").over(everything) * share)
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        # The level if this source is the first, by ratio, that stays under its cap.
        .withColumn("level", (F.col("budget") - F.col("capped")) / (F.col("weights") - F.col("gone")))
        .withColumn("level", F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level")))
        .withColumn("level", F.first("level", ignorenulls=True).over(
            by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    target = F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("level"), F.col("cap")))
    return levels.select("source", "source_size", target.alias("target"))


def mixing_plan(rows: DataFrame, **rule) -> DataFrame:
    """Per source: size, target, whole epochs and the cut of the last, partial one.

    ``rows`` are measured documents; pass a written table, it is read twice.
    """
    targets = source_targets(rows, **rule)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1).cast("long")
    targets = cut_lineage(
        targets.withColumn("epochs", epochs)
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    bucketed = rows.withColumn("bucket", _bucket(F.col("key"))).withColumnRenamed("source", "row_source")
    sums = bucketed.groupBy("row_source", "bucket").agg(F.sum("size").alias("words"))
    same = F.col("row_source").eqNullSafe(F.col("source"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        sums.join(targets.select("source", "rest"), same)
        .withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
        .select("source", "rest", "before", F.col("bucket").alias("cut_bucket"))
    )
    running = Window.partitionBy("source").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        bucketed.join(small_side(ends), same & (F.col("bucket") == F.col("cut_bucket")))
        .groupBy("source", "rest", "before", "key", _tie(F.col("doc_id")).alias("tie"))
        .agg(F.sum("size").alias("size"))
        .withColumn("middle", F.col("before") + F.sum("size").over(running) - F.col("size") / 2)
        .where((F.col("rest") > 0) & (F.col("middle") <= F.col("rest")))
        .groupBy("source").agg(F.max(F.struct("key", "tie")).alias("cut"))
    )
    ends, cuts = (d.withColumnRenamed("source", f"{n}_source") for d, n in ((ends.select("source", "cut_bucket"), "end"), (cuts, "cut")))
    return (
        targets.join(ends, F.col("source").eqNullSafe(F.col("end_source")), "left")
        .join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left")
        .select("source", "source_size", "target", "epochs", "cut_bucket", "cut")
    )


def _tie(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(FIRST_ID))


def copies(doc_id: Column, key: Column, plan: str = "plan") -> Column:
    """How often the mix takes a document, given its source's plan row."""
    bucket, end, cut = _bucket(key), F.col(f"{plan}.cut_bucket"), F.col(f"{plan}.cut")
    in_part = (bucket < end) | ((bucket == end) & (F.struct(key.alias("key"), _tie(doc_id).alias("tie")) <= cut))
    return F.col(f"{plan}.epochs") + F.when(F.coalesce(in_part, F.lit(False)), 1).otherwise(0)


def mix_sizes(docs: DataFrame, seed: str = SEED, **rule) -> DataFrame:
    """doc_id, source, size, source_size, target and words taken, per document."""
    rows = cut_lineage(measured(docs, seed))
    plan = small_side(cut_lineage(mixing_plan(rows, **rule))).select(F.struct("*").alias("plan"))
    return rows.join(plan, F.col("source").eqNullSafe(F.col("plan.source"))).select(
        "doc_id", "source", "size", "plan.source_size", "plan.target",
        (F.col("size") * copies(F.col("doc_id"), F.col("key"))).alias("taken"),
    )


def mix(docs: DataFrame, seed: str = SEED, **rule) -> DataFrame:
    """The mixed documents themselves: each row as often as the mix takes it."""
    names = docs.columns
    plan = small_side(cut_lineage(mixing_plan(cut_lineage(measured(docs, seed)), **rule)))
    weight = quality_weight(F.col("doc.text").cast("string"))
    taken = copies(F.col("doc.doc_id"), sampling_key(F.col("doc.doc_id"), weight, seed))
    return (
        docs.select(F.struct("*").alias("doc"))
        .join(plan.select(F.struct("*").alias("plan")), F.col("doc.source").cast("string").eqNullSafe(F.col("plan.source")))
        .select("doc", F.explode(F.array_repeat(F.lit(True), taken.cast("int"))).alias("taken"))
        .select(*[F.col("doc")[n].alias(n) for n in names])
    )
