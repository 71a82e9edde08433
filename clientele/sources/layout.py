"""Tables laid out for what reads them: by key for joins, by range for filters, by footer for bounds."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Steps that a clustered column is cut into; a power of two.
STEPS = 256


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, **options) -> None:
    """A catalog table, hashed and sorted by ``key`` into one file per bucket.

    Tables with equally many buckets join, and group, by the key without an
    exchange.  Of a hot key all rows lie in one bucket, as they would in one
    partition of a shuffle; tables of one row per key have none.
    """
    (
        df.repartition(buckets, key).write.mode("overwrite").options(**options)
        .bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    )


@contextmanager
def bucketed_files(df: DataFrame, path: str, key: str, buckets: int, *parts: str) -> Iterator[DataFrame]:
    """Files under ``path``, hashed by ``key`` by the tasks that make the rows, without a shuffle, read again.

    What is dealt out to equally many partitions by the key joins them without an
    exchange of theirs.  The catalog has them inside the block only; without
    ``parts``, the columns of the folders, the rows can be read after it, too.
    """
    spark, table = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    writer = df.write.option("path", path).bucketBy(buckets, key)
    try:
        (writer.partitionBy(*parts) if parts else writer).saveAsTable(table)
        yield spark.table(table)
    finally:
        # The files of a table with a path of its own stay.
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def _step(column: str, marks: Sequence[float]) -> Column:
    """How many of the ascending ``marks`` a value reaches; nulls come first."""
    listed = F.array(*[F.lit(float(m)) for m in marks])
    return F.coalesce(F.size(F.filter(listed, lambda m: m <= F.col(column).cast("double"))), F.lit(0))


def clustering_key(marks: dict[str, Sequence[float]]) -> Column:
    """The bits of every column's step, interleaved: near in all columns is near in the key."""
    bits = (STEPS - 1).bit_length()
    key, n = F.lit(0).cast("bigint"), len(marks)
    for place, (column, cuts) in enumerate(marks.items()):
        step = _step(column, cuts).cast("bigint")
        for bit in range(bits):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(step, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * n + place))
    return key


def save_clustered(df: DataFrame, path: str, columns: Iterable[str], files: int, rows_each: int | None = None) -> None:
    """Parquet files whose rows are near each other in all of ``columns``.

    Quantiles cut each column into steps, one pass for all; rows are range
    partitioned and sorted by the interleaved steps.  A filter on any of the
    columns then skips the files and row groups whose ranges it misses.
    ``rows_each`` bounds the rows of a file.
    """
    columns = list(columns)
    shares = [i / STEPS for i in range(1, STEPS)]
    cuts = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(c) for c in columns]).first()
    key = clustering_key({c: sorted(set(cuts[c] or [])) for c in columns})
    (
        df.withColumn("_key", key).repartitionByRange(files, "_key").sortWithinPartitions("_key", *columns).drop("_key")
        .write.mode("overwrite").option("maxRecordsPerFile", rows_each or 0).parquet(path)
    )


def largest_values(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """One row with the largest value of each column, from the footers of Parquet files.

    The aggregate is pushed into the scan, which reads no values.  Where a footer
    has no statistics for a column, as for some types, the values are read.
    """
    columns = list(columns)
    # Settings of these reads alone.
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    tops = [F.max(c).alias(c) for c in columns]
    pushed = own.read.parquet(path).agg(*tops)
    try:
        row = pushed.first()
    except (PySparkException, Py4JJavaError):
        return spark.read.parquet(path).agg(*tops)
    return spark.createDataFrame([row], pushed.schema)


def reads_footers_only(spark: SparkSession, path: str, columns: Iterable[str]) -> bool:
    """Whether ``largest_values`` is answered without reading values, by its plan."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = own.read.parquet(path).agg(*[F.max(c) for c in columns])._jdf.queryExecution().executedPlan().toString()
    return "PushedAggregation: [MAX" in plan
