"""Session settings this library is written for."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

# Row-local text work keeps partitions busy, so input splits stay moderate; AQE
# sizes shuffles, splits skewed join partitions and picks broadcasts by size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Reviews that meet their business grow several-fold right after the join.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra) -> SparkSession:
    """Local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("clientele")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": shuffle_partitions,
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Partitions that a shuffle starts from; AQE joins those that come out small.
FIRST_PARTITIONS = 400
# Shuffled bytes that AQE joins up to for a task.  They are compressed, and ten to thirty
# times as large once they are rows that a task sorts and counts.
TASK_BYTES = "16MB"


def prepare_shuffles(spark: SparkSession) -> None:
    """Readies a session for shuffles of any size.

    AQE joins small partitions of a shuffle but cuts none that is too large, so
    that with a fixed number of them the memory of a task would grow with the
    input.  Shuffles start from ``FIRST_PARTITIONS``, joined up to ``TASK_BYTES``,
    unless the session says otherwise.
    """
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(first, None) is None and int(spark.conf.get("spark.sql.shuffle.partitions")) < FIRST_PARTITIONS:
        spark.conf.set(first, str(FIRST_PARTITIONS))
    joined = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if spark.conf.get(joined, None) is None:
        spark.conf.set(joined, TASK_BYTES)


def prepare_state(spark: SparkSession) -> None:
    """Keeps the state of streams on the executors' disks, unless the session says otherwise.

    State in memory takes all ids that a watermark has not passed.  A checkpoint
    that was begun otherwise keeps its way.
    """
    provider = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(provider).endswith(".HDFSBackedStateStoreProvider"):
        spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        # The total would cost a lookup more for every id that is written.
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")


# Rows of whole texts that a Python worker receives at a time.
TEXT_ROWS = 1000


def prepare_workers(spark: SparkSession) -> None:
    """Readies a session for work on texts in Python workers.

    Workers find this package where the driver found it; that is for sources that
    lie in the same place on every machine, packages given by ``--py-files`` or
    installed are found anyway.  Batches are cut to ``TEXT_ROWS``, as texts are
    long, unless the session says otherwise.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(TEXT_ROWS))
    root = str(Path(__file__).resolve().parents[1])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join(filter(None, [*paths, root]))
