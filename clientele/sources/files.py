"""JSON, Parquet and table sources and sinks, and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

# Even tasks that an unevenly split table is dealt out to, at least.
SPREAD_TASKS = 32
# Stand-in folders of local sessions, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines with a declared schema; nested objects fit text maps."""
    return spark.read.schema(schema).json(path)


# Lines of JSON are compressed for their repeated names, which the fastest level finds as well.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, compressed: names repeat in every line.  A task reads a file whole, as one wrote it."""
    df.write.options(**GZIP).json(path)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Valence lexicon: tab-separated word, mean valence, and more columns."""
    return (
        spark.read.option("sep", "\t").option("quote", "").option("enforceSchema", True)
        .schema("word string, valence double").csv(path)
        .where(F.col("word").isNotNull() & F.col("valence").isNotNull())
    )


def spread(scan: DataFrame, tasks: int = SPREAD_TASKS) -> DataFrame:
    """Deal out the rows of a Parquet scan that lie unevenly in its splits.

    A split without a row group of its own stays empty, however many splits a
    file is cut into, and heavy work per row would run in the others.  One pass
    over the file footers counts the rows of each split.  If the fullest holds
    over twice its share of ``tasks`` or more splits, the rows are dealt out; a
    table with enough row groups, as any large one has, is returned as it is.
    The number of cores plays no part.
    """
    splits = max(scan.rdd.getNumPartitions(), tasks)
    rows, fullest = (
        scan.groupBy(F.spark_partition_id().alias("split")).agg(F.count("*").alias("n"))
        .agg(F.sum("n"), F.max("n")).first()
    )
    return scan.repartition(splits) if rows and fullest * splits > 2 * rows else scan


def sample_dir(base: str, fraction: float) -> str:
    """Output folder of one sample fraction, laid out as a partition."""
    return f"{base.rstrip('/')}/sample={fraction}"


def save_parquet(df: DataFrame, path: str, files: int | None = None) -> None:
    """Overwrite ``path``.  ``files`` fixes the number of files (small tables);
    without it the partitions of the plan, sized by AQE, are kept."""
    out = df.repartition(files) if files else df
    out.write.mode("overwrite").parquet(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a finished write left its success marker under ``path``."""
    return exists(spark, f"{path}/_SUCCESS")


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _hadoop(spark, path)
    return files.exists(at)


def materialize(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    files: int | None = None,
    made_from: str | None = None,
) -> DataFrame:
    """Read ``path`` if it was written before, else build, write and read it.

    Only a missing result triggers the build; any other failure surfaces.
    ``made_from`` tells what the result depends on.  It is kept beside the
    table, and a table made from something else is built again.
    """
    note = f"{path}/_made_from"
    if not is_complete(spark, path) or (made_from is not None and read_note(spark, note) != made_from):
        save_parquet(build(), path, files)
        if made_from is not None:
            _write_note(spark, note, made_from)
    return spark.read.parquet(path)


def _hadoop(spark: SparkSession, path: str):
    """File system and path object of ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def read_note(spark: SparkSession, path: str) -> str | None:
    files, at = _hadoop(spark, path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_note(spark: SparkSession, path: str, text: str) -> None:
    files, at = _hadoop(spark, path)
    out = files.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def create_note(spark: SparkSession, path: str, text: str) -> None:
    """A new file of ``text``, seen whole or not at all; an error where ``path`` exists."""
    files, at = _hadoop(spark, path)
    if files.exists(at):
        raise FileExistsError(path)
    part = f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex[:12]}"
    _write_note(spark, part, text)
    if not files.rename(_hadoop(spark, part)[1], at):
        raise FileExistsError(path)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in ``path``; none if it is not there."""
    files, at = _hadoop(spark, path)
    return [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    files, at = _hadoop(spark, path)
    files.delete(at, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    files, at = _hadoop(spark, path)
    return files.getContentSummary(at).getLength()


def input_state(spark: SparkSession, path: str) -> str:
    """Path, size, number of files and time of change of an input."""
    files, at = _hadoop(spark, path)
    if not files.exists(at):
        return f"{path} missing"
    summary = files.getContentSummary(at)
    changed = files.getFileStatus(at).getModificationTime()
    return f"{path} {summary.getLength()} {summary.getFileCount()} {changed}"


def content_hash(df: DataFrame) -> str:
    """Hash of the rows of a small table, in any order."""
    rows, h, g = df.agg(
        F.count("*"), F.bit_xor(F.xxhash64(*df.columns)), F.bit_xor(F.xxhash64(F.lit(1), *df.columns))).first()
    return f"{rows}-{h}-{g}"


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors reach, named by ``spark.checkpoint.dir``.

    A temporary folder stands in only where the whole of Spark is one local
    process; on a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    # One process only: local-cluster has executors of its own.
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="clientele-")
        atexit.register(shutil.rmtree, _LOCAL_FOLDERS[app], ignore_errors=True)
    return _LOCAL_FOLDERS[app]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder; removed when the driver ends."""
    folder = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    remove_at_end(spark, folder)
    return folder


def remove_at_end(spark: SparkSession, folder: str) -> None:
    """Removes ``folder``, if it is there then, when the driver ends."""
    atexit.register(_remove, *_hadoop(spark, folder))


def _remove(files, path) -> None:
    try:
        files.delete(path, True)
    except Py4JError:  # the JVM went first
        pass


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/checkpoints")
        # Spark makes a folder of its own in there.
        remove_at_end(spark, spark.sparkContext.getCheckpointDir())
    return df.checkpoint()


def flat_columns(df: DataFrame) -> DataFrame:
    """Maps and arrays as JSON text, for sinks that hold only scalars."""
    return df.select([
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (MapType, ArrayType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def parsed_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """JSON text columns as maps and arrays again, those of ``types``."""
    return df.withColumns({c: F.from_json(c, t) for c, t in types.items() if c in df.columns})


def save_table(df: DataFrame, table: str, format: str | None = None, **options) -> None:
    """Overwrite a catalog table, or a table behind any connector.

    Connection settings come from the caller only.
    """
    writer = df.write.mode("overwrite").options(**options)
    if format is None:
        writer.saveAsTable(table)
    else:
        writer.format(format).save()


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line; maps and arrays become JSON text."""
    flat_columns(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
