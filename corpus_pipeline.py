"""A training corpus from documents: five stages, each one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet and gives the reread table to the next stage.  All but
the last return the columns of documents.

Defined results: those of the operators.  A document whose text is cut away
whole by suffix-array dedup stays with an empty text, and so does one whose text
is null; documents taken twice by the mix are two rows; empty texts have no
tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm import bpe, mixing, neardup, suffixes, toxicity
from clientele.session import prepare_workers
from clientele.sources.files import scratch_dir


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    prepare_workers(spark)
    return toxicity.remove_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    prepare_workers(spark)
    return neardup.keep_one(docs)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings that start earlier, too."""
    prepare_workers(spark)
    return suffixes.cut_texts(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of ids and of the decoded text."""
    prepare_workers(spark)
    file = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode(docs.select("doc_id", "source", "text"), file).select("doc_id", "source", "ids")
    return bpe.decode(coded, file).select(
        "doc_id", "source", "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", encoding_stage),
]

# No stage but the mix can be written in SQL; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_dir(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
