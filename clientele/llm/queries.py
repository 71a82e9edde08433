"""Registered queries of the operators of this folder, over their whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm import (
    bpe, chat, mixing, neardup, periods, quality, sharding, substrings, suffixes, suffixtree, topk, toxicity, trie)
from clientele.llm.oracle import ORACLE
from clientele.llm.words import let, words
from clientele.session import prepare_workers

__all__ = ["ORACLE", "QUERIES"]

QUERIES = {}


def _query(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare_workers(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats all conversations, and one made of control strings only."""
    hard = chat.END + chat.START + "assistant ok"
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(hard).alias("text"),
    )
    return chat.digests(chat.format_conversations(turns.unionByName(extra)))


@_query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the line-first verdict for every document."""
    return quality.clean_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "lost_chars",
    )


@_query
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    return mixing.mix_sizes(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@_query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards of near equal bytes."""
    return sharding.assign_shards(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op3_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes every document."""
    return bpe.round_trip_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op8_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores every document."""
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op9_ball_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for every twentieth vector, among all."""
    rows = _table(spark, sf_dir, "embeddings").where(topk.usable(F.col("embedding")))
    steps = topk.whole_steps(F.col("embedding"), 64)
    return topk.exact_top_k(rows.select("vec_id", steps.alias("vector")), F.col("vec_id") % 20 == 0, k=20)


@_query
def op10_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op2_substring_rlz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removes passages of fifty words that earlier documents have."""
    return substrings.remove_repeated_passages(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removes strings of a hundred bytes that start earlier, too."""
    return suffixes.remove_repeated_strings(_table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _crc(number) -> Column:
    """CRC-32 of the decimal digits of an id."""
    return F.crc32(number.cast("string").cast("binary"))


@_query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each forked from the first one of its hundred."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv_id = F.col("conv_id")
    conversations = trie.forked(trie.sequences(turns), conv_id - conv_id % 100, _crc(conv_id) % 6, 5)
    return trie.prefix_trie(conversations)


@_query
def op12_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores every document by the model of those that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = suffixtree.score_documents(docs, ["doc_id"], suffixtree.held_out(F.col("doc_id")))
    return scored.select(
        "row.doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _with_periods(docs: DataFrame) -> DataFrame:
    """Plants a period in the words of every document whose id's CRC ends in 0."""
    h = _crc(F.col("doc_id"))
    g = F.floor(h / 10).cast("long")

    def planted(listed: Column) -> Column:
        n = F.size(listed).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        place = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.array_join(F.transform(place, lambda i: F.get(
            listed, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    changed = let(words(F.col("text")), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(F.lit("")))
    return docs.withColumn("text", F.when(h % 10 == 0, changed).otherwise(F.col("text")))


@_query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All periodic runs of every document, the longest one, and the text without repeats."""
    docs = _with_periods(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periods.collapse_runs(docs).select("row.doc_id", "runs", "collapsed")
    first = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("longest"), r["start"].alias("start"), r["period"].alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    length = -F.col("first.longest")
    return found.withColumn("first", first).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "first.start", length.alias("length"), "first.period",
        F.floor(1000 * length / F.col("first.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
