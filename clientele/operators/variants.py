"""Semi-structured profile columns as VARIANT.

Maps and lists are stored once in Spark's binary form of JSON, with the types of
their values, and read by path or flattened; no reader parses text again.  In
Parquet a variant is two binary columns, so a reader of other columns skips them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele import schemas
from clientele.operators.reports import SENTIMENTS
from clientele.sources.files import save_table


def variant_columns(df: DataFrame, columns: Sequence[str] = tuple(schemas.PROFILE_JSON)) -> DataFrame:
    """Maps and lists as variants; keys must be text."""
    return df.withColumns({c: F.to_variant_object(c) for c in columns if c in df.columns})


def parsed_variants(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """JSON text as variants; null where a text is no JSON."""
    return df.withColumns({c: F.try_parse_json(c) for c in columns})


def publish_variants(profile: DataFrame, table: str, **options) -> None:
    """Stores a profile with its maps and lists as variants."""
    save_table(variant_columns(profile), table, **options)


def at_path(column: str, key: str, kind: str) -> Column:
    """The value at a key of a variant object; null where it is missing or of another kind."""
    quoted = key.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(column, f"$['{quoted}']", kind)


def typed_variants(df: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Variants as the maps and lists of ``types``."""
    types = schemas.PROFILE_JSON if types is None else types
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in df.columns})


def flattened(df: DataFrame, column: str, key: str, value: str, kind: str) -> DataFrame:
    """One row per entry of a variant object; its ``key`` and typed ``value`` come last.

    Rows whose variant is null, empty or no object give none.
    """
    entries = df.sparkSession.tvf.variant_explode(F.col(column).outer())
    kept = [c for c in df.columns if c != column]
    return df.lateralJoin(entries).where(F.col("key").isNotNull()).select(
        *kept, F.col("key").alias(key), F.col("value").cast(kind).alias(value))


def sentiment_pivot(stored: DataFrame, columns: Sequence[str] = tuple(schemas.REPORT_COLUMNS)) -> DataFrame:
    """Report columns plus one count per sentiment, read by path."""
    counts = [F.coalesce(at_path("sentiment_map", s, "bigint"), F.lit(0)).alias(f"{s}_sentiment") for s in SENTIMENTS]
    return typed_variants(stored.select(*columns, *counts))


def category_long(stored: DataFrame, columns: Sequence[str] = tuple(schemas.REPORT_COLUMNS)) -> DataFrame:
    """One row per user and category, flattened from the variant."""
    rows = stored.select(*[c for c in columns if c != "category_map"], "category_map")
    return typed_variants(flattened(rows, "category_map", "category_name", "category_count", "bigint"))


def load_variants(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
