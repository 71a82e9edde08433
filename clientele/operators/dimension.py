"""Joins with tables that are small, as long as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text of a dimension that is sent to every executor, at most.
BROADCAST_BYTES = 64 * 1024 * 1024


def text_bytes(df: DataFrame) -> int:
    """Bytes of all values of ``df`` as text, plus eight per value."""
    width = sum((
        F.coalesce(F.octet_length(F.to_json(F.struct(c)) if "<" in kind else F.col(c).cast("string")), F.lit(0)) + 8
        for c, kind in df.dtypes
    ), F.lit(0))
    return df.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def is_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """True when ``df``, measured in one pass, may be broadcast."""
    return text_bytes(df) <= limit


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint where its measured size allows one."""
    return F.broadcast(df) if is_small(df, limit) else df
