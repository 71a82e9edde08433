"""Small Column helpers shared by the other modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    A higher-order function evaluates its array argument once, so wrapping the
    value in a one-element array keeps an expensive expression from being
    inlined, and re-evaluated, at each place ``body`` mentions it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def map_of(pairs: Column) -> Column:
    """Array of (key, value) structs with unique keys to a map, keys in order."""
    return F.map_from_entries(F.sort_array(pairs))


def merged_maps(maps: Column | str) -> Column:
    """One map from an array of count maps, summing the counts of equal keys."""
    nothing = F.create_map().cast("map<string,bigint>")
    return F.aggregate(maps, nothing, lambda total, m: F.map_zip_with(
        total, m.cast("map<string,bigint>"),
        lambda key, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
    ))


def map_text(column: Column | str) -> Column:
    """Map rendered as ``k=v;k=v`` in key order, for sinks without map type."""
    entries = F.array_sort(F.map_entries(column))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))),
        ";",
    )


def id_bucket(column: Column | str) -> Column:
    """Portable uniform 32-bit number of an id: the first bits of its MD5."""
    column = F.col(column) if isinstance(column, str) else column
    digest = F.md5(column.cast("string").cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
