"""Segments: a chain of filters over the profile and what it shows."""

from __future__ import annotations

import random
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FilterSpec:
    """One filter.

    ``between``   value (low, high), both ends included; a missing end is open
                  above at the column's maximum and closed below at 0
    ``eq``        column equals value
    ``in``        array column holds any of the values
    ``contains``  the array column, joined by commas, contains the text
    """

    column: str
    op: str
    value: Any = None
    label: str = ""
    enabled: bool = True

    def enable(self, value: Any = None) -> FilterSpec:
        return replace(self, enabled=True, value=self.value if value is None else value)

    def disable(self) -> FilterSpec:
        return replace(self, enabled=False)

    def predicate(self) -> Column:
        column = F.col(self.column)
        if self.op == "between":
            low, high = self.value or (None, None)
            inside = column >= (0 if low is None else low)
            return inside if high is None else inside & (column <= high)
        if self.op == "eq":
            return column == self.value
        if self.op == "in":
            return F.arrays_overlap(column, F.array(*[F.lit(v) for v in self.value]))
        if self.op == "contains":
            return F.concat_ws(",", column).contains(self.value)
        raise ValueError(f"unknown filter: {self.op}")

    def statement(self) -> str:
        if self.op == "between":
            low, high = self.value or (None, None)
            upper = f"max({self.column})" if high is None else high
            return f"{self.column} BETWEEN {0 if low is None else low} AND {upper}"
        if self.op == "eq":
            return f"{self.column} = {self.value}"
        if self.op == "in":
            return f"{self.column} HAS ANY OF ({', '.join(map(str, self.value))})"
        return f"{self.column} CONTAINS '{self.value}'"


# The sliders offered by default.
DEFAULT_FILTERS = (
    FilterSpec("friends_count", "between", label="Number of Friends", enabled=False),
    FilterSpec("average_stars", "between", label="Average Stars Given", enabled=False),
    FilterSpec("review_count", "between", label="Number of Review Given", enabled=False),
    FilterSpec("date_diff", "between", label="Active Days", enabled=False),
    FilterSpec("useful", "between", label="People Find Useful", enabled=False),
)


@dataclass(frozen=True)
class Segment:
    """A profile narrowed by the enabled filters, in order."""

    profile: DataFrame
    filters: tuple[FilterSpec, ...] = field(default=())

    def apply(self, filters: Iterable[FilterSpec]) -> Segment:
        return Segment(self.profile, (*self.filters, *filters))

    @property
    def active(self) -> list[FilterSpec]:
        return [f for f in self.filters if f.enabled]

    @property
    def stages(self) -> list[DataFrame]:
        """The profile after none, one, two, ... of the filters."""
        tables = [self.profile]
        for spec in self.active:
            tables.append(tables[-1].where(spec.predicate()))
        return tables

    @property
    def rows(self) -> DataFrame:
        return self.stages[-1]

    def funnel(self) -> DataFrame:
        """Rows left after each stage, counted in one pass over the profile.

        The flow runs from stage to stage and ends in the result.
        """
        passed, stages = F.lit(True), []
        steps = [("Original data", "", passed)]
        for spec in self.active:
            passed = passed & F.coalesce(spec.predicate(), F.lit(False))
            steps.append((f"Filter: '{spec.label}'", spec.statement(), passed))
        counts = self.profile.agg(
            *[F.count(F.when(condition, 1)).alias(f"s{i}") for i, (_, _, condition) in enumerate(steps)]
        )
        for i, (name, statement, _) in enumerate(steps):
            to = steps[i + 1][0] if i + 1 < len(steps) else "Result"
            stages.append(F.struct(
                F.lit(i + 1).alias("stage"), F.lit(name).alias("label"), F.lit(to).alias("flows_to"),
                F.lit(statement).alias("statement"), F.col(f"s{i}").alias("rows"),
            ))
        return counts.select(F.inline(F.array(*stages)))


def filter_bounds(profile: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Largest value per column and the last slider step, all in one aggregate."""
    columns = list(columns)
    return bounds_of(profile.agg(*[F.max(c).alias(c) for c in columns]), columns)


def bounds_of(tops: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The bounds from one row of largest values, wherever they come from."""
    return tops.select([F.col(c).cast("double").alias(c) for c in columns]).select(F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.col(c).alias("max_value"),
            F.ceil(c).cast("bigint").alias("last_step"),
        ) for c in columns
    ])))


def slice_and_dice(
    profile: DataFrame,
    dimensions: dict[str, Column],
    measures: Sequence[str],
    sets: Sequence[Sequence[str]] | None = None,
) -> DataFrame:
    """Users and summed measures by every combination of dimensions, and all totals over some of them.

    ``totals`` tells totals from missing values: its bits, the last dimension's
    the lowest, are 1 for dimensions summed over; a null where the bit is 0 is a
    value.  ``sets`` names the groupings wanted; all are made without it.

    The profile is counted by the finest groups first, and only these are
    repeated for the totals, so the shuffle does not grow with the number of
    totals times the users.
    """
    names = list(dimensions)
    finest = profile.groupBy(*[c.alias(n) for n, c in dimensions.items()]).agg(
        F.count("*").alias("users"), *[F.sum(m).alias(m) for m in measures])
    if sets is None:
        grouped = finest.cube(*names)
    else:
        grouped = finest.groupingSets([[F.col(n) for n in one] for one in sets], *names)
    return grouped.agg(
        F.grouping_id(*names).cast("bigint").alias("totals"), F.sum("users").alias("users"),
        *[F.sum(m).alias(m) for m in measures],
    )


def popular_entries(rows: DataFrame, map_column: str, n: int = 20) -> DataFrame:
    """The ``n`` keys of a count map with the largest sums."""
    return (
        rows.select(F.explode(map_column).alias("name", "value"))
        .groupBy("name")
        .agg(F.sum("value").alias("total"))
        .orderBy(F.desc("total"), "name")
        .limit(n)
    )


def popular_categories(rows: DataFrame, n: int = 20) -> DataFrame:
    return popular_entries(rows, "category_map", n)


def popular_words(rows: DataFrame, n: int = 20) -> DataFrame:
    return popular_entries(rows, "frequent_words_map", n)


def elite_per_year(rows: DataFrame, four_digits: bool = False) -> DataFrame:
    """Elite users per year, without the stray "20" entries of real lists.

    ``four_digits`` leaves out every number that is no four-digit year.
    """
    year = F.regexp_extract(F.col("token"), r"(\d+)", 1)
    wanted = F.length("year") == 4 if four_digits else ~F.col("year").isin("", "20")
    return (
        rows.select(F.explode("elite").alias("token"))
        .select(year.alias("year"))
        .where(wanted)
        .groupBy("year")
        .agg(F.count("*").alias("elite_users"))
        .orderBy(F.desc("elite_users"), "year")
    )


def emotions(rows: DataFrame) -> DataFrame:
    """Reviews per sentiment, summed over the segment, and their share."""
    sums = (
        rows.select(F.explode("sentiment_map").alias("emotion", "value"))
        .groupBy("emotion")
        .agg(F.sum("value").alias("reviews"))
    )
    # The window spans one row per sentiment.
    everything = F.sum("reviews").over(Window.partitionBy())
    return sums.withColumn("share", F.col("reviews") / everything)


def geo_points(rows: DataFrame) -> DataFrame:
    return rows.select("latitude", "longitude").dropna()


def preview(rows: DataFrame, n: int = 5, seed: int | None = None) -> DataFrame:
    """``n`` random rows: those with the smallest hashes of seed and user."""
    seed = random.getrandbits(32) if seed is None else seed
    draw = F.md5(F.concat(F.lit(f"{seed}:"), "user_id"))
    return rows.orderBy(draw, "user_id").limit(n)
