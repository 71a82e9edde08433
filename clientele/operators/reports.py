"""Reports over the profile and the reviews."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.schemas import REPORT_COLUMNS

POSITIVE, NEGATIVE, NEUTRAL = SENTIMENTS = ("positive", "negative", "neutral")


def user_status(
    profile: DataFrame,
    as_of: datetime.date | None = None,
    recent_days: int = 30,
    loyal_days: int = 365,
) -> DataFrame:
    """New, Loyal or Lapsed; null for recent users in between."""
    return profile.select(
        "user_id", "first_seen", "last_seen", status_column(as_of, recent_days, loyal_days).alias("user_status"))


def status_column(as_of: datetime.date | None = None, recent_days: int = 30, loyal_days: int = 365) -> Column:
    today = F.current_date() if as_of is None else F.lit(as_of)
    idle = F.datediff(today, "last_seen")
    return (
        F.when(F.datediff(today, "first_seen") <= recent_days, "New")
        .when((idle <= recent_days) & (F.datediff("last_seen", "first_seen") >= loyal_days), "Loyal")
        .when(idle > recent_days, "Lapsed")
    )


def sentiment_columns() -> list[Column]:
    """The three counts of ``sentiment_map``, 0 where one is missing."""
    return [
        F.coalesce(F.try_element_at("sentiment_map", F.lit(s)), F.lit(0)).alias(f"{s}_sentiment")
        for s in SENTIMENTS
    ]


def total_sentiment() -> Column:
    return F.col("positive_sentiment") + F.col("neutral_sentiment") + F.col("negative_sentiment")


def sentiment_pivot(profile: DataFrame, columns: list[str] = REPORT_COLUMNS) -> DataFrame:
    """Report columns plus one count per sentiment, one row per user."""
    return profile.select(*columns, *sentiment_columns())


def sentiment_ratios(profile: DataFrame) -> DataFrame:
    """Total and shares per user.  Positive and neutral are fractions guarded
    against an empty total; negative is a percentage and null without total."""
    total = total_sentiment()
    guarded = {
        f"{s}_ratio": F.when(total == 0, 0.0).otherwise(F.col(f"{s}_sentiment") / total)
        for s in (POSITIVE, NEUTRAL)
    }
    return sentiment_pivot(profile, ["user_id"]).select(
        "user_id",
        total.alias("total_sentiment"),
        *[value.alias(name) for name, value in guarded.items()],
        (F.try_divide("negative_sentiment", total) * 100).alias("negative_percent"),
    )


def sentiment_shares(profile: DataFrame) -> DataFrame:
    """Percent of all reviews per sentiment, one row per measure."""
    sums = sentiment_pivot(profile, []).agg(
        F.sum(total_sentiment()).alias("total"),
        *[F.sum(f"{s}_sentiment").alias(f"{s}_percent") for s in SENTIMENTS],
    )
    shares = sums.select(*[
        (F.try_divide(f"{s}_percent", "total") * 100).alias(f"{s}_percent") for s in SENTIMENTS
    ])
    return shares.unpivot([], [f"{s}_percent" for s in SENTIMENTS], "measure", "percent")


def sentiment_by_year(profile: DataFrame) -> DataFrame:
    """Sentiment counts by the year users joined."""
    return (
        sentiment_pivot(profile, ["yelping_since"])
        .groupBy(F.year("yelping_since").alias("year"))
        .agg(*[F.sum(f"{s}_sentiment").alias(f"{s}_sentiment") for s in SENTIMENTS])
    )


def sentiment_correlation(profile: DataFrame) -> DataFrame:
    """Correlation between the sentiment counts of a user."""
    pairs = [(POSITIVE, NEGATIVE), (POSITIVE, NEUTRAL), (NEGATIVE, NEUTRAL)]
    return sentiment_pivot(profile, []).agg(
        *[F.corr(f"{a}_sentiment", f"{b}_sentiment").alias(f"{a}_{b}") for a, b in pairs]
    )


def reviews_by_year(profile: DataFrame) -> DataFrame:
    """Review counts summed by the year users joined."""
    return profile.groupBy(F.year("yelping_since").alias("year")).agg(
        F.sum("review_count").alias("review_count")
    )


def reviews_by_review_year(reviews: DataFrame) -> DataFrame:
    """Reviews by the year they were written."""
    return reviews.groupBy(F.year("date").alias("year")).agg(F.count("*").alias("reviews"))


def category_long(profile: DataFrame, columns: list[str] = REPORT_COLUMNS) -> DataFrame:
    """One row per user and category."""
    kept = [c for c in columns if c != "category_map"]
    return profile.select(*kept, F.explode("category_map").alias("category_name", "category_count"))


def category_reviews(profile: DataFrame) -> DataFrame:
    """Review counts of the users who visited a category, largest first.

    A user's whole review count is added once per category visited.
    """
    return (
        category_long(profile, ["review_count"])
        .groupBy("category_name")
        .agg(F.sum("review_count").alias("user_reviews_in_category"))
        .orderBy(F.desc("user_reviews_in_category"), "category_name")
    )


def top_categories(profile: DataFrame, n: int = 500) -> DataFrame:
    """The ``n`` categories with the most visits."""
    return (
        category_long(profile, [])
        .groupBy("category_name")
        .agg(F.sum("category_count").alias("category_count"))
        .orderBy(F.desc("category_count"), "category_name")
        .limit(n)
    )


def elite_years(
    profile: DataFrame, columns: Sequence[str] = ("user_id",), as_text: bool = False
) -> DataFrame:
    """One row per user and elite year: as written, or as a number, null where
    there is none."""
    token = F.col("token")
    year = token if as_text else token.try_cast("int")
    return profile.select(*columns, F.explode("elite").alias("token")).select(
        *columns, year.alias("elite_year")
    )


def bin_of(column: str, size: int, peg: int = 0) -> Column:
    """Index of the fixed-width bin a value falls into."""
    return F.floor((F.col(column) - peg) / size)


def activity_heatmap(
    profile: DataFrame,
    day_size: int = 100,
    review_size: int = 50,
    day_bins: tuple[tuple[int, int], ...] = ((1, 49), (51, 55)),
) -> DataFrame:
    """Users and their reviews by bins of active days and of review counts."""
    kept = F.lit(False)
    for first, last in day_bins:
        kept = kept | F.col("day_bin").between(first, last)
    return (
        profile.select(
            bin_of("date_diff", day_size).alias("day_bin"),
            bin_of("review_count", review_size).alias("review_bin"),
            "review_count",
        )
        .where(kept)
        .groupBy("day_bin", "review_bin")
        .agg(F.count("review_count").alias("users"), F.sum("review_count").alias("reviews"))
    )


def business_bins(profile: DataFrame, size: int = 60) -> DataFrame:
    """Users by how many different businesses they reviewed."""
    return profile.groupBy(
        bin_of("different_business_count", size).alias("business_bin")
    ).agg(F.count("*").alias("users"))


def key_skew(rows: DataFrame, key: str, exact: bool = True) -> DataFrame:
    """How unevenly rows spread over a key.

    The exact percentile keeps one counter per distinct group size; pass
    ``exact=False`` for a sketch instead.
    """
    quantile = F.percentile if exact else F.percentile_approx
    return rows.groupBy(key).agg(F.count("*").alias("n")).agg(
        F.count("*").alias("keys"),
        F.sum("n").alias("rows"),
        F.max("n").alias("largest"),
        (F.max("n") / F.sum("n")).alias("largest_share"),
        quantile("n", F.lit(0.5)).cast("double").alias("median"),
        quantile("n", F.lit(0.99)).cast("double").alias("p99"),
    )


def joined_model(base: DataFrame, profile: DataFrame, status: DataFrame) -> DataFrame:
    """The related tables side by side, one row per user of ``base``.

    ``base`` holds (user_id, sentiment), one row per review.  Every relation is
    aggregated to the user before the join, so no measure is counted twice:
    map and array sizes come off the profile row itself.
    """
    records = base.groupBy("user_id").agg(F.count("*").alias("record_count"))
    per_user = profile.select(
        "user_id", "review_count", *sentiment_columns(),
        F.size("category_map").alias("categories"),
        F.aggregate(
            F.map_values("category_map"), F.lit(0).cast("bigint"), lambda total, n: total + n
        ).alias("category_count"),
        F.size("elite").alias("elite_years"),
    )
    return (
        records.join(per_user, "user_id", "left")
        .join(status.select("user_id", "user_status"), "user_id", "left")
    )
