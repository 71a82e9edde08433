import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from clientele.operators import reports
from clientele.operators import segment as seg
from clientele.operators.segment import DEFAULT_FILTERS, FilterSpec, Segment
from clientele.sources.files import export_csv

SCHEMA = """user_id string, friends_count int, average_stars double, elite array<string>, review_count bigint,
    category_map map<string,bigint>, sentiment_map map<string,bigint>, latitude double, longitude double,
    yelping_since timestamp, first_seen timestamp, last_seen timestamp, date_diff int,
    different_business_count bigint"""
TODAY = dt.date(2024, 1, 31)


def day(back):
    return dt.datetime.combine(TODAY, dt.time(9)) - dt.timedelta(days=back)


@pytest.fixture(scope="module")
def profile(spark):
    return spark.createDataFrame([
        ("new", 0, 1.0, ["2019", "20", "20", "2021"], 10, {"A": 5, "B": 1}, {"positive": 2}, 1.0, 2.0,
         day(900), day(0), day(0), 0, 3),
        ("loyal", 5, 4.5, ["2019"], 60, {"A": 2}, {"positive": 1, "negative": 3}, 1.0, None,
         day(900), day(365), day(0), 365, 61),
        ("lapsed", 10, 3.0, [""], 7, {"C": 7}, {}, None, None, day(500), day(400), day(31), 369, 120),
        ("none", None, None, None, 1, {}, {"neutral": 4}, 5.0, 6.0, day(500), day(100), day(0), 100, 1),
    ], SCHEMA)


def users(df):
    return {r.user_id for r in df.collect()}


def test_bounds_are_inclusive_and_drop_nulls(profile):
    between = lambda lo, hi: FilterSpec("friends_count", "between", (lo, hi))
    assert users(Segment(profile, (between(0, 10),)).rows) == {"new", "loyal", "lapsed"}
    assert users(Segment(profile, (between(5, 9),)).rows) == {"loyal"}
    assert users(Segment(profile, (between(None, None),)).rows) == {"new", "loyal", "lapsed"}


def test_membership(profile):
    assert users(Segment(profile, (FilterSpec("elite", "in", ("2021", "1999")),)).rows) == {"new"}
    assert users(Segment(profile, (FilterSpec("elite", "contains", "2019"),)).rows) == {"new", "loyal"}
    assert users(Segment(profile, (FilterSpec("review_count", "eq", 7),)).rows) == {"lapsed"}
    with pytest.raises(ValueError):
        FilterSpec("x", "near").predicate()


def test_default_filters_are_off_until_enabled(profile):
    assert users(Segment(profile, DEFAULT_FILTERS).rows) == {"new", "loyal", "lapsed", "none"}
    on = [f.enable((0, 4)) if f.column == "average_stars" else f for f in DEFAULT_FILTERS]
    assert users(Segment(profile).apply(on).rows) == {"new", "lapsed"}
    assert not on[1].disable().enabled


def test_funnel_counts_every_stage(profile):
    chain = (
        FilterSpec("friends_count", "between", (0, None), "Friends"),
        FilterSpec("average_stars", "between", (2, None), "Stars"),
        FilterSpec("review_count", "eq", 60, "Off", enabled=False),
        FilterSpec("review_count", "between", (0, 50), "Reviews"),
    )
    segment = Segment(profile, chain)
    rows = segment.funnel().orderBy("stage").collect()
    assert [r.rows for r in rows] == [4, 3, 2, 1] == [s.count() for s in segment.stages]
    assert [r.label for r in rows] == ["Original data", "Filter: 'Friends'", "Filter: 'Stars'", "Filter: 'Reviews'"]
    assert [r.flows_to for r in rows][-1] == "Result"
    assert rows[3].statement == "review_count BETWEEN 0 AND 50"


def test_bounds(profile):
    got = {r.column: (r.max_value, r.last_step) for r in seg.filter_bounds(profile, ["friends_count", "average_stars"]).collect()}
    assert got == {"friends_count": (10.0, 10), "average_stars": (4.5, 5)}


def test_summaries(profile):
    assert [(r.name, r.total) for r in seg.popular_categories(profile, 2).collect()] == [("A", 7), ("C", 7)]
    assert {(r.year, r.elite_users) for r in seg.elite_per_year(profile).collect()} == {("2019", 2), ("2021", 1)}
    assert {r.emotion: (r.reviews, r.share) for r in seg.emotions(profile).collect()} == {
        "positive": (3, 0.3), "negative": (3, 0.3), "neutral": (4, 0.4)}
    assert [tuple(r) for r in seg.geo_points(profile).orderBy("latitude").collect()] == [(1.0, 2.0), (5.0, 6.0)]
    assert seg.preview(profile, 2).count() == 2


def test_export(spark, profile, tmp_path):
    export_csv(profile.select("user_id", "category_map", "elite"), str(tmp_path / "out"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out")).collect()
    row = next(r for r in back if r.user_id == "new")
    assert json.loads(row.category_map) == {"A": 5, "B": 1} and json.loads(row.elite)[0] == "2019"


def test_status(profile):
    got = {r.user_id: r.user_status for r in reports.user_status(profile, TODAY).collect()}
    assert got == {"new": "New", "loyal": "Loyal", "lapsed": "Lapsed", "none": None}
    short = {r.user_id: r.user_status for r in reports.user_status(profile, TODAY, recent_days=10).collect()}
    assert short["loyal"] == "Loyal"
    assert reports.user_status(profile).count() == 4


def test_sentiment_ratios(profile):
    rows = {r.user_id: r for r in reports.sentiment_ratios(profile).collect()}
    assert (rows["loyal"].positive_ratio, rows["loyal"].negative_percent) == (0.25, 75.0)
    assert (rows["lapsed"].total_sentiment, rows["lapsed"].positive_ratio, rows["lapsed"].negative_percent) == (0, 0.0, None)
    shares = {r.measure: r.percent for r in reports.sentiment_shares(profile).collect()}
    assert shares == pytest.approx({"positive_percent": 30.0, "negative_percent": 30.0, "neutral_percent": 40.0})


def test_bins(profile):
    heat = {(r.day_bin, r.review_bin): (r.users, r.reviews) for r in reports.activity_heatmap(profile).collect()}
    assert heat == {(3, 1): (1, 60), (3, 0): (1, 7), (1, 0): (1, 1)}
    wide = reports.activity_heatmap(profile, day_bins=((0, 100),))
    assert sum(r.users for r in wide.collect()) == 4
    bins = {r.business_bin: r.users for r in reports.business_bins(profile).collect()}
    assert bins == {0: 2, 1: 1, 2: 1}


def test_long_tables(profile):
    assert reports.category_long(profile, ["user_id"]).count() == 4
    years = reports.elite_years(profile).where(F.col("elite_year").isNull())
    assert users(years) == {"lapsed"}
    ranking = [(r.category_name, r.user_reviews_in_category) for r in reports.category_reviews(profile).collect()]
    assert ranking == [("A", 70), ("B", 10), ("C", 7)]


def test_model_counts_each_user_once(spark, profile):
    base = spark.createDataFrame([("new", "positive")] * 2 + [("stranger", "neutral")], "user_id string, sentiment string")
    rows = {r.user_id: r for r in reports.joined_model(base, profile, reports.user_status(profile, TODAY)).collect()}
    assert set(rows) == {"new", "stranger"}
    assert (rows["new"].record_count, rows["new"].category_count, rows["new"].elite_years) == (2, 6, 4)
    assert rows["stranger"].review_count is None


def test_skew(spark):
    df = spark.createDataFrame([("a",)] * 8 + [("b",), ("c",)], "k string")
    row = reports.key_skew(df, "k").first()
    assert (row.keys, row.rows, row.largest, row.largest_share, row.median) == (3, 10, 8, 0.8, 1.0)
    assert reports.key_skew(df, "k", exact=False).first().median == 1.0


def test_slice_and_dice(spark):
    """Missing values are groups of their own, and totals are told from them."""
    rows = [("a", "x", 1, 10), ("b", None, 1, 5), ("c", "x", None, 1), ("d", None, None, 2), ("e", "y", 1, 3)]
    profile = spark.createDataFrame(rows, "user_id string, city string, year int, n long")
    dimensions = {"city": F.col("city"), "year": F.col("year")}
    got = {(r["totals"], r["city"], r["year"]): (r["users"], r["n"]) for r in seg.slice_and_dice(profile, dimensions, ["n"]).collect()}
    assert got == {
        (0, "x", 1): (1, 10), (0, None, 1): (1, 5), (0, "x", None): (1, 1), (0, None, None): (1, 2), (0, "y", 1): (1, 3),
        (1, "x", None): (2, 11), (1, None, None): (2, 7), (1, "y", None): (1, 3),
        (2, None, 1): (3, 18), (2, None, None): (2, 3), (3, None, None): (5, 21),
    }
    some = seg.slice_and_dice(profile, dimensions, ["n"], sets=[("year",), ()]).collect()
    assert {(r["totals"], r["year"], r["n"]) for r in some} == {(2, 1, 18), (2, None, 3), (3, None, 21)}
    assert seg.slice_and_dice(profile.limit(0), dimensions, ["n"], sets=[("year",)]).count() == 0


def test_slices_expand_groups_not_users(spark):
    """The rows are repeated for the totals only after they have been counted."""
    profile = spark.range(0, 10_000, 1, 4).select((F.col("id") % 3).alias("a"), (F.col("id") % 5).alias("b"), F.col("id").alias("n"))
    plan = seg.slice_and_dice(profile, {"a": F.col("a"), "b": F.col("b")}, ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and "HashAggregate" in plan[plan.index("Expand"):]
