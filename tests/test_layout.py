"""Table layouts: what they hold, and what their readers do not have to do."""

import pytest
from pyspark.sql import functions as F

from clientele.operators import cleaning, features, reports
from clientele.operators import segment as seg
from clientele.plans import queries
from clientele.plans.profile import join_features
from clientele.sources import layout, standins

SF = "/root/testdata/sf0.001"


@pytest.fixture
def sort_merge(spark):
    """Joins as they are between tables too large to be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bucketed(spark, tmp_path, name, df, buckets=4):
    layout.save_bucketed(df, name, "user_id", buckets, path=str(tmp_path / name))
    return spark.table(name)


def test_model_join_moves_nothing(spark, sort_merge, tmp_path):
    maps = "sentiment_map map<string,bigint>, category_map map<string,bigint>, elite array<string>"
    rows = [(f"u{i}", i, {"positive": i}, {"a": i, "b": 1}, ["2019"]) for i in range(200)]
    profile = spark.createDataFrame(rows, f"user_id string, review_count bigint, {maps}")
    reviews = spark.createDataFrame([(f"u{i % 150}", "positive") for i in range(900)], "user_id string, sentiment string")
    status = profile.select("user_id", F.lit("New").alias("user_status"))
    expected = reports.joined_model(reviews, profile, status)
    tables = [bucketed(spark, tmp_path, n, df) for n, df in (("m_review", reviews), ("m_profile", profile), ("m_status", status))]
    got = reports.joined_model(*tables)
    assert "Exchange" in plan_of(expected) and "Exchange" not in plan_of(got) and plan_of(got).count("SortMergeJoin") == 2
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_users_meet_their_features_where_they_lie(spark, sort_merge, tmp_path):
    users = cleaning.clean_users(standins.raw_users(spark, SF))
    stored = bucketed(spark, tmp_path, "p_users", users, int(spark.conf.get("spark.sql.shuffle.partitions")))
    reviews = standins.raw_reviews(spark, SF).withColumns({
        "date": F.try_to_timestamp("date"), "sentiment": F.lit("neutral"), "frequent_words": F.array(F.lit("w"))})
    made = features.user_features(reviews, cleaning.clean_business(standins.raw_business(spark, SF)), ("activity", *features.PARTS))
    made.write.mode("overwrite").parquet(str(tmp_path / "made"))
    made = spark.read.parquet(str(tmp_path / "made")).repartition(4, "user_id")
    assert plan_of(join_features(users, made)).count("Exchange hashpartitioning(user_id") == 2
    joined = join_features(stored, made)
    assert plan_of(joined).count("Exchange hashpartitioning(user_id") == 1
    assert sorted(map(str, joined.collect())) == sorted(map(str, join_features(users, made).collect()))


def scanned_rows(df):
    """Rows that the scan handed on, after files and row groups were skipped."""
    rows = df.collect()
    node = df._jdf.queryExecution().executedPlan()
    metrics = df.sparkSession._jvm.scala.jdk.javaapi.CollectionConverters
    while node.nodeName().startswith(("AdaptiveSparkPlan",)):
        node = node.executedPlan()
    while not node.nodeName().startswith("Scan"):
        node = node.children().apply(0)
    return len(rows), metrics.asJava(node.metrics())["numOutputRows"].value()


def test_clustered_files_skip_row_groups(spark, tmp_path):
    """Narrow ranges of either column read a part of the rows; scattered rows are all read."""
    n = 40_000
    df = spark.range(0, n, 1, 8).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5000)).alias("b"), "id")
    df.write.parquet(str(tmp_path / "plain"))
    layout.save_clustered(df, str(tmp_path / "clustered"), ["a", "b"], files=16)
    plain, clustered = (spark.read.parquet(str(tmp_path / name)) for name in ("plain", "clustered"))
    assert sorted(map(tuple, clustered.collect())) == sorted(map(tuple, df.collect()))
    for condition in ("a between 100 and 110", "b between 3000 and 3040"):
        found, read = scanned_rows(plain.where(condition))
        assert read == n
        same, less = scanned_rows(clustered.where(condition))
        assert same == found and less <= 0.5 * n
    both = "a between 100 and 110 and b between 3000 and 3040"
    assert scanned_rows(clustered.where(both))[1] <= 0.2 * n


def test_clustered_with_nulls_ties_and_nothing(spark, tmp_path):
    rows = [(None, None), (1, None), (None, 2.5), (1, 1.0), (1, 1.0)]
    df = spark.createDataFrame(rows, "a int, b double")
    layout.save_clustered(df, str(tmp_path / "t"), ["a", "b"], files=3, rows_each=2)
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "t")).collect())) == sorted(map(str, df.collect()))
    layout.save_clustered(df.limit(0), str(tmp_path / "none"), ["a"], files=2)
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0


def test_bounds_come_from_footers(spark, tmp_path):
    df = spark.range(0, 5000, 1, 6).select(
        F.col("id").cast("int").alias("a"), (F.col("id") / 3).alias("b"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("c"))
    df.write.parquet(str(tmp_path / "t"))
    columns = ["a", "b", "c"]
    assert layout.reads_footers_only(spark, str(tmp_path / "t"), columns)
    tops = layout.largest_values(spark, str(tmp_path / "t"), columns)
    assert sorted(map(str, seg.bounds_of(tops, columns).collect())) == sorted(map(str, seg.filter_bounds(df, columns).collect()))


def test_bounds_without_statistics(spark, tmp_path):
    """Times have none that are pushed down: the values are read, with the same result."""
    df = spark.range(10).select(F.timestamp_seconds("id").alias("t"), "id")
    df.write.parquet(str(tmp_path / "t"))
    assert layout.largest_values(spark, str(tmp_path / "t"), ["t", "id"]).first() == df.agg(F.max("t"), F.max("id")).first()
    none = df.where("id < 0")
    none.write.parquet(str(tmp_path / "none"))
    assert list(layout.largest_values(spark, str(tmp_path / "none"), ["id"]).first()) == [None]


def test_clustered_files_follow_the_users(spark, monkeypatch):
    """A file of the clustered profile, and the task that sorts it, holds a bounded number of users."""
    asked, save = [], layout.save_clustered
    monkeypatch.setattr(queries, "FILE_USERS", 2)
    monkeypatch.setattr(layout, "save_clustered", lambda *rows, files: (asked.append(files), save(*rows, files=files)))
    rows = queries.QUERIES["seg_filter_clustered"](spark, SF)
    users = queries.profile_table(spark, SF).count()
    assert users > 16 and asked == [-(-users // 2)]
    assert sorted(map(str, rows.collect())) == sorted(map(str, queries.QUERIES["seg_filter_chain"](spark, SF).collect()))
