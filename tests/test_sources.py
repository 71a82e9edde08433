import json

import pytest
from pyspark.sql import functions as F

from clientele import schemas
from clientele.functions.columns import map_text
from clientele.plans.profile import RawPaths, run_batch
from clientele.sources import files, standins, topics

SF = "/root/testdata/sf0.001"


def test_materialize_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    path = str(tmp_path / "t")
    assert files.materialize(spark, path, build, files=1).count() == 5
    assert files.materialize(spark, path, build).count() == 5
    assert len(calls) == 1


def test_materialize_builds_again_for_something_else(spark, tmp_path):
    path = str(tmp_path / "t")
    assert files.materialize(spark, path, lambda: spark.range(5), made_from="a\nb").count() == 5
    assert files.materialize(spark, path, lambda: spark.range(6), made_from="a\nb").count() == 5
    assert files.materialize(spark, path, lambda: spark.range(7), made_from="a\nc").count() == 7


def test_an_unfinished_write_is_built_again(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    (tmp_path / "t" / "_SUCCESS").rename(tmp_path / "gone")
    assert files.materialize(spark, str(tmp_path / "t"), lambda: spark.range(7)).count() == 7


def test_build_errors_surface(spark, tmp_path):
    with pytest.raises(ZeroDivisionError):
        files.materialize(spark, str(tmp_path / "t"), lambda: 1 / 0)


def test_json_objects_fit_text_maps(spark, tmp_path):
    path = tmp_path / "b.json"
    path.write_text('{"business_id":"b","attributes":{"WiFi":"free","Parking":{"lot":true},"Price":2},"stars":4.5}\n{bad\n')
    good, bad = files.read_json(spark, str(path), schemas.BUSINESS).collect()
    assert good.attributes == {"WiFi": "free", "Parking": '{"lot":true}', "Price": "2"} and good.stars == 4.5
    assert bad.business_id is None


def test_lexicon_file(spark, tmp_path):
    path = tmp_path / "lexicon.txt"
    path.write_text('good\t1.9\t0.9\t[1, 2]\nbad\t-2.5\t0.6\t[-3]\n:")\t2.0\t0.1\t[2]\n\nodd\n')
    got = {r.word: r.valence for r in files.read_lexicon(spark, str(path)).collect()}
    assert got == {"good": 1.9, "bad": -2.5, ':")': 2.0}


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("u", {"b": 1, "a": 2})], "user_id string, m map<string,bigint>")
    files.save_table(df, "round_trip", path=str(tmp_path / "t"))
    assert spark.table("round_trip").first().m == {"a": 2, "b": 1}
    files.save_table(df.limit(0), "round_trip", path=str(tmp_path / "t"))
    assert spark.table("round_trip").count() == 0
    files.save_table(files.flat_columns(df), "", format="parquet", path=str(tmp_path / "flat"))
    assert json.loads(spark.read.parquet(str(tmp_path / "flat")).first().m) == {"a": 2, "b": 1}
    assert df.select(map_text("m")).first()[0] == "a=2;b=1"


def test_spread_deals_out_uneven_scans(spark, tmp_path):
    """Many splits, one row group: all rows lie in one split."""
    rows = spark.range(5000).withColumn("text", F.repeat(F.sha2(F.col("id").cast("string"), 512), 400))
    rows.coalesce(1).write.option("parquet.block.size", 2**30).parquet(str(tmp_path / "one"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        scan = spark.read.parquet(str(tmp_path / "one"))
        before = scan.groupBy(F.spark_partition_id()).count().count()
        dealt = files.spread(scan)
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert before == 1 and len(sizes) >= files.SPREAD_TASKS and max(sizes) < 2 * 5000 / len(sizes)
    assert sorted(r.id for r in dealt.select("id").collect()) == list(range(5000))


def test_spread_leaves_even_scans_alone(spark):
    many = spark.range(0, 1000, 1, 40)
    assert files.spread(many) is many
    none = spark.range(0)
    assert files.spread(none) is none
    assert files.spread(spark.range(0, 100, 1, 1), tasks=8).rdd.getNumPartitions() == 8


def test_scratch_is_the_shared_folder(spark):
    assert files.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("fraction", [1.0, 0.3])
def test_batch_run_from_json_files(spark, tmp_path, fraction):
    raw = {
        "users": standins.raw_users, "business": standins.raw_business, "reviews": standins.raw_reviews,
        "tips": standins.raw_tips, "checkins": standins.raw_checkins,
    }
    for name, read in raw.items():
        read(spark, SF).write.json(str(tmp_path / name))
    paths = RawPaths(**{name: str(tmp_path / name) for name in raw})
    lexicon = spark.createDataFrame([("the", 1.0), ("of", -1.5)], "word string, valence double")
    out = str(tmp_path / "out")
    profile = run_batch(spark, paths, out, lexicon, fraction)
    assert profile.columns == schemas.PROFILE_COLUMNS
    folder = files.sample_dir(out, fraction)
    users = spark.read.parquet(f"{folder}/user")
    assert 0 < profile.count() <= users.count()
    if fraction < 1:
        ids = spark.read.parquet(f"{folder}/sampled_user_id")
        assert users.join(ids, "user_id", "left_anti").count() == 0
        visited = spark.read.parquet(f"{folder}/review").select("business_id").distinct()
        assert visited.join(spark.read.parquet(f"{folder}/business"), "business_id", "left_anti").count() == 0
    assert spark.read.parquet(f"{folder}/checkin").schema["date"].dataType.simpleString() == "array<timestamp>"
    again = run_batch(spark, paths, out, lexicon, fraction)
    assert again.count() == profile.count()


def _raw_files(spark, folder):
    raw = {"users": standins.raw_users, "business": standins.raw_business, "reviews": standins.raw_reviews,
           "tips": standins.raw_tips, "checkins": standins.raw_checkins}
    for name, read in raw.items():
        read(spark, SF).write.json(str(folder / name))
    return RawPaths(**{name: str(folder / name) for name in raw})


def test_runs_with_other_arguments_into_one_output(spark, tmp_path):
    paths = _raw_files(spark, tmp_path)
    lexicon = spark.createDataFrame([("the", 1.0), ("of", -1.5)], "word string, valence double")
    out, counts = str(tmp_path / "out"), {}
    inner = run_batch(spark, paths, out, lexicon, 0.5, "hash", "inner", counts=counts).count()
    assert counts["combined"] == inner and counts["review"] > counts["user"] > 0
    top = run_batch(spark, paths, out, lexicon, 0.5, "top", "left", empty_friends=("None",))
    alone = run_batch(spark, paths, str(tmp_path / "other"), lexicon, 0.5, "top", "left", empty_friends=("None",))
    assert sorted(map(str, top.collect())) == sorted(map(str, alone.collect()))
    other = lexicon.withColumn("valence", -F.col("valence"))
    turned = run_batch(spark, paths, out, other, 0.5, "top", "left", empty_friends=("None",))
    assert sorted(map(str, turned.collect())) != sorted(map(str, alone.collect()))


def test_command_line(spark, tmp_path):
    from clientele.__main__ import main

    arguments = ["profile", "--output", str(tmp_path / "out"), "--lexicon", str(tmp_path / "lexicon.txt"),
                 "--sample", "0.5", "--mode", "top", "--how", "left"]
    (tmp_path / "lexicon.txt").write_text("the\t1.0\nof\t-1.5\n")
    raw = {"users": standins.raw_users, "business": standins.raw_business, "reviews": standins.raw_reviews,
           "tips": standins.raw_tips, "checkins": standins.raw_checkins}
    for name, read in raw.items():
        read(spark, SF).write.json(str(tmp_path / name))
        arguments += [f"--{name}", str(tmp_path / name)]
    main(arguments)
    profile = spark.read.parquet(files.sample_dir(str(tmp_path / "out"), 0.5) + "/combined")
    assert profile.count() == 75 and profile.columns == schemas.PROFILE_COLUMNS


def test_json_is_written_compressed_and_read_back(spark, tmp_path):
    rows = spark.range(3000).select(
        F.concat(F.lit("business-"), "id").alias("business_id"), F.when(F.col("id") % 3 > 0, "2020-01-01, 2020-01-02").alias("date"))
    files.write_json(rows, str(tmp_path / "j"))
    assert sum(p.stat().st_size for p in (tmp_path / "j").glob("part-*")) < 40_000
    assert sorted(map(str, files.read_json(spark, str(tmp_path / "j"), schemas.CHECKIN).collect())) == sorted(map(str, rows.collect()))
    topics.write_replay(rows, str(tmp_path / "m"), files=2)
    parts = list((tmp_path / "m").glob("part-*"))
    assert len(parts) == 2 and sum(p.stat().st_size for p in parts) < 40_000
    assert spark.read.schema(schemas.CHECKIN).json(str(tmp_path / "m")).count() == 3000


def test_sent_messages_are_compressed(spark, tmp_path):
    from clientele.plans import queries

    rows = spark.range(50).select(F.col("id").cast("string").alias("review_id"), F.lit("x" * 200).alias("text"))
    queries._send(rows.coalesce(2), str(tmp_path / "m"))
    queries._send(rows.coalesce(1), str(tmp_path / "m"))
    assert len(list((tmp_path / "m").glob("*.txt.gz"))) == 3
    read = spark.read.text(str(tmp_path / "m"))
    assert topics.decode(read, schemas.REVIEW).count() == 100
    assert files.folder_bytes(spark, str(tmp_path / "m")) < 100 * 200


def test_micro_batches_follow_the_messages():
    """Half of the files at most, and no more bytes however many files there are."""
    from clientele.plans import queries

    assert queries._pace(4, 1000) == 2 and queries._pace(5, 0) == 3
    files_each = queries._pace(1000, 20 * queries.BATCH_BYTES)
    assert files_each == 50 and queries._pace(1, 9 * queries.BATCH_BYTES) == 1
