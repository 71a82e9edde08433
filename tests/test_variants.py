"""Profiles with variants: whole round trip, paths, flattening, odd keys."""

import pytest
from pyspark.sql import functions as F

from clientele.operators import variants

MAPS = "user_id string, category_map map<string,bigint>, elite array<string>, category_avg_stars map<string,double>"
ROWS = [
    ("a", {"Food": 3, "It's \"odd\"": 1, "a.b[0]": 2, "日本\\x": 5}, ["2019", "2020"], {"Food": 4.5}),
    ("b", {}, [], {}),
    ("c", None, None, None),
    ("d", {"": 7, "Food": None}, [None, ""], {"x": float("nan")}),
]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("variants"))
    variants.publish_variants(spark.createDataFrame(ROWS, MAPS), "variant_profile", path=path)
    return variants.load_variants(spark, "variant_profile")


def test_stored_as_variants(stored):
    assert {t for c, t in stored.dtypes if c != "user_id"} == {"variant"}


def test_round_trip(stored):
    back = variants.typed_variants(stored)
    got = {r["user_id"]: r for r in back.collect()}
    for user, categories, elite, stars in ROWS[:3]:
        assert (got[user]["category_map"], got[user]["elite"], got[user]["category_avg_stars"]) == (categories, elite, stars)
    assert got["d"]["category_map"] == {"": 7, "Food": None} and got["d"]["elite"] == [None, ""]


def test_paths_of_any_key(stored):
    for key, n in (("Food", 3), ("a.b[0]", 2), ("missing", None)):
        value = stored.where("user_id = 'a'").select(variants.at_path("category_map", key, "bigint")).first()[0]
        assert value == n
    kinds = stored.select(variants.at_path("elite", "Food", "bigint").alias("v")).collect()
    assert {r["v"] for r in kinds} == {None}


def test_flattened(stored):
    rows = variants.flattened(stored.select("user_id", "category_map"), "category_map", "name", "n", "bigint").collect()
    expected = {(u, k, n) for u, m, *_ in ROWS for k, n in (m or {}).items()}
    assert {tuple(r) for r in rows} == expected and len(rows) == len(expected)


def test_text_that_is_no_json(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("{",), (None,)], "v string")
    parsed = variants.parsed_variants(df, ["v"]).select(F.try_variant_get("v", "$.a", "int").alias("a")).collect()
    assert [r["a"] for r in parsed] == [1, None, None]


def test_readers_of_other_columns_skip_variants(stored):
    plan = stored.select("user_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:string>" in plan
