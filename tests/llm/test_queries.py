"""Registered queries against their SQL twins, and all of them on empty tables."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clientele.llm.oracle import ORACLE
from clientele.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings labels conversations".split()


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin(spark, name):
    base = duckdb.connect()
    for table in TABLES:
        base.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    twin = base.sql(ORACLE[name]).df()
    ours = QUERIES[name](spark, SF).toPandas()
    columns = sorted(twin.columns)
    assert sorted(ours.columns) == columns

    def ordered(rows):
        return rows[columns].sort_values(columns).reset_index(drop=True)

    pd.testing.assert_frame_equal(ordered(ours), ordered(twin), check_dtype=False, check_exact=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, name, tmp_path):
    for table in TABLES:
        spark.read.parquet(f"{SF}/{table}.parquet").where(F.lit(False)).write.parquet(f"{tmp_path}/{table}.parquet")
    rows = QUERIES[name](spark, str(tmp_path)).collect()
    assert len(rows) == (1 if name.startswith("op1_") else 0)
