"""Every registered query against its SQL twin on the smallest tables."""

import importlib.util
import sys

import duckdb
import pytest

import __spark_entry__ as entry_point
from clientele.plans.oracle import ORACLE
from clientele.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = """region nation customer supplier part orders lineitem events documents embeddings
    pages benchmark labels conversations""".split()


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(str(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, database, name):
    df = QUERIES[name](spark, SF)
    cursor = database.execute(ORACLE[name])
    expected = normal(cursor.fetchall(), [d[0] for d in cursor.description])
    assert normal(df.collect(), df.columns) == expected
    assert expected[1]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("hidden", [{"clientele.llm"}, {"corpus_pipeline"}, {"clientele.llm", "corpus_pipeline"}])
def test_entry_without_optional_parts(monkeypatch, hidden):
    """The other queries are there when the folder, the pipeline, or both are gone."""
    for name in [m for m in sys.modules if m.startswith("clientele.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    for name in hidden:
        monkeypatch.setitem(sys.modules, name, None)
    found, twins = entry_point.queries(), entry_point.oracle_sql()
    assert "pipeline" not in found and set(QUERIES) <= set(found) and set(ORACLE) <= set(twins)
    if "clientele.llm" in hidden:
        assert set(found) == set(QUERIES) and set(twins) == set(ORACLE)


def test_a_broken_optional_part_is_an_error(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("clientele.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "clientele.sources.files", None)
    if importlib.util.find_spec("clientele.llm") is None:
        pytest.skip("the optional part is not here")
    with pytest.raises(ModuleNotFoundError):
        entry_point.queries()


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
