import random

import pytest
from pyspark.sql import types as T

from clientele.session import prepare_workers

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside, as extra columns of the input.
CLASHES = ["score", "row", "size", "plan", "name", "doc", "part", "bucket", "member", "ids", "unit", "key", "shard", "taken"]


@pytest.fixture(autouse=True)
def _workers(spark):
    prepare_workers(spark)


@pytest.fixture
def documents(spark):
    """Documents from (id, text) or (id, text, source)."""
    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, COLUMNS)

    return build


@pytest.fixture
def odd_documents(spark):
    """Nulls everywhere, empty and very long texts, repeated rows, clashing columns."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    long = " ".join(rng.choice(vocabulary) for _ in range(60_000)) + "."
    plain = " ".join(rng.choice(vocabulary) for _ in range(120)) + "."
    rows = [
        (1, plain, "en", "a", 3), (1, plain, "en", "a", 3), (2, None, None, None, None), (3, "", "en", "b", 0),
        (4, " \t\n\x0b ", "en", "b", 5), (5, long, "en", "a", 9), (6, plain, "de", None, 1), (None, plain, "en", "b", 2),
        (None, "other words here", "en", "b", 2), (7, "one", "en", "b", 3), (8, long + " tail", "en", "é", 3),
    ]
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in CLASHES],
    ])
    return spark.createDataFrame([(*r, *["x"] * len(CLASHES)) for r in rows], schema)
