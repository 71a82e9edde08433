import pytest
from pyspark.sql import functions as F

from clientele.llm import mixing


def brute_targets(sizes):
    """The contract's wording: share, stop at the cap, reshare, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / total > 2 * sizes[s]]
        if not above:
            return target | {s: left * weight[s] / total for s in open_}
        for s in above:
            target[s] = 2.0 * sizes[s]
            open_.discard(s)
        left -= sum(target[s] for s in above)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 5000, None: 40}, {"é": 7, "z": 900, "a": 30, "b": 30, "c": 400, None: 1},
    {"a": 0, "b": 50},
])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def rows(n=3000):
    return [(i, "w " * (1 + i % 9), "hot" if i % 3 else f"s{i % 7}") for i in range(n)]


def test_taken_words(documents):
    out = mixing.mix_sizes(documents(rows())).toPandas()
    assert (out["taken"] <= 2 * out["size"]).all()
    for _, part in out.groupby("source"):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= 9
    again = mixing.mix_sizes(documents(rows()[::-1])).toPandas()
    columns = ["doc_id", "taken"]
    assert out[columns].sort_values("doc_id").values.tolist() == again[columns].sort_values("doc_id").values.tolist()


def test_mixed_rows_match_the_sizes(documents):
    docs = documents(rows(500))
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_sizes(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    words = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(
        F.sum(F.size(F.split(F.trim("text"), " "))).alias("n")).collect()}
    assert words == {k: v for k, v in taken.items() if v}


def test_better_text_first(documents):
    docs = documents([(i, ("good words " if i % 2 else "#$%& #$%& ") * 10, s) for i in range(2000) for s in ["a"]]
                     + [(10_000 + i, "x " * 20, "b") for i in range(2000)])
    out = mixing.mix_sizes(docs).where("source = 'b' or source = 'a'").toPandas()
    part = out[(out["source"] == "a") & (out["target"] % out["source_size"] > 0)]
    if len(part):
        extra = part["taken"] > (part["target"] // part["source_size"]) * part["size"]
        assert extra[part["doc_id"] % 2 == 1].mean() > extra[part["doc_id"] % 2 == 0].mean()


def test_odd_documents(odd_documents):
    out = mixing.mix_sizes(odd_documents).collect()
    assert len(out) == odd_documents.count()
    assert all(r["taken"] <= 2 * r["size"] for r in out)
    assert mixing.mix(odd_documents).columns == odd_documents.columns
