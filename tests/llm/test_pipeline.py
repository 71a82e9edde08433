"""The pipeline, stage by stage, against the operators' contracts."""

import hashlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from .test_neardup import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], SF).write.parquet(f"{tmp_path}/{name}")
        tables.append(spark.read.parquet(f"{tmp_path}/{name}"))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert tables[-1].columns == columns
    clean, single, cut, mixed, coded = tables[1:]
    assert clean.exceptAll(docs).count() == 0
    kept = [i for i, _, _, keep in brute([(r["doc_id"], r["text"]) for r in clean.collect()]) if keep]
    assert sorted(str(r["doc_id"]) for r in single.collect()) == sorted(kept)
    before = {r["doc_id"]: r for r in single.collect()}
    seen = set()
    for r in sorted(cut.collect(), key=lambda r: r["doc_id"]):
        source = before[r["doc_id"]]
        assert (r["lang"], r["source"], r["n_chars"]) == (source["lang"], source["source"], len(r["text"]))
        assert "�" not in r["text"] or "�" in source["text"]
        data = source["text"].encode()
        windows = {data[s:s + 100] for s in range(len(data) - 99)}
        if not windows & seen and len(windows) == max(0, len(data) - 99):
            assert r["text"] == source["text"]
        seen |= windows
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert all(r["text"] == texts[r["doc_id"]] for r in mixed.collect())
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert coded.count() == mixed.count()
    for r in coded.collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def staged(spark, docs, folder):
    """The result of every stage, each written and read again."""
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], SF).write.parquet(f"{folder}/{name}")
        tables.append(spark.read.parquet(f"{folder}/{name}"))
    return tables


def test_odd_documents(spark, odd_documents, tmp_path):
    """Nulls everywhere, empty and very long texts, repeated rows and columns with names that stages use."""
    docs, clean, single, cut, mixed, coded = staged(spark, odd_documents, tmp_path)
    assert clean.columns == single.columns == cut.columns == mixed.columns == docs.columns
    assert clean.count() == docs.count()
    texts = [(r["doc_id"], r["text"]) for r in single.collect()]
    assert len(texts) == len(set(texts)) and {None, 1, 2, 3, 4, 5, 7, 8} >= {i for i, _ in texts} >= {None, 1, 2, 3, 4, 7}
    # Null texts are empty from here on.
    after = {(r["doc_id"], r["text"]) for r in cut.collect()}
    assert (2, "") in after and (3, "") in after and all(t is not None for _, t in after)
    assert {r["name"] for r in mixed.collect()} == {"x"}
    rows = coded.collect()
    assert len(rows) == mixed.count() and all(r["n_tokens"] == len(r["ids"]) for r in rows)


def test_empty_documents(spark, odd_documents, tmp_path):
    tables = staged(spark, odd_documents.limit(0), tmp_path)
    assert [t.count() for t in tables] == [0] * 6
    assert all(t.columns == odd_documents.columns for t in tables[:-1])


def test_repeated_rows_and_copies(spark, documents, tmp_path):
    """Hundreds of copies under ids of their own, and of one row: one stays."""
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(i, text) for i in range(300)] + [(7, text)] * 200 + [(900 + i, f"{text} tail{i}") for i in range(50)]
    single = staged(spark, documents(rows).repartition(6), tmp_path)[2].collect()
    assert [(r["doc_id"], r["text"]) for r in single] == [(0, text)]
