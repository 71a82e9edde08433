import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from clientele.llm import toxicity


def corpus(n=600):
    rng = random.Random(2)
    words = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(n):
        toxic = int(i % 5 == 0)
        text = [rng.choice(words) for _ in range(60)] + (["vile", "scumbag"] if toxic else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text), toxic))
    return rows


def test_held_out_accuracy(spark, documents):
    rows = corpus()
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in toxicity.score_documents(documents([r[:2] for r in rows]), labels).collect()}
    held = [(i, t) for i, _, t in rows if out[i]["held_out"]]
    assert {i for i, _ in held} == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(out[i]["predicted"] == t for i, t in held)


def test_held_out_labels_are_not_learnt_from(spark, documents):
    rows = corpus()
    def scores(flip):
        labels = [(i, 1, 1 - t if flip and zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, _, t in rows]
        table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        return {r["doc_id"]: r["score"] for r in toxicity.score_documents(documents([r[:2] for r in rows]), table).collect()}

    assert scores(False) == scores(True)


def test_risk_gradient():
    """Numeric gradient of the risk where it is not negative, reversed where it is."""
    rng = np.random.default_rng(0)
    def risk(p, u, prior):
        part = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
        return (prior * np.logaddexp(0, -p).mean() + part) if part >= 0 else -part

    for shift in (0.0, -4.0):
        p, u, prior = rng.normal(2, 1, 5), rng.normal(shift, 1, 7), 0.4
        g_p, g_u = toxicity.nnpu_gradient(p, u, prior)
        for i in range(5):
            step = np.eye(5)[i] * 1e-6
            assert abs((risk(p + step, u, prior) - risk(p - step, u, prior)) / 2e-6 - g_p[i]) < 1e-5
        for i in range(7):
            step = np.eye(7)[i] * 1e-6
            assert abs((risk(p, u + step, prior) - risk(p, u - step, prior)) / 2e-6 - g_u[i]) < 1e-5


def test_odd_documents(spark, odd_documents):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    out = toxicity.score_documents(odd_documents, labels).collect()
    assert len(out) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.remove_toxic(odd_documents, labels).columns == odd_documents.columns
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score_documents(odd_documents, none).collect()} == {0.0}


def test_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = toxicity.score_documents(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    held = out.where("held_out").join(labels, "doc_id").collect()
    clean = [r["predicted"] for r in held if r["toxic"] == 0]
    assert sum(clean) <= 0.05 * len(clean)


def test_members_have_draws_of_their_own():
    """The rows that differ lie in the middle, where slices of sorted rows would all have them."""
    toxic, usual, odd = (np.array([i], dtype=np.uint32) for i in (1, 2, 3))
    positive = [np.r_[toxic, odd] if 50 <= i < 150 else toxic for i in range(200)]
    model = toxicity.fit(positive, [usual] * 200, 0.3)
    assert len({tuple(w) for w in model.weights.T}) == toxicity.MEMBERS


def test_sample_bounds():
    assert (toxicity.MAX_POSITIVES, toxicity.MAX_UNLABELLED) == (4000, 6000)


def test_recall_on_held_out_toxic_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = toxicity.score_documents(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    toxic = [r["predicted"] for r in out.where("held_out").join(labels, "doc_id").where("toxic = 1").collect()]
    assert len(toxic) > 30 and sum(toxic) >= 0.9 * len(toxic)


def test_against_a_plain_refit(spark, documents):
    """Features, weights and scores are those of a fit on plain lists of all training texts."""
    rows = corpus(400)
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    docs = documents([r[:2] for r in rows]).repartition(5)
    model = toxicity.learn(docs, labels)
    training = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    hashes = {i: np.unique(np.array([f for w in toxicity.text_words(t) for f in toxicity.word_features(w)], dtype=np.uint32))
              for i, t, _ in training}
    prior = sum(t for _, _, t in training) / len(training)
    plain = toxicity.fit([hashes[i] for i, _, t in training if t], [hashes[i] for i, _, _ in training], prior)
    assert model.features.tolist() == plain.features.tolist() and len(plain.features)
    assert np.array_equal(model.weights, plain.weights) and np.array_equal(model.intercepts, plain.intercepts)
    for r in toxicity.score_documents(docs, labels).collect():
        present = np.isin(plain.features, [f for w in toxicity.text_words(rows[r["doc_id"]][1]) for f in toxicity.word_features(w)])
        assert abs(r["score"] - plain.score(np.flatnonzero(present))) < 1e-6


def test_samples_have_their_size_and_no_single_task_sorts(spark, documents):
    """Smallest hashes, without a sort of candidates of all tasks in one."""
    rows = corpus(600)
    docs = documents([r[:2] for r in rows]).repartition(7)
    training = spark.createDataFrame([(i, t) for i, _, t in rows if zlib.crc32(str(i).encode()) % 5], "doc_id long, toxic int")
    sample = toxicity.sample_features(docs, training, 20, 100)
    assert (sample.where("positive").count(), sample.where("NOT positive").count()) == (20, 100)
    open_docs = docs.where(toxicity.remainder(F.col("doc_id")) != 0)
    drawn = open_docs.orderBy(F.xxhash64("doc_id", "text", F.lit("unlabelled"))).limit(100)
    assert {r["doc_id"] for r in drawn.collect()} == {r["doc_id"] for r in sample.where("NOT positive").collect()}


def test_repeated_rows_and_null_ids_are_sampled_once(spark, documents):
    rows = [(1, "vile scumbag")] * 300 + [(None, "null id")] * 300 + [(i, f"word{i % 7} other") for i in range(2, 40)]
    training = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    sample = toxicity.sample_features(documents(rows).repartition(4), training, 10, 1000).collect()
    assert sum(r["positive"] for r in sample) == 1 and all(r["doc_id"] is not None for r in sample)
    assert len(sample) == len({(r["doc_id"], r["positive"], bytes(r["features"])) for r in sample})
