"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; a sample of all texts, whatever their
labels, is the unlabelled set.  With class prior ``p`` the risk is estimated as

    p * E_pos[loss(g)] + max(0, E_unl[loss(-g)] - p * E_pos[loss(-g)])

and minimised by small linear numpy classifiers on the presence of words and
word beginnings; where the bracket turns negative, its gradient is reversed, so
that the estimate cannot be driven below zero by overfitting.  The mean of
``MEMBERS`` classifiers, each on its own draw, gives the score.

Fitted on bounded samples: ``MAX_POSITIVES`` confirmed toxic texts and
``MAX_UNLABELLED`` texts, those with the smallest hashes (of the id, and of id
and text).  The class prior is the share of toxic rows among all labelled
training rows.  Every text is scored whole.

Sampling is a condition on the row's own hash: one pass counts the rows, a second
gathers the hashes below a mark a little above the wanted share, of which the
last wanted one is the cut.  Features are counted and chosen where the sampled
texts are; what reaches the one task that fits is a row of ``MAX_FEATURES`` bits
for each, however long the text, and what reaches the driver is the weights.

Only rows whose crc32(doc_id as text) leaves a remainder of 1 to 4 when divided
by 5 are learnt from.  Ids, sources, languages and labels are no features.

Defined results: null and empty texts have no features and get the score of the
intercept; repeated rows are scored each for itself; labels that repeat an id
count once, as toxic if any says so; null labels are no labels; without a
positive to learn from every score is 0; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.sources.files import cut_lineage

MAX_POSITIVES = 4000
MAX_UNLABELLED = 6000
MAX_FEATURES = 1024
MEMBERS = 3
STEPS = 160
# Features differ between the sets by so many standard errors.
LEAST_Z = 4
DECAY = 3e-4
FOLDS = 5
_WORD = re.compile(r"\w+")
_STEMS = (3, 4, 5, 6)
_CACHE_WORDS = 50_000


def remainder(doc_id: Column) -> Column:
    digits = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return F.pmod(F.crc32(digits), F.lit(FOLDS))


def word_features(word: str) -> list[int]:
    """A word and its beginnings, as 32-bit hashes."""
    names = [word + "$", *(word[:n] for n in _STEMS if n <= len(word))]
    return [zlib.crc32(n.encode("utf-8", "surrogatepass")) for n in names]


def text_words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass(frozen=True)
class Classifier:
    """Sorted feature hashes, their weights in each member, and intercepts."""

    features: np.ndarray
    weights: np.ndarray
    intercepts: np.ndarray

    def score(self, present: np.ndarray) -> float:
        """Score of a text from the rows of ``features`` present in it."""
        margins = self.intercepts + self.weights[present].sum(axis=0)
        return float(1 / (1 + np.exp(-np.clip(margins.mean(), -60, 60))))


def _choose_features(positive: list[np.ndarray], unlabelled: list[np.ndarray], limit: int) -> np.ndarray:
    """Features whose share differs most, in standard errors, between the sets."""
    def shares(texts):
        ids, counts = np.unique(np.concatenate(texts) if texts else np.empty(0, np.uint32), return_counts=True)
        return ids, counts / max(1, len(texts))

    (ids_p, share_p), (ids_u, share_u) = shares(positive), shares(unlabelled)
    ids = np.union1d(ids_p, ids_u)
    p, u = np.zeros(len(ids)), np.zeros(len(ids))
    p[np.searchsorted(ids, ids_p)] = share_p
    u[np.searchsorted(ids, ids_u)] = share_u
    n_p, n_u = max(1, len(positive)), max(1, len(unlabelled))
    pooled = (p * n_p + u * n_u) / (n_p + n_u)
    z = np.abs(p - u) / np.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u) + 1e-12)
    usual = pooled * (n_p + n_u) >= 3
    best = np.argsort(-np.where(usual, z, 0), kind="stable")[:limit]
    return np.sort(ids[best[z[best] > LEAST_Z]])


def _presence(texts: list[np.ndarray], features: np.ndarray) -> np.ndarray:
    out = np.zeros((len(texts), len(features)), dtype=bool)
    for i, ids in enumerate(texts):
        at = np.searchsorted(features, ids)
        at[at == len(features)] = 0
        if len(features):
            out[i, at[features[at] == ids]] = True
    return out


def nnpu_gradient(margin_p: np.ndarray, margin_u: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the non-negative risk, with logistic loss, by margin."""
    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -60, 60)))

    n_p, n_u = max(1, len(margin_p)), max(1, len(margin_u))
    negative_risk = np.logaddexp(0, margin_u).mean() - prior * np.logaddexp(0, margin_p).mean()
    down_u, down_p = sigmoid(margin_u) / n_u, -prior * sigmoid(margin_p) / n_p
    if negative_risk < 0:
        return -down_p, -down_u
    return prior * (sigmoid(margin_p) - 1) / n_p + down_p, down_u


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
        max_features: int = MAX_FEATURES, members: int = MEMBERS, steps: int = STEPS) -> Classifier:
    """Classifiers on the feature hashes of texts."""
    features = _choose_features(positive, unlabelled, max_features)
    return fit_presence(features, _presence(positive, features), _presence(unlabelled, features), prior, members, steps)


def fit_presence(features: np.ndarray, x_p: np.ndarray, x_u: np.ndarray, prior: float,
                 members: int = MEMBERS, steps: int = STEPS) -> Classifier:
    """Classifiers on texts as rows of booleans, one per feature."""
    weights, intercepts = [], []
    for member in range(members):
        # One byte a feature is kept; only the rows of one member at a time are numbers.
        draw = np.random.default_rng(member)
        p = u = None
        p, u = (x[draw.permutation(len(x))[: max(1, int(0.9 * len(x)))]].astype(np.float32) for x in (x_p, x_u))
        w, moment, square = (np.zeros(len(features) + 1, dtype=np.float32) for _ in range(3))
        w[-1] = np.log(prior / (1 - prior))
        for step in range(1, steps + 1):
            g_p, g_u = nnpu_gradient(p @ w[:-1] + w[-1], u @ w[:-1] + w[-1], prior)
            g_p, g_u = g_p.astype(np.float32), g_u.astype(np.float32)
            grad = np.r_[g_p @ p + g_u @ u + DECAY * w[:-1], g_p.sum() + g_u.sum()]
            moment, square = 0.9 * moment + 0.1 * grad, 0.99 * square + 0.01 * grad**2
            w -= np.float32(0.05) * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        weights.append(w[:-1])
        intercepts.append(w[-1])
    return Classifier(features, np.stack(weights, axis=1), np.array(intercepts))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = []
        for text in batch.column("text"):
            ids = {f for w in text_words(text.as_py()) for f in word_features(w)}
            packed.append(np.array(sorted(ids), dtype=np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("kinds"), pa.array(packed, pa.binary())],
            ["doc_id", "kinds", "features"])


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many positive and how many unlabelled texts of a batch have a feature."""
    for batch in batches:
        texts = [np.frombuffer(f.as_py(), dtype=np.uint32) for f in batch.column("features")]
        kind = np.repeat(batch.column("positive").to_numpy(zero_copy_only=False).astype(bool), [len(t) for t in texts])
        ids, at = np.unique(np.concatenate(texts) if texts else np.empty(0, np.uint32), return_inverse=True)
        counts = [pa.array(np.bincount(at[of], minlength=len(ids))) for of in (kind, ~kind)]
        yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), *counts], ["feature", "n_p", "n_u"])


def _presence_rows(features: np.ndarray):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(_presence([np.frombuffer(f.as_py(), dtype=np.uint32)], features)[0]).tobytes()
                    for f in batch.column("features")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("positive"), pa.array(bits, pa.binary())],
                ["doc_id", "positive", "bits"])

    return pack


def _fitter(features: np.ndarray, prior: float, max_positives: int, max_unlabelled: int):
    """Fits on all rows of presence bits, in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[bool, list[tuple[int, bytes]]] = {True: [], False: []}
        for batch in batches:
            for doc_id, positive, bits in zip(*batch.columns, strict=True):
                rows[positive.as_py()].append((doc_id.as_py(), bits.as_py()))
        if not rows[True]:
            return
        sets = []
        for kind, most in ((True, max_positives), (False, max_unlabelled)):
            # Ids that repeat may bring more rows than were drawn.
            bits = np.frombuffer(b"".join(b for _, b in sorted(rows[kind])[:most]), dtype=np.uint8)
            width = (len(features) + 7) // 8
            packed = bits.reshape(min(len(rows[kind]), most), width)
            sets.append(np.unpackbits(packed, axis=1, count=len(features)).astype(bool))
        model = fit_presence(features, *sets, prior)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x.astype(np.float32).tobytes()], pa.binary()) for x in (model.weights, model.intercepts)],
            ["weights", "intercepts"])

    return run


def _cut(hashes: DataFrame, limit: int) -> int:
    """The ``limit``-th smallest of a column of 64-bit hashes; the largest number if there are fewer."""
    n, share = hashes.count(), 0.0
    if n <= limit:
        return 2**63 - 1
    while True:
        share = min(1.0, max(2 * share, 1.2 * limit / n + 20 / n))
        mark = min(2**63 - 1, int(-(2**63) + share * 2**64))
        # About a fifth more than wanted.
        low = np.sort(hashes.where(F.col("hash") <= mark).toArrow().column("hash").to_numpy())
        if len(low) >= limit:
            return int(low[limit - 1])


def sample_features(docs: DataFrame, training: DataFrame, max_positives: int, max_unlabelled: int) -> DataFrame:
    """Rows (doc_id, positive, features) of the sampled texts, each different one once.

    ``training`` has (doc_id, toxic).  A text that is drawn both as positive and
    as unlabelled is two rows.
    """
    known = docs.where(F.col("doc_id").isNotNull() & (remainder(F.col("doc_id")) != 0)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hashed = known.withColumn("hash", F.xxhash64("doc_id", "text", F.lit("unlabelled")))
    toxic = training.where("toxic = 1").select("doc_id", F.xxhash64("doc_id").alias("hash"))
    toxic = toxic.where(F.col("hash") <= _cut(toxic.select("hash"), max_positives))
    # No more ids than max_positives.
    drawn = hashed.join(F.broadcast(toxic.select("doc_id", F.lit(True).alias("confirmed"))), "doc_id", "left")
    unlabelled = F.col("hash") <= _cut(hashed.select("hash"), max_unlabelled)
    kinds = F.filter(
        F.array(F.when(F.col("confirmed"), True), F.when(unlabelled, False)), lambda kind: kind.isNotNull())
    return cut_lineage(
        drawn.where(F.col("confirmed") | unlabelled).select("doc_id", kinds.alias("kinds"), "text")
        .mapInArrow(_feature_rows, "doc_id long, kinds array<boolean>, features binary")
        .select("doc_id", F.explode("kinds").alias("positive"), "features").distinct()
    )


def choose_features(sample: DataFrame, limit: int = MAX_FEATURES) -> np.ndarray:
    """Features whose share differs most, in standard errors, between the sets; sorted."""
    n_p, n_u = sample.agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()
    n_p, n_u = float(max(1, n_p)), float(max(1, n_u))
    counts = (
        sample.select("positive", "features").mapInArrow(_feature_counts, "feature long, n_p long, n_u long")
        .groupBy("feature").agg(F.sum("n_p").alias("n_p"), F.sum("n_u").alias("n_u"))
        .where(F.col("n_p") + F.col("n_u") >= 3)
    )
    pooled = (F.col("n_p") + F.col("n_u")) / (n_p + n_u)
    error = F.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u) + 1e-12)
    z = F.abs(F.col("n_p") / n_p - F.col("n_u") / n_u) / error
    best = counts.withColumn("z", z).where(F.col("z") > LEAST_Z).orderBy(F.desc("z"), "feature").limit(limit)
    return np.sort(best.select("feature").toArrow().column("feature").to_numpy().astype(np.uint32))


def learn(docs: DataFrame, labels: DataFrame, max_positives: int = MAX_POSITIVES,
          max_unlabelled: int = MAX_UNLABELLED) -> Classifier | None:
    """Fits the classifiers; None without a confirmed toxic text to learn from."""
    training = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (remainder(F.col("doc_id")) != 0))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    )
    n, n_toxic = training.agg(F.count("*"), F.count_if(F.col("toxic") == 1)).first()
    if not n_toxic:
        return None
    prior = min(max(n_toxic / n, 1e-4), 0.5)
    sample = sample_features(docs, training, max_positives, max_unlabelled)
    features = choose_features(sample)
    fitted = (
        sample.mapInArrow(_presence_rows(features), "doc_id long, positive boolean, bits binary").repartition(1)
        .mapInArrow(_fitter(features, prior, max_positives, max_unlabelled), "weights binary, intercepts binary").first()
    )
    if fitted is None:
        return None
    weights = np.frombuffer(fitted["weights"], dtype=np.float32).reshape(len(features), MEMBERS)
    return Classifier(features, weights, np.frombuffer(fitted["intercepts"], dtype=np.float32))


def _scorer(model: Classifier | None):
    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        index = {} if model is None else {int(f): i for i, f in enumerate(model.features)}
        for batch in batches:
            rows, out = batch.column("row"), []
            for text in rows.field(rows.type.get_field_index("text")):
                if model is None:
                    out.append(0.0)
                    continue
                present: set[int] = set()
                for word in text_words(text.as_py()):
                    hits = known.get(word)
                    if hits is None:
                        if len(known) >= _CACHE_WORDS:
                            known.clear()
                        hits = known[word] = tuple(index[f] for f in word_features(word) if f in index)
                    if hits:
                        present.update(hits)
                out.append(model.score(np.array(sorted(present), dtype=np.int64)))
            yield pa.RecordBatch.from_arrays([rows, pa.array(out, pa.float64())], ["row", "score"])

    return scores


def score_texts(docs: DataFrame, model: Classifier | None) -> DataFrame:
    """``row``, a struct of all columns of ``docs``, with its ``score``."""
    rows = docs.withColumn("text", F.col("text").cast("string")).select(F.struct("*").alias("row"))
    return rows.mapInArrow(_scorer(model), f"row {rows.dtypes[0][1]}, score double")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = score_texts(docs.select("doc_id", "text"), learn(docs, labels))
    return scored.select(
        "row.doc_id", (remainder(F.col("row.doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def remove_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    return score_texts(docs, learn(docs, labels)).where("score < 0.5").select("row.*")
