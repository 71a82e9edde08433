"""Near-duplicate documents by SetSketch registers.

1. Every text becomes its set of five-word shingles, a sketch of it and band
   keys.  Texts with the same set are one class from here on, with the smallest
   id as its member, however many copies there are.
2. Members that share a band key fall into a bucket.  Each is paired with the
   smallest member of the bucket only, never with all.  Pairs whose likelihood
   estimate is plausible are verified on the full sets.
3. Verified links give components.  A bucket whose members lie in more than one
   component still holds pairs that were not looked at.  Those outside its
   largest component are compared, by sketch, with all members of other
   components, and every plausible pair is verified on the full sets, unless a
   link found before has joined its components.  A pair that shares several
   buckets is verified in the one with the smallest key.  Only links leave the
   task; pairs that are refused do not.  No partner is given up.

Bands of four registers, forty of them: a pair at the threshold shares a band
with probability 1 - 2.5e-7.  The estimate's margin is five standard errors.

Defined results: an empty set (null, empty or blank text) is linked with
nothing; equal sets are linked; rows that repeat a doc_id are one document with
the links of all of its texts; a null doc_id is linked with nothing and kept,
its component null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.components import connected_components
from clientele.llm.setsketch import (
    REGISTERS, band_keys, equal_registers, mixed, reaches, registers, shingles, unpacked,
)
from clientele.operators.dimension import small_side
from clientele.sources.files import cut_lineage

PERCENT = 75
# Five standard errors of an estimate from all registers, at the threshold.
MARGIN = 5 * (0.75 * 0.25 / REGISTERS) ** 0.5
PLAUSIBLE = PERCENT / 100 - MARGIN
# Registers that agree in any plausible pair; sketches below it skip the estimate.
LEAST_EQUAL = int(0.8 * PLAUSIBLE * REGISTERS)
BLOCK_MEMBERS = 8192
# Bucket members that small buckets bring to one task, and pairs of sketches looked
# at together.  A task has one block that asks and one that answers at most beside.
_GROUP_MEMBERS = 4096
_COMPARED = 40_000
# Shingles of the sets that a task verifies among each other at a time, on either side.
_HELD_SHINGLES = 4_000_000
# Tasks that the comparisons are dealt out to, at most.
_MOST_TASKS = 1_000
_SKETCH = "doc_id long, n_shingles long, high long, low long, registers binary"
_PLACED = ["dealt", "unit", "bucket", "member", "component", "n_shingles", "registers"]
_PLACED_SCHEMA = "dealt long, unit long, bucket long, member long, component long, n_shingles long, registers binary"


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, high, low, packed = [], [], [], []
        for text in batch.column("text"):
            elements = shingles(text.as_py())
            sizes.append(len(elements))
            # Two independent sums over the set name it by 128 bits.
            high.append(int(elements.sum(dtype=np.uint64).view(np.int64)) if len(elements) else 0)
            low.append(int(mixed(elements ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64)) if len(elements) else 0)
            packed.append(registers(elements).tobytes() if len(elements) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()),
             pa.array(low, pa.int64()), pa.array(packed, pa.binary())],
            ["doc_id", "n_shingles", "high", "low", "registers"])


def sketch_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a 128-bit name of the set, and registers."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_sketched, _SKETCH)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = batch.column("registers")
        keys = band_keys(unpacked(p.as_py() for p in packed)) if len(packed) else np.empty((0, 0), dtype=np.int64)
        member = np.repeat(batch.column("member").to_numpy(), keys.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(member)], ["bucket", "member"])


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sides = [unpacked(x.as_py() for x in batch.column(c)) for c in ("registers_a", "registers_b")]
        sizes = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
        keep = reaches(*sides, *sizes, PLAUSIBLE)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def linked(first: np.ndarray, second: np.ndarray) -> bool:
    """Whether two sets of sorted hashes are similar enough."""
    common = len(np.intersect1d(first, second, assume_unique=True))
    return common > 0 and 100 * common >= PERCENT * (len(first) + len(second) - common)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: tuple[str | None, np.ndarray] = (None, np.empty(0, np.uint64))
    for batch in batches:
        found = []
        for first, second in zip(batch.column("text_a"), batch.column("text_b"), strict=True):
            other = second.as_py()
            if other != last[0]:  # partners of one hub follow each other
                last = (other, shingles(other))
            found.append(linked(shingles(first.as_py()), last[1]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(found, pa.bool_())], ["a", "b", "linked"])


def verify(pairs: DataFrame, members: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, linked) for the pairs (a, b) that the sketches find plausible."""
    def side(name):
        return members.select(F.col("member").alias(name), F.col("registers").alias(f"registers_{name}"),
                              F.col("n_shingles").alias(f"n_{name}"))

    def text(name):
        return texts.select(F.col("member").alias(name), F.col("text").alias(f"text_{name}"))

    plausible = pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_plausible, "a long, b long")
    compared = plausible.join(text("a"), "a").join(text("b"), "b").mapInArrow(_linked, "a long, b long, linked boolean")
    return compared.groupBy("a", "b").agg(F.max("linked").alias("linked"))


def shared_buckets(members: DataFrame) -> DataFrame:
    """(bucket, member, pivot, n) of the buckets with several members.

    Of buckets with the same members only one is kept.
    """
    keyed = members.mapInArrow(_keyed, "bucket long, member long")
    shared = keyed.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("member").alias("pivot"),
        F.bit_xor(F.xxhash64("member")).alias("h"), F.bit_xor(F.xxhash64("member", F.lit(1))).alias("g"),
    ).where("n > 1")
    kept = shared.groupBy("n", "pivot", "h", "g").agg(F.min("bucket").alias("bucket"))
    return keyed.join(kept.select("bucket", "pivot", "n"), "bucket")


class _Links:
    """Links found by one task between members of different components."""

    def __init__(self):
        self.root: dict[int, int] = {}
        self.found: list[tuple[int, int]] = []

    def component(self, label: int) -> int:
        while (above := self.root.get(label, label)) != label:
            self.root[label] = self.root.get(above, above)
            label = above
        return label

    def components(self, labels: np.ndarray) -> np.ndarray:
        if not self.root or not len(labels):
            return labels
        different, at = np.unique(labels, return_inverse=True)
        return np.array([self.component(int(label)) for label in different], dtype=np.int64)[at]

    def try_pairs(self, sets: _Sets, x: np.ndarray, of_x: np.ndarray, y: np.ndarray, of_y: np.ndarray) -> None:
        """Verifies pairs on their full sets, unless they are in one component by now."""
        order = np.argsort(x, kind="stable")
        x, of_x, y, of_y = x[order], of_x[order], y[order], of_y[order]
        edges = np.flatnonzero(np.diff(x, prepend=x[:1] - 1, append=x[-1:] + 1))
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            apart = np.flatnonzero(self.components(of_x[start:start + 1]) != self.components(of_y[start:end])) + start
            for at in apart[sets.linked(int(x[start]), y[apart])]:
                left, right = self.component(int(of_x[at])), self.component(int(of_y[at]))
                if left != right:
                    self.root[max(left, right)] = min(left, right)
                    self.found.append((max(int(x[at]), int(y[at])), min(int(x[at]), int(y[at]))))


class _Sets:
    """The sets of some members, as numbers of those shingles that several of the sets have."""

    def __init__(self, texts: dict[int, list[str]], members: np.ndarray):
        own = [(int(m), shingles(t)) for m in members for t in texts[int(m)]]
        every, times = np.unique(np.concatenate([s for _, s in own]), return_counts=True)
        several = every[times > 1]
        self.marks = np.zeros(len(several) + 1, dtype=np.uint8)
        self.sizes = np.array([len(s) for _, s in own], dtype=np.int64)
        self.shared: list[np.ndarray] = []
        self.of: dict[int, list[int]] = {}
        for number, (member, elements) in enumerate(own):
            at = np.searchsorted(several, elements)
            known = at < len(several)
            known[known] = several[at[known]] == elements[known]
            self.shared.append(at[known].astype(np.int32))
            self.of.setdefault(member, []).append(number)
        self.n_shared = np.array([len(s) for s in self.shared], dtype=np.int64)
        self.single = len(self.of) == len(own)

    def linked(self, x: int, ys: np.ndarray) -> np.ndarray:
        """Whether a member has a set that is similar enough to one of each other member."""
        found = np.zeros(len(ys), dtype=bool)
        if not len(ys):
            return found
        numbers = [self.of[int(y)] for y in ys]
        theirs = np.array([n for several in numbers for n in several], dtype=np.int64)
        of_pair = np.arange(len(ys)) if self.single else np.repeat(np.arange(len(ys)), [len(n) for n in numbers])
        for mine in self.of[x]:
            # No pair has more in common than what either set shares with any other.
            most = np.minimum(self.n_shared[mine], self.n_shared[theirs])
            possible = np.flatnonzero((most > 0) & self._similar(mine, theirs, most))
            if not len(possible):
                continue
            others = theirs[possible]
            self.marks[self.shared[mine]] = 1
            starts = np.concatenate([[0], np.cumsum(self.n_shared[others])[:-1]])
            common = np.add.reduceat(self.marks[np.concatenate([self.shared[n] for n in others])], starts, dtype=np.int64)
            self.marks[self.shared[mine]] = 0
            found[of_pair[possible[self._similar(mine, others, common)]]] = True
        return found

    def _similar(self, mine: int, theirs: np.ndarray, common: np.ndarray) -> np.ndarray:
        return 100 * common >= PERCENT * (self.sizes[mine] + self.sizes[theirs] - common)


def _pairs(asking: pd.DataFrame, answering: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of both sides that make plausible pairs between components, bucket by bucket.

    A pair comes in the bucket with the smallest of the keys that both have.  That
    one is never left out as a bucket of the same members as another: those hold the
    pair as well, and the one that is kept has the smallest key.
    """
    if not len(asking) or not len(answering):
        return
    (regs_a, n_a, comp_a), (regs_b, n_b, comp_b) = (
        (unpacked(rows["registers"]), rows["n_shingles"].to_numpy(), rows["component"].to_numpy())
        for rows in (asking, answering))
    bucket = asking["bucket"].to_numpy()
    keys_a, keys_b = band_keys(regs_a), band_keys(regs_b)
    units_b = answering.groupby("unit", sort=False).indices
    for unit, a in asking.groupby("unit", sort=False).indices.items():
        b = units_b.get(unit, a[:0])
        step = max(1, _COMPARED // max(1, len(b)))
        for start in range(0, len(a), step):
            part = a[start:start + step]
            equal = equal_registers(regs_a[part], regs_b[b])
            x, y = np.nonzero((equal >= LEAST_EQUAL) & (comp_a[part][:, None] != comp_b[b][None, :]))
            x, y = part[x], b[y]
            if not len(x):
                continue
            before = ((keys_a[x] == keys_b[y]) & (keys_a[x] < bucket[a[0]])).any(axis=1)
            x, y = x[~before], y[~before]
            good = reaches(regs_a[x], regs_b[y], n_a[x], n_b[y], PLAUSIBLE)
            if good.any():
                yield x[good], y[good]


def _in_pairs(asking: pd.DataFrame, answering: pd.DataFrame) -> pd.DataFrame:
    """The rows of both sides that are in a plausible pair."""
    answering = answering.rename(columns=lambda c: c.removesuffix("2"))
    of_a, of_b = np.zeros(len(asking), dtype=bool), np.zeros(len(answering), dtype=bool)
    for x, y in _pairs(asking, answering):
        of_a[x], of_b[y] = True, True
    return pd.concat([asking[of_a].assign(asks=True), answering[of_b].assign(asks=False)])


def _cross(asking: pd.DataFrame, answering: pd.DataFrame) -> pd.DataFrame:
    """Links between components among the members of some buckets, bucket by bucket."""
    answering = answering.rename(columns=lambda c: c.removesuffix("2"))
    has_text = answering["text"].notna()
    texts = answering["text"][has_text].groupby(answering["member"][has_text]).agg(list).to_dict()
    answering = answering[~has_text]
    links = _Links()
    for a in _held(asking):
        for b in _held(answering):
            sets = None
            id_a, comp_a, id_b, comp_b = (rows[c].to_numpy() for rows in (a, b) for c in ("member", "component"))
            for x, y in _pairs(a, b):
                sets = sets or _Sets(texts, np.union1d(id_a, id_b))
                links.try_pairs(sets, id_a[x], comp_a[x], id_b[y], comp_b[y])
    return pd.DataFrame(links.found, columns=["a", "b"], dtype="int64")


def _held(rows: pd.DataFrame) -> list[pd.DataFrame]:
    """``rows`` in parts whose members have ``_HELD_SHINGLES`` shingles, or one member more."""
    sizes = rows.groupby("member")["n_shingles"].max()
    part = (sizes.cumsum() - sizes) // _HELD_SHINGLES
    return [some for _, some in rows.groupby(rows["member"].map(part))]


def dealt_sides(buckets: DataFrame, members: DataFrame, labels: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Asking and answering members of the buckets that have several components.

    Both have the task (dealt) and the part of a bucket (unit) they are compared
    in.  Members outside the largest component ask, in blocks of their own, and
    all answer; every block that asks meets every block that answers, once.
    """
    labelled = (
        buckets.where("n > 2").select("bucket", "member")
        .join(labels.withColumnRenamed("node", "member"), "member", "left")
        .withColumn("component", F.coalesce("component", "member"))
    )
    parts = labelled.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    most = F.max(F.struct("n", "component"))
    divided = cut_lineage(
        parts.groupBy("bucket").agg(
            most["component"].alias("largest"), F.sum("n").alias("n"), (F.sum("n") - most["n"]).alias("m"))
        .where("m > 0")
        .withColumn("asking", F.ceil(F.col("m") / block).cast("int"))
        .withColumn("answering", F.ceil(F.col("n") / block).cast("int"))
        .withColumn("size", F.ceil(F.col("m") / F.col("asking")) + F.ceil(F.col("n") / F.col("answering")))
        .withColumn("alone", F.col("size") >= _GROUP_MEMBERS)
    )
    # Large units are tasks of their own.  Small ones around one component meet in
    # a task, as many tasks as their rows need.
    small = divided.where("not alone").withColumn("size", F.expr("size * asking * answering"))
    around = small.groupBy("largest").agg(F.ceil(F.sum("size") / _GROUP_MEMBERS).alias("shares"))
    in_small, large = divided.agg(
        F.sum(F.when(~F.col("alone"), F.expr("size * asking * answering"))),
        F.sum(F.when(F.col("alone"), F.expr("asking * answering")))).first()
    groups = max(1, -(-(in_small or 0) // _GROUP_MEMBERS))
    tasks = int(min(groups + (large or 0), _MOST_TASKS))
    rows = (
        labelled.join(divided.join(around, "largest", "left"), "bucket")
        .join(members.select("member", "n_shingles", "registers"), "member")
    )

    def side(placed: DataFrame, own: str, other: str) -> DataFrame:
        blocks = {"i": "asking", "j": "answering"}
        unit = F.xxhash64("bucket", "i", "j")
        share = F.xxhash64("largest", F.pmod(unit, F.col("shares")))
        return (
            placed.withColumn(own, F.pmod(F.xxhash64("member"), F.col(blocks[own])).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(blocks[other]) - 1)))
            .withColumn("unit", unit)
            .withColumn("dealt", F.when(F.col("alone"), unit).otherwise(F.pmod(share, F.lit(groups))))
            .select(*_PLACED).repartition(tasks, "dealt")
        )

    return side(rows.where("component != largest"), "i", "j"), side(rows, "j", "i")


def links_across(buckets: DataFrame, members: DataFrame, texts: DataFrame, labels: DataFrame, block: int) -> DataFrame:
    """Links (a, b) that join the components of members sharing a bucket.

    Every plausible pair between components that shares a bucket is verified,
    unless links found before have joined its components.
    """
    def second(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(c).alias(f"{c}2") for c in _PLACED])

    asking, answering = dealt_sides(buckets, members, labels, block)
    # Sketches alone tell which members are in a plausible pair.  Only these come
    # to the second comparison, and only they take their texts along.
    paired = cut_lineage(
        asking.groupBy("dealt").cogroup(second(answering).groupBy("dealt2"))
        .applyInPandas(_in_pairs, f"{_PLACED_SCHEMA}, asks boolean"))
    # Texts come once per task, on rows of their own.  Their other columns are zero,
    # not null, which would turn whole columns of 64-bit numbers into floats.
    zero = F.lit(0).cast("long")
    tasks = min(max(1, paired.select("dealt").distinct().count()), _MOST_TASKS)
    with_text = paired.select("dealt", "member").distinct().join(texts, "member").select(
        F.col("dealt").alias("dealt2"), zero.alias("unit2"), zero.alias("bucket2"), F.col("member").alias("member2"),
        zero.alias("component2"), zero.alias("n_shingles2"), F.lit(b"").alias("registers2"), F.col("text").alias("text2"))
    answers = second(paired.where("not asks")).withColumn("text2", F.lit(None).cast("string"))
    return (
        paired.where("asks").select(*_PLACED).repartition(tasks, "dealt").groupBy("dealt")
        .cogroup(answers.unionByName(with_text).repartition(tasks, "dealt2").groupBy("dealt2"))
        .applyInPandas(_cross, "a long, b long").distinct()
    )


def near_duplicates(docs: DataFrame, block: int = BLOCK_MEMBERS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    sketches = cut_lineage(sketch_documents(docs))
    usable = sketches.where("n_shingles > 0 and doc_id is not null")
    name = ["high", "low", "n_shingles"]
    members = cut_lineage(
        usable.groupBy(*name).agg(F.min("doc_id").alias("member"), F.first("registers").alias("registers")))
    buckets = cut_lineage(shared_buckets(members))
    colliding = buckets.select("member").distinct()
    wanted = small_side(colliding.withColumnRenamed("member", "doc_id"))
    texts = cut_lineage(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(wanted, "doc_id").select(F.col("doc_id").alias("member"), "text").distinct()
    )
    of_document = usable.join(members.drop("registers"), name).select("doc_id", "member")
    same_id = cut_lineage(_same_id_edges(of_document))
    members = cut_lineage(members.join(colliding, "member"))
    stars = buckets.where("member != pivot").select(F.col("member").alias("a"), F.col("pivot").alias("b")).distinct()
    links = verify(stars, members, texts).where("linked").select("a", "b").union(same_id)
    links = cut_lineage(links)
    labels = connected_components(links)
    across = links_across(buckets, members, texts, labels, block)
    # Components stand for their members from here on: only the new links are gone through again.
    merged = connected_components(_between(across, labels)).select(
        F.col("node").alias("component"), F.col("component").alias("whole"))
    component = (
        of_document.join(labels.withColumnRenamed("node", "member"), "member", "left")
        .select("doc_id", F.coalesce("component", "member").alias("component")).distinct()
        .join(merged, "component", "left")
        .select("doc_id", F.coalesce("whole", "component").alias("component_id")).distinct()
    )
    return (
        sketches.select("doc_id", "n_shingles").join(component, "doc_id", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .select("doc_id", "n_shingles", "component_id",
                F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )


def _between(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The components (a, b) that links join; members without a label are their own."""
    for end in ("a", "b"):
        of_end = labels.select(F.col("node").alias(end), F.col("component").alias("label"))
        links = links.join(of_end, end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    return links.select("a", "b").distinct()


def _same_id_edges(of_document: DataFrame) -> DataFrame:
    """Links between the classes of texts that share a doc_id."""
    several = of_document.groupBy("doc_id").agg(
        F.min("member").alias("b"), F.max("member").alias("most")).where("b < most")
    return several.join(of_document, "doc_id").where("member > b").select(F.col("member").alias("a"), "b").distinct()


def keep_one(docs: DataFrame) -> DataFrame:
    """The kept documents with all their columns, repeated rows once."""
    names = docs.columns
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["kept_id"]), "left_semi")
    # Of rows that share id and text the first by their other columns, whatever order they come in.
    others = F.to_json(F.struct(*[c for c in names if c not in ("doc_id", "text")], F.lit(0).alias("_")))
    return (
        rows.groupBy(F.col("doc_id").alias("kept_id"), F.md5("text").alias("kept_text"))
        .agg(F.min_by(F.struct(*names), others).alias("one")).select("one.*")
    )
