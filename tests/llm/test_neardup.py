import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clientele.llm import components, neardup, setsketch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    ids = sorted({i for i, _ in rows if i is not None})
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (a, s) in enumerate(sets):
        for b, t in sets[:n]:
            if None not in (a, b) and s and t and find(a) != find(b) and 100 * len(s & t) >= 75 * len(s | t):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted((str(i), len(s), str(None if i is None else find(i)), i is None or find(i) == i) for i, s in sets)


def variants(seed, n_families=12):
    rng = random.Random(seed)
    rows, vocabulary = [], [f"w{i}" for i in range(2000)]
    for _ in range(n_families):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 40, 150]))]
        rows.append(" ".join(base))
        for _ in range(rng.randrange(0, 14)):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 20)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.2:
                base = copy  # chains: links that reach the first only through others
            rows.append(" ".join(copy).upper() if rng.random() < 0.3 else "  ".join(copy))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("seed", "block"), [(1, 8192), (2, 3)])
def test_against_brute_force(documents, seed, block):
    rows = variants(seed)
    out = neardup.near_duplicates(documents(rows), block=block).collect()
    assert sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in out) == brute(rows)


@pytest.mark.parametrize("block", [8192, 3])
def test_links_across_components(spark, documents, block):
    """With every member a component of its own, all links come from the buckets."""
    rows = variants(4)
    docs = documents(rows)
    usable = neardup.sketch_documents(docs).where("n_shingles > 0")
    members = usable.groupBy("high", "low", "n_shingles").agg(
        F.min("doc_id").alias("member"), F.first("registers").alias("registers")).cache()
    buckets = neardup.shared_buckets(members).withColumn("n", F.lit(3)).cache()
    texts = docs.select(F.col("doc_id").alias("member"), "text")
    none = spark.createDataFrame([], "node long, component long")
    links = neardup.links_across(buckets, members, texts, none, block)
    ids = {r["member"] for r in members.collect()}
    expected = {i: int(c) for i, _, c, _ in brute([r for r in rows if r[0] in ids])}
    found = {r["node"]: r["component"] for r in components.connected_components(links).collect()}
    assert {str(i): found.get(i, i) for i in ids} == expected
    assert len(found) > 20


@pytest.mark.parametrize("group", [1, 8])
def test_links_across_several_tasks(monkeypatch, spark, documents, group):
    """The blocks of a bucket are compared in different tasks."""
    monkeypatch.setattr(neardup, "_GROUP_MEMBERS", group)
    test_links_across_components(spark, documents, 3)


@pytest.mark.parametrize("strays", [1, 70])
def test_tasks_do_not_grow_with_a_bucket(monkeypatch, spark, strays):
    monkeypatch.setattr(neardup, "_GROUP_MEMBERS", 40)
    block, n = 50, 2000
    members = spark.range(n).select(
        F.col("id").alias("member"), F.lit(9).cast("long").alias("n_shingles"), F.lit(bytes(320)).alias("registers"))
    buckets = members.select(F.lit(1).cast("long").alias("bucket"), "member", F.lit(n).alias("n"))
    labels = spark.range(strays, n).select(F.col("id").alias("node"), F.lit(strays).cast("long").alias("component"))
    sides = neardup.dealt_sides(buckets, members, labels, block)
    blocks = -(-strays // block), n // block
    for side, copies, of in zip(sides, reversed(blocks), (strays, n), strict=True):
        tasks = side.groupBy("dealt").count().collect()
        assert sum(r["count"] for r in tasks) == of * copies
        assert max(r["count"] for r in tasks) <= 2 * block
    asked, answered = ({tuple(r) for r in side.select("unit", "member").collect()} for side in sides)
    by_unit = {}
    for unit, member in answered:
        by_unit.setdefault(unit, set()).add(member)
    met = [(x, y) for unit, x in asked for y in by_unit.get(unit, ())]
    assert len(met) == len(set(met)) == strays * n


def test_odd_documents(odd_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    out = neardup.near_duplicates(odd_documents).collect()
    assert sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in out) == brute(rows)
    kept = neardup.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "7", "None", "None"]


def test_one_id_with_several_texts(documents):
    rng = random.Random(9)
    a, b, c = (" ".join(rng.choice("abcdefgh") * 2 for _ in range(30)) for _ in range(3))
    rows = [(1, a), (2, b), (5, a), (5, b), (5, c), (9, c)]
    out = neardup.near_duplicates(documents(rows)).collect()
    assert {r["component_id"] for r in out} == {1}


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, i) for i in range(101, 160)]
    loose = [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(300, 300)]
    edges = chain + star + loose
    root = {x: x for e in edges for x in e}
    for _ in root:
        for x, y in edges:
            low = min(root[x], root[y])
            root[x] = root[y] = low
    got = dict(map(tuple, components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {k: v for k, v in root.items() if k != 300}


def test_estimate_and_merge():
    rng = np.random.default_rng(3)
    for wanted in (0.3, 0.6, 0.75, 0.9):
        guesses = []
        for _ in range(60):
            n = 400
            common = round(2 * n * wanted / (1 + wanted))
            pool = rng.integers(0, 2**63, 2 * n - common, dtype=np.uint64)
            a, b = pool[:n], pool[n - common:]
            ra, rb = setsketch.registers(a), setsketch.registers(b)
            assert (np.maximum(ra, rb) == setsketch.registers(pool)).all()
            guesses.append(setsketch.estimate_rows(ra[None], rb[None], np.array([n]), np.array([n]))[0])
        assert abs(np.mean(guesses) - wanted) < 0.02
        assert np.std(guesses) < 0.05


def test_kept_row_does_not_depend_on_the_order(spark):
    """Rows that share id and text and differ elsewhere: the same one every time."""
    text = "one two three four five six seven eight"
    rows = [(i % 3, text if i % 3 else f"{text} {i % 2}", f"lang{i % 5}", f"s{i % 4}", i) for i in range(60)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    one = neardup.keep_one(spark.createDataFrame(rows, schema).repartition(2)).collect()
    other = neardup.keep_one(spark.createDataFrame(rows[::-1], schema).repartition(7)).collect()
    assert sorted(one) == sorted(other) and len({(r["doc_id"], r["text"]) for r in one}) == len(one)


def _family(n, seed=8, size=200):
    """Copies of one text that differ by some words, most of them too far from each other for a link."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(size)]
    copies = []
    for i in range(n):
        copy = list(base)
        for _ in range(rng.randrange(0, 14)):
            copy[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
        copies.append((i, " ".join(copy)))
    return copies


def _rows(copies):
    """Members of all buckets that several of them share, each a component of its own."""
    regs = np.stack([setsketch.registers(setsketch.shingles(t)) for _, t in copies])
    keys = setsketch.band_keys(regs)
    rows = [(int(k), i) for i, _ in copies for k in keys[i] if (keys == k).sum() > 1]
    return regs, pd.DataFrame({
        "unit": [k for k, _ in rows], "bucket": [k for k, _ in rows], "member": [i for _, i in rows],
        "component": [i for _, i in rows], "n_shingles": [len(setsketch.shingles(copies[i][1])) for _, i in rows],
        "registers": [regs[i].tobytes() for _, i in rows]})


def test_pairs_come_in_one_bucket():
    """However many buckets a pair shares, it is compared on its full sets in one."""
    copies = _family(60)
    regs, rows = _rows(copies)
    ids = rows["member"].to_numpy()
    met = [(int(ids[i]), int(ids[j])) for x, y in neardup._pairs(rows, rows) for i, j in zip(x, y, strict=True)]
    keys = setsketch.band_keys(regs)
    sizes = np.array([len(setsketch.shingles(t)) for _, t in copies])
    expected = {
        (i, j) for i in range(60) for j in range(60) if i != j and (keys[i] == keys[j]).any()
        and setsketch.estimate_rows(regs[[i]], regs[[j]], sizes[[i]], sizes[[j]])[0] >= neardup.PLAUSIBLE}
    assert len(met) == len(set(met)) and set(met) == expected and len(met) > 500


@pytest.mark.parametrize("held", [4_000_000, 1500])
def test_linked_as_whole_sets(monkeypatch, held):
    """Links of a family, its sets held in one part and in several, are those of plain set arithmetic."""
    monkeypatch.setattr(neardup, "_HELD_SHINGLES", held)
    copies = _family(60)
    _, rows = _rows(copies)
    texts = pd.DataFrame({"member": [i for i, _ in copies] + [7], "text": [t for _, t in copies] + ["a b c d e f"]})
    none = texts.assign(unit=0, bucket=0, component=0, n_shingles=0, registers=b"")
    found = neardup._cross(rows, pd.concat([rows.assign(text=None), none]))
    root = {i: i for i, _ in copies}
    for _ in copies:
        for a, b in found.itertuples(index=False):
            root[a] = root[b] = min(root[a], root[b])
    assert [str(root[i]) for i, _ in copies] == [c for _, c in sorted((int(i), c) for i, _, c, _ in brute(copies))]
    assert 1 < len(set(root.values())) < 60
    sets = neardup._Sets(texts.groupby("member")["text"].agg(list).to_dict(), np.arange(60))
    whole = [setsketch.shingles(t) for _, t in copies]
    for x in range(0, 60, 7):
        others = np.delete(np.arange(60), x)
        assert sets.linked(x, others).tolist() == [neardup.linked(whole[x], whole[y]) for y in others]


def test_registers_of_sets_one_after_another():
    """The room that sets share holds nothing of the set before."""
    rng = np.random.default_rng(6)
    many, few = (np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1300, 7))
    alone = setsketch.registers(few)
    union = setsketch.registers(many)
    assert (setsketch.registers(few) == alone).all()
    assert (np.maximum(setsketch.registers(many[:700]), setsketch.registers(many[700:])) == union).all()
