"""The trie of conversations against a dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest

from clientele.llm import trie
from clientele.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(conversations):
    """Nodes of {conv_id: [(role, text), ...]}."""
    members, ends = {}, {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[c] for c in children.get(node, [])]
        size = len(node[-1][1]) if node else 0
        sums[node] = (
            sum(b[0] for b in below) if below else 1, sum(b[1] for b in below) + (len(members[node]) - 1) * size)
    return sorted(
        (min(members[n]), len(n), min(members[n[:-1]]) if n else -1, len(members[n]), len(children.get(n, [])), *sums[n],
         hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest())
        for n in members)


def nodes(df):
    return sorted(
        (r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"],
         r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in df.collect())


def built(spark, conversations):
    rows = [(c, i, *t) for c, turns in conversations.items() for i, t in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return trie.sequences(spark.createDataFrame(rows, SCHEMA))


@pytest.mark.parametrize("seed", range(4))
def test_against_prefixes(spark, seed):
    rng = random.Random(seed)
    turns = [("user", t) for t in ("", "a", "bb", "ü日")] + [("u", "sera"), ("assistant", "bb")]
    conversations = {
        c: [rng.choice(turns[: 1 + seed * 2]) for _ in range(rng.randrange(1, 7))] for c in rng.sample(range(10_000), 300)}
    assert nodes(trie.prefix_trie(built(spark, conversations).repartition(5))) == brute(conversations)


def test_hot_sequences_and_long_ones(spark):
    """A third of all conversations are alike; one is thousands of turns long, one its beginning."""
    long = [("user", f"{i}") for i in range(3000)]
    conversations = {c: [("user", "hello"), ("assistant", "yes")] for c in range(20_000, 12_000, -1)}
    conversations |= {c: [("user", "hello"), ("assistant", f"{c % 50}"), ("user", f"{c}")] for c in range(900)}
    conversations |= {50_000: long, 50_001: long[:1500], 50_002: long[:1500] + [("user", "x")]}
    assert nodes(trie.prefix_trie(built(spark, conversations))) == brute(conversations)


def test_one_partition_and_one_conversation(spark):
    one = {7: [("user", "a"), ("assistant", "b")]}
    assert nodes(trie.prefix_trie(built(spark, one))) == brute(one)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        some = {c: [("user", "abc"[c % 3])] * (1 + c % 4) for c in range(40)}
        assert nodes(trie.prefix_trie(built(spark, some))) == brute(some)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_odd_turns(spark):
    """Null turns lead, null roles and texts are empty, equal turns go by their digest, null ids take no part."""
    rows = [(1, 2, "user", "b", "x"), (1, None, None, None, "x"), (None, 1, "user", "z", "x"),
            (2, 1, "", "", "x"), (2, 5, "user", "b", "x"), (3, 1, "user", "p", "x"), (3, 1, "user", "q", "x"),
            (4, 1, "user", "q", "x"), (4, 1, "user", "p", "x"), (5, 1, "user", "p", "x"), (5, 1, "user", "p", "x")]
    df = spark.createDataFrame(rows, SCHEMA + ", names string")
    got = nodes(trie.prefix_trie(trie.sequences(df)))
    tied = sorted([("user", "p"), ("user", "q")], key=lambda t: hashlib.md5(f"{len(t[0])}:{t[0]}{t[1]}".encode()).digest())
    assert got == brute({1: [("", ""), ("user", "b")], 2: [("", ""), ("user", "b")], 3: tied, 4: tied, 5: [("user", "p")] * 2})


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    own = {}
    for r in sorted(rows, key=lambda r: (r["turn"] is not None, r["turn"])):
        own.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    assert nodes(QUERIES["op11_prefix_trie"](spark, SF)) == brute(rebuilt)


def test_fork_without_base(spark):
    df = spark.createDataFrame([(150, 0, "user", "a"), (150, 1, "user", "b"), (151, 0, "user", "c")], SCHEMA)
    forked = trie.forked(trie.sequences(df), trie.F.lit(100).cast("long"), trie.F.lit(1), 5)
    assert {r["conv_id"]: [t["size"] for t in r["turns"]] for r in forked.collect()} == {150: [1], 151: []}
    assert nodes(trie.prefix_trie(forked)) == brute({150: [("user", "b")], 151: []})
