import random
import zlib

from clientele.llm import sharding


def test_longest_first():
    placed = sharding.longest_first([(7, "a"), (5, "b"), (4, "c"), (4, "d"), (3, "e")], 2)
    assert placed == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}


def check(docs, shards):
    out = sharding.assign_shards(docs, shards).collect()
    assert len(out) == docs.count()
    by_shard = {}
    for r in out:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert set(by_shard) <= set(range(shards))
    return out


def test_even_bytes_and_whole_groups(documents):
    rng = random.Random(1)
    texts = ["x" * rng.randrange(1, 2000) + str(i % 4000) for i in range(6000)]
    texts += ["same text " * 20] * 700 + ["é" * 30000]
    out = check(documents(list(enumerate(texts))), 24)
    loads, homes = [0] * 24, {}
    for r in out:
        text = texts[r["doc_id"]]
        assert r["size"] == len(text.encode()) + 8 and r["text_crc32"] == zlib.crc32(text.encode())
        loads[r["shard"]] += r["size"]
        homes.setdefault(text, set()).add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())
    assert max(loads) - min(loads) <= 0.01 * sum(loads) / 24


def test_odd_documents(odd_documents):
    out = check(odd_documents, 3)
    assert sorted(r["size"] for r in out)[:2] == [8, 8]
