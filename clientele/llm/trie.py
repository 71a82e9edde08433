"""Prefix trie of conversations by union-find over sorted neighbours.

Conversations are sequences of turns; a turn is told by the MD5 of its role and
text.  Equal sequences become one row, and the rows are range-partitioned and
sorted by their turns.  Two neighbours that share a prefix of d turns (their
LCP) have all nodes down to depth d in common, so the trie of a partition comes
from its LCP edges, taken from the deepest to the shallowest: every union of two
components makes, or widens, the branching node at the depth of the edge, and
the turns between a component and the node above it are a chain of nodes with
one child.

Nodes that are no prefix of the first or last sequence of their partition are
complete.  The others, two spines at most, are the partition's contracted
forest: each says what is complete below it.  Equal nodes of different
partitions (by the hash of their prefix) are merged, sums over subtrees are
carried up the spines by the partition in which a node appears first, and the
merged values go back to the children that wait for them, by partition and
depth, so that no node of many children becomes a hot key.

Nothing is gathered but the conversations of a node that end there, and those by
blocks of 4,096 ids, which the task that sorts them hashes as a stream.

Defined results: conversations are ordered by turn, null first, then by the MD5
of the turn; null roles and texts are empty; rows without a conv_id take no
part; a conversation without turns is a member of the root; conv_ids that repeat
a sequence are members each; an empty table has no nodes.  A conversation is one
Spark value (24 bytes a turn, 2 GB at most).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientele.sources.files import cut_lineage, scratch_dir

# Ids of one sequence that are put into one value.
BLOCK_BITS = 12
# Turns of a partition, at most, for partitions of equal sequences apart.
PARTITION_TURNS = 400_000
_NODES_EACH = 20_000

SEQUENCE = "array<struct<name:binary,size:bigint>>"
# Complete nodes, nodes waiting for their parent, and nodes of the spines.
DONE, WAITING, OPEN = 0, 1, 2
_NODE = (
    "kind int, partition int, spine int, path binary, above binary, above_depth long, conv_id long, depth long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, size long, ends binary"
)
_SCHEMA = pa.schema([
    (name, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[kind])
    for name, kind in (c.split() for c in _NODE.split(", "))
])
_EMPTY = hashlib.sha256(b"").digest()


def sequences(turns: DataFrame) -> DataFrame:
    """One row (conv_id, turns) per conversation, from rows (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # The length of the role tells where it ends.
    name = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    listed = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), name.alias("name"), F.length(text).cast("long").alias("size")).alias("turn"))
    sequence = F.sort_array(F.collect_list("turn"))
    return listed.groupBy("conv_id").agg(
        F.transform(sequence, lambda t: F.struct(t["name"], t["size"])).alias("turns"))


def forked(conversations: DataFrame, base: Column, shared: Column, most: int) -> DataFrame:
    """Every conversation with its first ``shared`` turns taken from conversation ``base``.

    Columns conv_id and turns; ``shared`` is ``most`` at the largest.  A missing
    base has no turns.
    """
    asked = conversations.select("conv_id", "turns", base.alias("base"), shared.cast("int").alias("shared"))
    heads = conversations.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    none = F.array().cast(SEQUENCE)
    head = F.coalesce(F.slice("head", F.lit(1), F.col("shared")), none)
    own = F.when(
        F.size("turns") > F.col("shared"),
        F.slice("turns", F.col("shared") + 1, F.size("turns")),
    ).otherwise(none)
    return asked.join(heads, "base", "left").select("conv_id", F.concat(head, own).alias("turns"))


class _Sequence:
    """A different sequence of a partition with the conversations that have it."""

    __slots__ = ("names", "sizes", "first", "n", "digest")

    def __init__(self, names: list[bytes], sizes: list[int]):
        self.names, self.sizes = names, sizes
        self.first, self.n, self.digest = None, 0, hashlib.sha256()

    def add(self, first: int, n: int, ids: str) -> None:
        self.digest.update((("," if self.n else "") + ids).encode())
        self.first = first if self.first is None else min(self.first, first)
        self.n += n


def _shared(a: list[bytes], b: list[bytes]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


class _Forest:
    """Components of a partition's sequences, each the subtree below its top node.

    ``top`` is the depth of the top node, ``row`` a sequence through it, ``ends``
    the sequence that ends in it, and ``children`` the components just below.
    """

    def __init__(self, rows: list[_Sequence]):
        # A component starts as the node in which its sequence ends.
        self.above = list(range(len(rows)))
        self.top = [len(r.names) for r in rows]
        self.row = list(range(len(rows)))
        self.ends: list[int | None] = list(range(len(rows)))
        self.children: list[list[int]] = [[] for _ in rows]

    def find(self, node: int) -> int:
        while self.above[node] != node:
            self.above[node] = self.above[self.above[node]]
            node = self.above[node]
        return node

    def union(self, left: int, right: int, depth: int) -> None:
        """Joins the components of two neighbours below the node at ``depth``, the turns that they share."""
        left, right = self.find(left), self.find(right)
        # A sequence sorts before its continuations, so the right top lies deeper.
        if self.top[left] != depth:
            node = len(self.above)
            self.above.append(node)
            self.top.append(depth)
            self.row.append(self.row[left])
            self.ends.append(None)
            self.children.append([left])
            self.above[left] = left = node
        self.children[left].append(right)
        self.above[right] = left


def _partition_nodes(partition: int, rows: list[_Sequence]) -> Iterator[tuple]:
    """All nodes of a partition's sequences, in the columns of ``_NODE``."""
    shared = [_shared(a.names, b.names) for a, b in zip(rows, rows[1:])]
    forest = _Forest(rows)
    # Equal depths from the left: what stands on the right is one child.
    for edge in sorted(range(len(shared)), key=lambda e: -shared[e]):
        forest.union(edge, edge + 1, shared[edge])

    # Turns that every sequence shares with the first and with the last one.
    with_first, with_last = [len(rows[0].names)], [len(rows[-1].names)]
    for n in shared:
        with_first.append(min(with_first[-1], n))
    for n in reversed(shared):
        with_last.append(min(with_last[-1], n))
    with_last.reverse()
    common = with_first[-1]
    paths = []
    for row in (rows[0], rows[-1]):
        path = [b""]
        for name in row.names:
            path.append(hashlib.md5(path[-1] + name).digest())
        paths.append(path)

    def spine(node: int, depth: int) -> int | None:
        """0 for prefixes of the first and the last sequence, 1 and 2 for those of one; None for complete nodes."""
        row = forest.row[node]
        if depth <= with_first[row]:
            return 0 if depth <= common else 1
        return (0 if depth <= common else 2) if depth <= with_last[row] else None

    def settled(made: tuple, spine_above: int | None, depth_above: int, smallest: int) -> tuple:
        """A complete node below a node of a spine, or below a complete node."""
        conv_id, depth, *values = made
        if spine_above is None:
            return (DONE, partition, None, None, None, None, conv_id, depth, smallest, *values)
        return (WAITING, partition, spine_above, None, None, depth_above, conv_id, depth, None, *values)

    # Children before their parents.
    order, stack = [], [(forest.find(0), -1)]
    while stack:
        node, bottom = stack.pop()
        order.append((node, bottom))
        stack += [(child, forest.top[node]) for child in forest.children[node]]
    values: dict[int, tuple[int, int, int, int]] = {}
    lowest: dict[int, tuple] = {}  # complete nodes just below their parent's component
    for node, bottom in reversed(order):
        top, children = forest.top[node], forest.children[node]
        ends = None if forest.ends[node] is None else rows[forest.ends[node]]
        below = [values.pop(child) for child in children]
        n = sum(b[0] for b in below) + (ends.n if ends else 0)
        smallest = min([b[1] for b in below] + ([ends.first] if ends else []))
        leaves, saved = sum(b[2] for b in below), sum(b[3] for b in below)
        complete = [lowest.pop(child) for child in children if child in lowest]
        on = spine(node, top)
        for made in complete:
            yield settled(made, on, top, smallest)
        # Children on a spine are counted when the spines are merged.
        n_children = len(complete)
        if not children and on is None:
            leaves = 1
        digest = ends.digest.digest() if ends else None
        for depth in range(top, bottom, -1):
            size = rows[forest.row[node]].sizes[depth - 1] if depth else 0
            on = spine(node, depth)
            if on is not None:
                # One of several partial nodes, perhaps: its own size is taken off once they are one.
                saved += n * size
                path = paths[on == 2]
                yield (OPEN, partition, on, path[depth], path[depth - 1] if depth else None, None, smallest, depth, None,
                       n, n_children, leaves, saved, size, digest)
                n_children = 0
            else:
                saved += (n - 1) * size
                made = (smallest, depth, n, n_children, leaves, saved, None, digest or _EMPTY)
                if depth - 1 > bottom:
                    yield settled(made, spine(node, depth - 1), depth - 1, smallest)
                else:
                    lowest[node] = made
                n_children = 1
            digest = None
        values[node] = (n, smallest, leaves, saved)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a sorted partition of (names, sizes, first, n, ids)."""
    rows: list[_Sequence] = []
    for batch in batches:
        columns = [batch.column(c) for c in ("names", "sizes", "first", "n", "ids")]
        for names, sizes, first, n, ids in zip(*columns, strict=True):
            names = names.as_py()
            if not rows or rows[-1].names != names:
                rows.append(_Sequence(names, sizes.as_py()))
            rows[-1].add(first.as_py(), n.as_py(), ids.as_py())
    held = []
    for node in _partition_nodes(TaskContext.get().partitionId(), rows) if rows else ():
        held.append(node)
        if len(held) == _NODES_EACH:
            yield _batch(held)
            held = []
    yield _batch(held)


def _batch(nodes: list[tuple]) -> pa.RecordBatch:
    columns = zip(*nodes) if nodes else [()] * len(_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def _merged(opened: DataFrame) -> DataFrame:
    """One row per node of the spines: path, above and the columns of the result but the parent."""
    partial = opened.groupBy("path").agg(
        F.first("above").alias("above"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("complete"), F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved"), F.max("ends").alias("ends"), F.min("partition").alias("owner"),
    )
    children = partial.where(F.col("above").isNotNull()).groupBy(F.col("above").alias("path")).agg(F.count("*").alias("opened"))
    counted = partial.join(children, "path", "left").withColumn(
        "n_children", F.col("complete") + F.coalesce(F.col("opened"), F.lit(0)))
    # Each node counts itself once, in the first partition that has it, for all that are above it there.
    own = opened.select("path", "partition", "spine", "depth", "size").join(
        counted.select("path", "owner", (F.col("n_children") == 0).cast("long").alias("leaf")), "path")
    is_own = F.col("partition") == F.col("owner")
    own = own.select(
        "path", "partition", "spine", "depth",
        F.when(is_own, F.col("size")).otherwise(0).alias("size"), F.when(is_own, F.col("leaf")).otherwise(0).alias("leaf"))

    def below(column: str) -> Column:
        deeper = Window.orderBy(F.col("depth").desc()).rangeBetween(Window.unboundedPreceding, 0)
        both = F.sum(column).over(deeper.partitionBy("partition"))
        return F.when(F.col("spine") == 0, both).otherwise(F.sum(column).over(deeper.partitionBy("partition", "spine")))

    carried = own.select("path", below("size").alias("size"), below("leaf").alias("leaf")).groupBy("path").agg(
        F.sum("size").alias("own_size"), F.sum("leaf").alias("own_leaves"))
    return counted.join(carried, "path").select(
        "path", "above", "conv_id", "depth", "n_convs", "n_children",
        (F.col("leaves") + F.col("own_leaves")).alias("n_leaves"),
        (F.col("saved") - F.col("own_size")).alias("saved_tokens"), "ends")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """All nodes of the trie of ``conversations`` (conv_id, turns).

    Columns conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256.
    """
    spark = conversations.sparkSession
    folder = scratch_dir(spark, "trie")
    ids = F.sort_array(F.collect_list("conv_id"))
    conversations.select(
        "conv_id", F.shiftright("conv_id", BLOCK_BITS).alias("block"), F.col("turns")["name"].alias("names"),
        F.col("turns")["size"].alias("sizes"),
    ).groupBy("names", "block").agg(
        F.first("sizes").alias("sizes"), F.min("conv_id").alias("first"), F.count("*").alias("n"),
        F.array_join(ids.cast("array<string>"), ",").alias("ids"),
    ).write.parquet(f"{folder}/sequences")
    equal = spark.read.parquet(f"{folder}/sequences")
    turns = equal.agg(F.coalesce(F.sum(F.size("names") + 1), F.lit(0))).first()[0]
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // PARTITION_TURNS + 1)
    (
        equal.repartitionByRange(partitions, "names").sortWithinPartitions("names", "block")
        .select("names", "sizes", "first", "n", "ids").mapInArrow(_nodes, _NODE).write.parquet(f"{folder}/nodes")
    )
    nodes = spark.read.parquet(f"{folder}/nodes")
    opened = nodes.where(F.col("kind") == OPEN)
    merged = cut_lineage(_merged(opened))
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    parents = merged.select(F.col("path").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    done = nodes.where(F.col("kind") == DONE).select(result)
    spines = merged.join(parents, "above", "left").select(result)
    at = opened.select("partition", "spine", F.col("depth").alias("above_depth"), F.col("path").alias("above")).join(
        parents, "above").drop("above")
    waiting = nodes.where(F.col("kind") == WAITING).drop("parent_conv_id").join(
        at, ["partition", "spine", "above_depth"]).select(result)
    hashed = F.lower(F.hex(F.coalesce("ends", F.lit(_EMPTY))))
    return done.unionByName(spines).unionByName(waiting).withColumn("ends_sha256", hashed).drop("ends")
