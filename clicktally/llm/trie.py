"""The prefix trie of conversations: which turns they share from the start, and what that saves.

A turn is known by a key of ``STRIDE`` bytes: a digest of its role and text, and the length of its text. The
path of a conversation is the bytes of its turns one after the other, so paths in the order of their bytes
have the members of every node side by side, those that end at a node first.

Paths are dealt into shards by ranges of that order; equal paths are dealt by id, so that many copies of one
conversation are no single shard. A node whose members lie in several shards is a prefix of the path on
both sides of a border, that is, a node of the skeleton: the trie of the splitters, the borders' common
prefixes. All other nodes are finished by their shard, in one pass over its sorted paths with a stack of the
nodes of the current path. For the nodes of the skeleton on its borders, a shard gives partial aggregates, all
of which add up: each turn, child and leaf is counted by one shard only. They are then reduced by node.

What every task gets is the shape of the skeleton: of each border the depth, and how deep it agrees with
the border before, two numbers a shard. From it a task tells the same name for a node as all others do:
the first border that has the node, and its depth.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktally.session import fresh_path

DIGEST = 16
STRIDE = DIGEST + 4

# Turns of one shard, on average: a task holds the nodes of a shard, about a hundred bytes each.
SHARD_TURNS = 400_000

# Nodes in an Arrow batch, and ids in one row of the ends of a node of the skeleton.
BATCH = 50_000
ENDS = 10_000

# Families of conversations and the shared beginnings of the rebuilding that ``rebuilt_paths`` does.
FAMILY = 5
LONGEST_HEAD = 8

NODE = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in (
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
        )
    ]
    + [T.StructField("ends_sha256", T.StringType())]
    # The place in the skeleton: of the node itself if it is part of it, or else of its parent, if that is.
    + [
        T.StructField("border", T.LongType()),
        T.StructField("parent_border", T.LongType()),
        T.StructField("shard", T.LongType()),
        T.StructField("part", T.LongType()),
        T.StructField("ends", T.BinaryType()),
    ]
)


def turn_key(role: F.Column, text: F.Column) -> F.Column:
    """The key of a turn: a digest of role and text, then the length of the text in bytes."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))

    def length(value: F.Column) -> F.Column:
        return F.unhex(F.lpad(F.hex(F.octet_length(value)), 8, "0"))

    whole = F.concat(length(role), role.cast("binary"), text.cast("binary"))
    return F.concat(F.substring(F.unhex(F.sha2(whole, 256)), 1, DIGEST), length(text))


def conversation_paths(turns: DataFrame, shards: int) -> DataFrame:
    """``conv_id`` and ``path`` of every conversation, its turns in order.

    Turns are ordered by ``turn``, null first, then by role and text. Rows are sorted by range over all
    tasks, so that the texts of one conversation may lie in several; only keys are put together, and they are
    stored, so that texts are sorted once. The path of one conversation, 20 bytes a turn, is one value.
    """
    schema = T.StructType(
        [
            T.StructField("conv_id", T.LongType()),
            T.StructField("task", T.LongType()),
            T.StructField("keys", T.BinaryType()),
        ]
    )

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()

        def rows(done: list[tuple[int, bytes]]) -> pa.RecordBatch:
            ids, keys = [conv for conv, _ in done], [path for _, path in done]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([task] * len(done), pa.int64()), pa.array(keys, pa.binary())],
                ["conv_id", "task", "keys"],
            )

        current, held, done = None, [], []
        for batch in batches:
            for conv, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if conv != current:
                    if held:
                        done.append((current, b"".join(held)))
                    current, held = conv, []
                held.append(key)
            if done:
                yield rows(done)
                done = []
        if held:
            yield rows([(current, b"".join(held))])

    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    store = fresh_path(turns.sparkSession, "turn-keys")
    (
        turns.filter("conv_id IS NOT NULL")
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartitionByRange(shards, *order)
        .sortWithinPartitions(*order)
        .select("conv_id", turn_key(F.col("role"), F.col("text")).alias("key"))
        .mapInArrow(together, schema)
        .write.parquet(store)
    )
    pieces = turns.sparkSession.read.parquet(store)
    whole = F.array_sort(F.collect_list(F.struct("task", "keys")))
    joined = F.aggregate(whole, F.lit(b""), lambda path, piece: F.concat(path, piece["keys"]))
    return (
        pieces.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY)
        .repartition(shards, "family")
        .groupBy("family", "conv_id")
        .agg(joined.alias("path"))
    )


def rebuilt_paths(turns: DataFrame, shards: int) -> DataFrame:
    """Paths of conversations rebuilt to share beginnings with the first one of their family of five.

    Conversation ``c`` takes the first ``h`` turns of ``c - c % 5``, ``h`` being the checksum of ``c`` by 9,
    and then its own turns after its first ``h``.
    """
    own = conversation_paths(turns, shards)
    heads = own.filter("conv_id = family").select(
        "family", F.substring("path", 1, LONGEST_HEAD * STRIDE).alias("head")
    )
    size = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (LONGEST_HEAD + 1) * STRIDE).cast("int")
    head = F.coalesce(F.col("head"), F.lit(b"")).substr(F.lit(1), size)
    tail = F.col("path").substr(size + 1, F.octet_length("path"))
    return own.join(heads, "family", "left").select("conv_id", F.concat(head, tail).alias("path"))


def agreement(a: bytes, b: bytes) -> int:
    """How many turns two paths share from the start."""
    low, high = 0, min(len(a), len(b)) // STRIDE
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * STRIDE] == b[: middle * STRIDE]:
            low = middle
        else:
            high = middle - 1
    return low


@dataclass(frozen=True)
class Skeleton:
    """The shape of the trie of the splitters.

    ``shards`` are the shards that hold paths, in order; border ``i`` lies after the ``i``-th. ``depths`` are
    the turns that the paths on both sides of each border share, ``joined`` how many of them the border
    before has too.
    """

    shards: tuple[int, ...]
    depths: tuple[int, ...]
    joined: tuple[int, ...]

    def names(self, border: int) -> list[int]:
        """For each depth of a border's common prefix the first border that has this node."""
        found, first = [], border
        for depth in range(self.depths[border], -1, -1):
            while first > 0 and self.joined[first] >= depth:
                first -= 1
            found.append(first)
        return found[::-1]


@dataclass
class _Open:
    """A node of the current path: what its members in this shard add up to so far."""

    size: int
    first: bool
    conv_id: int | None = None
    n_convs: int = 0
    n_children: int = 0
    n_leaves: int = 0
    saved: int = 0
    extended: bool = False
    ends: array = field(default_factory=lambda: array("q"))
    children: array = field(default_factory=lambda: array("q"))


def written_ids(ids: Iterable[int]) -> bytes:
    return ",".join(map(str, ids)).encode()


class Shard:
    """One pass over the sorted paths of a shard.

    ``left`` and ``right`` name the skeleton's nodes on its borders by depth. Rows are kept until their
    parent is closed, since the smallest member of a node is known only then.
    """

    def __init__(self, number: int, left: list[int], right: list[int]):
        self.number, self.left, self.right = number, left, right
        self.stack = [_Open(0, True)]
        self.path: bytes | None = None
        self.rows: list[tuple | None] = []
        self.free: list[tuple] = []

    def add(self, conv_id: int, path: bytes) -> None:
        if path != self.path:
            shared = agreement(path, self.path) if self.path is not None else 0
            while len(self.stack) - 1 > shared:
                self._close(False)
            for start in range(shared * STRIDE, len(path), STRIDE):
                self.stack[-1].extended = True
                size = int.from_bytes(path[start + DIGEST : start + STRIDE])
                self.stack.append(_Open(size, self.path is None))
            self.path = path
        node = self.stack[-1]
        node.n_convs += 1
        node.conv_id = conv_id if node.conv_id is None else min(node.conv_id, conv_id)
        node.ends.append(conv_id)

    def finish(self) -> None:
        while self.stack and self.path is not None:
            self._close(True)

    def _close(self, at_end: bool) -> None:
        depth = len(self.stack) - 1
        node = self.stack.pop()
        begun_before = node.first and depth < len(self.left)
        goes_on = at_end and depth < len(self.right)
        node.saved += node.n_convs * node.size - (0 if begun_before else node.size)
        node.n_leaves += not goes_on and not node.extended
        names = self.left if begun_before else self.right if goes_on else None
        parent = self.stack[-1] if self.stack else None
        if parent is not None:
            parent.n_convs += node.n_convs
            parent.conv_id = node.conv_id if parent.conv_id is None else min(parent.conv_id, node.conv_id)
            parent.n_children += not begun_before
            parent.n_leaves += node.n_leaves
            parent.saved += node.saved
        border = names[depth] if names else None
        for child in node.children:
            row = self.rows[child]
            self.rows[child] = None
            self.free.append(row[:2] + (None if names else node.conv_id,) + row[3:9] + (border,) + row[10:])
        measures = (node.n_convs, node.n_children, node.n_leaves, node.saved)
        digest = None if names else hashlib.sha256(written_ids(node.ends)).hexdigest()
        row = (node.conv_id, depth, None, *measures, digest, border, None, self.number, 0, None)
        if names:
            above = names[depth - 1] if depth else None
            self.free.append(row[:9] + (above,) + row[10:])
            for part, start in enumerate(range(0, len(node.ends), ENDS)):
                ids = written_ids(node.ends[start : start + ENDS])
                self.free.append((None, depth, *[None] * 6, border, above, self.number, part, ids))
        elif parent is None:
            self.free.append(row)
        else:
            parent.children.append(len(self.rows))
            self.rows.append(row)
        if not self.stack:
            self.rows = []

    def taken(self) -> list[tuple]:
        rows, self.free = self.free, []
        return rows


def _shard_nodes(sorted_paths: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Finished nodes, partial aggregates of the skeleton's nodes and the ids that end at these."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(NODE)

    def batches_of(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(rows), BATCH):
            columns = list(zip(*rows[start : start + BATCH], strict=True))
            arrays = [pa.array(column, kind.type) for column, kind in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {number: i for i, number in enumerate(skeleton.shards)}
        current, shard = None, None
        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(3))
            for number, conv_id, path in zip(*columns, strict=True):
                if number != current:
                    if shard is not None:
                        shard.finish()
                        yield from batches_of(shard.taken())
                    i = place[number]
                    left = skeleton.names(i - 1) if i > 0 else []
                    right = skeleton.names(i) if i < len(skeleton.depths) else []
                    current, shard = number, Shard(number, left, right)
                shard.add(conv_id, path)
            if shard is not None and len(shard.free) >= BATCH:
                yield from batches_of(shard.taken())
        if shard is not None:
            shard.finish()
            yield from batches_of(shard.taken())

    return sorted_paths.mapInArrow(grow, NODE)


def _skeleton(spark: SparkSession, paths: DataFrame) -> Skeleton:
    """The skeleton of stored shards; the driver sees a few numbers of each shard."""
    ends = paths.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    store = fresh_path(spark, "shard-ends")
    ends.write.parquet(store)
    ends = spark.read.parquet(store)
    shards = sorted(row.shard for row in ends.select("shard").collect())
    after = spark.createDataFrame(list(zip(shards, shards[1:])), "shard long, next long")
    following = ends.select(F.col("shard").alias("next"), F.col("first").alias("next_first"))
    pairs = ends.join(after, "shard", "left").join(following, "next", "left")
    schema = "shard long, within long, border long"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (row["shard"], agreement(row["first"], row["last"]), agreement(row["last"], row["next_first"] or b""))
                for row in batch.to_pylist()
            ]
            columns = zip(*rows, strict=True) if rows else [[]] * 3
            arrays = [pa.array(column, pa.int64()) for column in columns]
            yield pa.RecordBatch.from_arrays(arrays, ["shard", "within", "border"])

    found = {row.shard: row for row in pairs.mapInArrow(compare, schema).collect()}
    depths = [found[number].border for number in shards[:-1]]
    joined = [0] + [
        min(depths[i - 1], depths[i], found[shards[i]].within) for i in range(1, len(depths))
    ]
    return Skeleton(tuple(shards), tuple(depths), tuple(joined))


def _ends_digests(ends: DataFrame) -> DataFrame:
    """The digest of the ids that end at each node of the skeleton, read in order and never held."""
    schema = "border long, depth long, ends_sha256 string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(node: tuple[int, int], digest) -> pa.RecordBatch:
            border, depth = node
            arrays = [pa.array([border], pa.int64()), pa.array([depth], pa.int64()), pa.array([digest.hexdigest()])]
            return pa.RecordBatch.from_arrays(arrays, ["border", "depth", "ends_sha256"])

        current, digest = None, None
        for batch in batches:
            for border, depth, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (border, depth) != current:
                    if current is not None:
                        yield row(current, digest)
                    current, digest = (border, depth), hashlib.sha256(ids)
                else:
                    digest.update(b"," + ids)
        if current is not None:
            yield row(current, digest)

    return (
        ends.repartition("border", "depth")
        .sortWithinPartitions("border", "depth", "shard", "part")
        .select("border", "depth", "ends")
        .mapInArrow(read, schema)
    )


def prefix_trie(paths: DataFrame, shards: int) -> DataFrame:
    """Every node of the trie of ``paths`` (``conv_id``, ``path``; ids are unique).

    A node has the smallest of its members as ``conv_id``, its ``depth``, the ``conv_id`` of its parent (null for
    the root), the number of members, children and childless nodes below it or itself, ``saved_tokens`` (over
    itself and all below it the bytes of the last text, once for each member but one), and the digest of the
    ids that end at it. No paths give no nodes, a conversation without turns is a member of the root.
    """
    spark = paths.sparkSession
    order = ["path", "conv_id"]
    store = fresh_path(spark, "paths")
    paths.repartitionByRange(shards, *order).withColumn(
        "shard", F.spark_partition_id().cast("long")
    ).write.parquet(store)
    paths = spark.read.parquet(store)
    skeleton = _skeleton(spark, paths)
    sorted_paths = (
        paths.repartition(shards, "shard")
        .sortWithinPartitions("shard", *order)
        .select("shard", "conv_id", "path")
    )
    store = fresh_path(spark, "trie")
    _shard_nodes(sorted_paths, skeleton).write.parquet(store)
    nodes = spark.read.parquet(store)

    finished = nodes.filter("border IS NULL")
    partial = nodes.filter("border IS NOT NULL AND ends IS NULL")
    common = (
        partial.groupBy("border", "depth")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.first("parent_border").alias("parent_border"),
            *(F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        )
        .join(_ends_digests(nodes.filter("ends IS NOT NULL")), ["border", "depth"], "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)))
    )
    store = fresh_path(spark, "skeleton")
    common.write.parquet(store)
    common = spark.read.parquet(store)
    parents = common.select(
        F.col("border").alias("parent_border"),
        (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("skeleton_conv_id"),
    )
    # A shard knows of its parents in the skeleton under its own number, so that the children of the root
    # are as many keys as there are shards.
    seen = partial.select("shard", F.col("border").alias("parent_border"), (F.col("depth") + 1).alias("depth"))
    of_shards = seen.join(parents, ["parent_border", "depth"])
    columns = NODE.names[:8]
    below = (
        finished.filter("parent_border IS NOT NULL")
        .join(of_shards, ["shard", "parent_border", "depth"])
        .withColumn("parent_conv_id", F.col("skeleton_conv_id"))
    )
    top = common.join(parents, ["parent_border", "depth"], "left").withColumn(
        "parent_conv_id", F.col("skeleton_conv_id")
    )
    return (
        finished.filter("parent_border IS NULL")
        .select(columns)
        .unionByName(below.select(columns))
        .unionByName(top.select(columns))
    )


def shard_count(turns: DataFrame) -> int:
    """Enough shards that each holds a bounded number of turns, but no fewer than shuffle partitions."""
    least = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-turns.count() // SHARD_TURNS))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of conversations as they are: ``conv_id``, ``turn``, ``role`` and ``text``.

    Null roles and texts are empty ones; rows without ``conv_id`` belong to no conversation. Equal rows are
    turns of their own, as are turns of one number, which are ordered by role and text.
    """
    shards = shard_count(turns)
    return prefix_trie(conversation_paths(turns, shards).select("conv_id", "path"), shards)


def rebuilt_trie(turns: DataFrame) -> DataFrame:
    """The trie of conversations rebuilt to share beginnings, see ``rebuilt_paths``; else as above."""
    shards = shard_count(turns)
    return prefix_trie(rebuilt_paths(turns, shards), shards)
