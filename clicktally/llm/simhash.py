"""SimHash near duplicates, with candidates found by pigeonring filtering.

The 64 bits of a fingerprint are ``max_distance + 1`` segments on a ring. Two fingerprints that
differ in at most ``max_distance`` bits have a segment from which every chain of consecutive segments
stays within its share of the budget: the first is equal, the first two differ in at most one bit, the
first three in two, and so on round the ring. Candidates meet on a chain of two segments, or of
``chain``: a fingerprint is stored under the bits of the chain, for every start, and once more for every
choice of zero bits within the budgets with these set. Two fingerprints that stay within the budgets meet
under the bits that either of them has. Candidates then go through the longer chains before the full
distance.

A key of two segments has about 26 bits, a fingerprint some 38 of them. One of three has 39 bits, and a
fingerprint some 370: more to shuffle, but at far more than 10^8 different fingerprints less to compare.
Keys that are crowded all the same are left for the chains longer by one segment that begin with them,
under which everything linked meets again.

Only different fingerprints are compared; the documents of one fingerprint are a class from the
start. Within a key links are found by spreading from pivots over the members not yet reached,
so that a key of many near copies gives one link for each member and not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktally.llm.chunks import blocks
from clicktally.llm.components import connected_components
from clicktally.llm.expressions import let
from clicktally.session import fresh_path

BITS = 64
SHINGLE_WORDS = 4
MAX_DISTANCE = 4
CHAIN = 2
LONGEST_CHAIN = 3
SEED = 42

# Parts over which the fingerprints of one component are spread.
SALTS = 16

# Keys of at most so many members are compared by shifting, larger ones from pivots.
SMALL_RUN = 24

# Keys of about so many members go on to longer chains. They are told by one fingerprint in so many,
# chosen by hash; that decides the way of a key only, and every fingerprint takes part in each.
CROWDED = 16_384
ONE_IN = 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The SimHash of the word shingles of a text, repeats included; without words zero."""
    import xxhash

    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    line = memoryview(b" ".join(parts))
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    width = min(words, len(parts))
    starts = (ends - sizes)[: len(parts) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(line[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)],
        "<u8",
    )
    counts = np.zeros(BITS, np.int64)
    for first in range(0, len(hashes), 8192):
        rows = hashes[first : first + 8192].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``row``, a number of its own for every row, ``fp`` as a signed long, and ``doc``, the row."""
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("fp", T.LongType()),
            T.StructField("doc", docs.schema),
        ]
    )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for block in blocks(batch, "doc"):
                texts = block.column("doc").field("text").to_pylist()
                prints = [fingerprint(text, words) for text in texts]
                rows = np.arange(row, row + len(prints))
                row += len(prints)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows),
                        pa.array(np.array(prints, np.uint64).view(np.int64)),
                        block.column("doc"),
                    ],
                    ["row", "fp", "doc"],
                )

    return docs.select(F.struct("*").alias("doc")).mapInArrow(add, schema)


class Ring:
    """The segments of a fingerprint and the budgets of their chains."""

    def __init__(self, max_distance: int, chain: int = CHAIN):
        self.budget = max_distance
        self.count = max_distance + 1
        self.chain = chain
        edges = [BITS * i // self.count for i in range(self.count + 1)]
        self.offsets, self.widths = edges[:-1], np.diff(edges).tolist()
        self.wide = max(self.widths)
        fits = chain * self.wide + self.count.bit_length() <= 63
        if not 2 <= chain <= min(self.count, LONGEST_CHAIN) or not fits:
            raise ValueError(f"no keys of {chain} segments for a distance of {max_distance} bits")

    def longer(self) -> Ring | None:
        """The same ring with keys of one segment more, if there are such.

        Four segments would have some 6,000 choices of zeros for each start.
        """
        try:
            return Ring(self.budget, self.chain + 1)
        except ValueError:
            return None

    def _zeros(self, start: int) -> list[int]:
        """Bits of a key that may be set together if they are zero: none, and all within the budgets."""
        chosen = [(0, 0)]
        for place in range(self.chain):
            budget = (place + 1) * self.budget // self.count
            width = self.widths[(start + place) % self.count]
            low = (self.chain - 1 - place) * self.wide
            chosen = [
                (bits | sum(1 << low + bit for bit in more), used + len(more))
                for bits, used in chosen
                for number in range(budget - used + 1)
                for more in combinations(range(width), number)
            ]
        return [bits for bits, _ in chosen]

    def keys(self, fp: Column) -> Column:
        """The keys of a fingerprint: for every start one for each choice of zeros to set."""

        def of_start(start: int) -> Column:
            key = F.lit(start).cast("long")
            for place in range(self.chain):
                at = (start + place) % self.count
                part = F.shiftrightunsigned(fp, self.offsets[at])
                part = part.bitwiseAND(F.lit(2 ** self.widths[at] - 1))
                key = F.shiftleft(key, self.wide).bitwiseOR(part)
            zeros = F.array(*(F.lit(bits).cast("long") for bits in self._zeros(start)))

            def keys_of(key: Column) -> Column:
                free = F.filter(zeros, lambda bits: key.bitwiseAND(bits) == 0)
                return F.transform(free, lambda bits: key.bitwiseOR(bits))

            return let(key, keys_of)

        return F.flatten(F.array(*(of_start(start) for start in range(self.count))))

    def shorter_key(self, key: Column) -> Column:
        """The key of one segment less that a key begins with."""
        return F.shiftright(key, self.wide)

    def start_of(self, keys: np.ndarray) -> np.ndarray:
        return keys >> (self.chain * self.wide)

    def linked(self, a: np.ndarray, b: np.ndarray, start: int) -> np.ndarray:
        """Whether pairs keep to the budget of every chain from a start, and of the whole ring."""
        differing = a ^ b
        within = np.ones(len(differing), bool)
        total = np.zeros(len(differing), np.int64)
        for length in range(1, self.count + 1):
            segment = (start + length - 1) % self.count
            mask = np.uint64((2 ** self.widths[segment] - 1) << self.offsets[segment])
            total += np.bitwise_count(differing & mask)
            within &= total <= length * self.budget // self.count
        return within & (total <= self.budget)

    def links(self, keys: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links that connect what is linked under each key; equal keys lie side by side."""
        bounds = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1, append=keys[-1:] + 1))
        sizes = np.diff(bounds)
        size_of = np.repeat(sizes, sizes)
        small = (size_of > 1) & (size_of <= SMALL_RUN)
        k, p = keys[small], prints[small]
        starts = self.start_of(k)
        for shift in range(1, SMALL_RUN):
            same = np.flatnonzero(k[shift:] == k[:-shift])
            if not len(same):
                break
            for start in range(self.count):
                at = same[starts[same] == start]
                hit = at[self.linked(p[at], p[at + shift], start)]
                yield p[hit], p[hit + shift]
        for run in np.flatnonzero(sizes > SMALL_RUN).tolist():
            members = np.unique(prints[bounds[run] : bounds[run + 1]])
            yield from self._spread(members, int(self.start_of(keys[bounds[run]])))

    def _spread(self, members: np.ndarray, start: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        waiting: list = []
        while len(members):
            if not waiting:
                waiting, members = [members[:1]], members[1:]
            batch = waiting.pop()
            for place, pivot in enumerate(batch):
                near = self.linked(np.full(len(members), pivot), members, start)
                if near.any():
                    found = members[near]
                    yield np.full(len(found), pivot), found
                    members = members[~near]
                    waiting.append(found)
                if not len(members):
                    return


def _links(keyed: DataFrame, ring: Ring) -> DataFrame:
    """Links ``a``, ``b`` that connect what is linked under each ``key``."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def links(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a, b in ring.links(keys, prints):
                for first in range(0, len(a), 65_536):
                    part = slice(first, first + 65_536)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a[part].view(np.int64)), pa.array(b[part].view(np.int64))],
                        ["a", "b"],
                    )

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            more = batch.column("key").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)
            held.append(more)
            if held[0][0][0] == more[0][-1]:
                continue
            keys, prints = (np.concatenate(part) for part in zip(*held, strict=True))
            cut = np.searchsorted(keys, keys[-1])
            yield from links(keys[:cut], prints[:cut])
            held = [(keys[cut:], prints[cut:])]
        if held:
            yield from links(*(np.concatenate(part) for part in zip(*held, strict=True)))

    # By a hash of its own: after a join on the key, dealing by the key itself would be optimized out, and
    # adaptive execution may still undo the dealing of the join, so that one key lies in several tasks.
    dealt = keyed.repartition(F.xxhash64("key")).sortWithinPartitions("key")
    return dealt.mapInArrow(find, "a long, b long")


def _crowded(keyed: DataFrame) -> DataFrame:
    """Keys of many members, by the count of some of them."""
    some = keyed.filter(F.pmod(F.xxhash64("fp"), F.lit(ONE_IN)) == 0)
    return some.groupBy("key").count().filter(F.col("count") > CROWDED // ONE_IN).select("key")


def fingerprint_links(
    prints: DataFrame, max_distance: int = MAX_DISTANCE, chain: int = CHAIN
) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints ``fp`` within the distance of each other.

    Members of a crowded key are dealt again by the longer chains that begin with it, so that a template of
    many near copies is no single task's work. The longest chains are not divided further.
    """
    ring = Ring(max_distance, chain)
    keyed = prints.select(F.explode(ring.keys(F.col("fp"))).alias("key"), "fp")
    found = []
    while (longer := ring.longer()) is not None:
        crowded = _crowded(keyed).checkpoint()
        if crowded.isEmpty():
            break
        found.append(_links(keyed.join(crowded, "key", "left_anti"), ring))
        of_key = F.filter(longer.keys(F.col("fp")), lambda key: longer.shorter_key(key) == F.col("key"))
        members = keyed.join(crowded, "key", "left_semi")
        keyed, ring = members.select(F.explode(of_key).alias("key"), "fp"), longer
    return reduce(DataFrame.unionByName, [*found, _links(keyed, ring)])


def near_duplicates(
    prints: DataFrame, max_distance: int = MAX_DISTANCE, chain: int = CHAIN
) -> DataFrame:
    """``component_id`` and ``first_row`` added to rows with ``row``, ``doc_id`` and ``fp``.

    The component is the smallest ``doc_id`` reachable over links, null where no row of it has one;
    ``first_row`` is the row that stands for it, the one of the smallest id and then number.
    """
    classes = prints.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
    ).checkpoint()
    links = fingerprint_links(classes, max_distance, chain)
    roots = connected_components(links, "a", "b")
    linked = roots.select(F.col("node").alias("fp"), "root").unionByName(
        roots.select(F.col("root").alias("fp"), "root").distinct()
    )
    salt = F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int")
    members = classes.join(linked, "fp", "left").withColumn("salt", salt)
    # A component may have any number of fingerprints: they collapse before the shuffle here, and
    # are spread over the copies of its first row below.
    firsts = (
        members.filter(F.col("root").isNotNull())
        .groupBy("root")
        .agg(F.min("first").alias("first_of_all"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        # The copies look small when compressed, and would be sent to every task.
        .hint("merge")
    )
    labels = (
        members.withColumn("root", F.coalesce("root", "fp"))
        .join(firsts, ["root", "salt"], "left")
        .withColumn("first", F.coalesce("first_of_all", "first"))
        .select(
            "fp", F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("first_row")
        )
    )
    return prints.join(labels, "fp")


def near_duplicate_classes(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
    chain: int = CHAIN,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` for every row of ``doc_id`` and ``text``.

    A null text has no words, and texts without words have the fingerprint zero and are linked like
    any other. Repeated rows give one row each; other columns are left out.
    """
    prints = with_fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), words)
    prints = prints.select("row", "doc.doc_id", "fp").checkpoint()
    return near_duplicates(prints, max_distance, chain).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
    chain: int = CHAIN,
) -> DataFrame:
    """The rows of documents that stand for their component, with all their columns.

    The documents are stored once with their fingerprints, so that each row has a lasting number.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "fingerprints")
    with_fingerprints(docs, words).write.parquet(path)
    stored = spark.read.parquet(path)
    prints = stored.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), "fp")
    kept = near_duplicates(prints, max_distance, chain).filter(F.col("row") == F.col("first_row"))
    return stored.join(kept.select("row"), "row", "left_semi").select("doc.*")
