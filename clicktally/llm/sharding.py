"""Weighted rendezvous hashing of stable record keys over shards.

Every shard draws a number in (0, 1) for a key from a digest of both, and the key goes to the shard
with the largest ``-weight / ln(number)``. The draws of the old shards do not change when one is
added, so only keys that the new shard wins move, and they move into it.

Everything is an expression of the row; only the place within the shard needs the other rows. The
rows are sorted over all tasks by shard, block (the first digits of the key's digest), id, size and
checksum. Slices of this order are of equal size whatever the ids are, also where one id or one row is
repeated often. The place is that within a slice plus the rows of the slices before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hexadecimal digits of a draw and of a block: 13 are the 52 bits that a double holds exactly.
DRAW_DIGITS = 13
BLOCK_DIGITS = 3

# Lower bits of a monotonically increasing id, which count the rows of a partition.
PLACE_BITS = 33


def draw(key: Column, shard: int) -> Column:
    """A number strictly between 0 and 1 for a key text and a shard."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"#{shard}"))), 1, DRAW_DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**DRAW_DIGITS)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key; a null key counts as the empty text, equal scores go to the first shard."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")
    text = F.coalesce(key.cast("string"), F.lit(""))
    scores = [
        F.struct((-weight / F.log(draw(text, shard))).alias("score"), F.lit(-shard).alias("place"))
        for shard, weight in enumerate(weights)
    ]
    return -(F.greatest(*scores)["place"] if len(scores) > 1 else scores[0]["place"])


def assign_shards(
    docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None
) -> DataFrame:
    """Add ``shard``, ``slot`` and ``grown_shard`` to ``doc_id`` and ``text``, with ``size``.

    ``size`` is the bytes of the text in UTF-8, none for null, plus one. ``slot`` counts the rows of a
    shard from 0 without gaps. ``grown_shard`` is the shard under the weights of a grown
    set, by default one more shard of the last weight. Rows of one id go to one shard, a null id
    like an empty one; repeated rows get a slot each. Other columns are left out.
    """
    grown = [*weights, weights[-1]] if grown is None else grown
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        rendezvous(F.col("doc_id"), weights).cast("int").alias("shard"),
        rendezvous(F.col("doc_id"), grown).cast("int").alias("grown_shard"),
        F.substring(F.md5(key), 1, BLOCK_DIGITS).alias("block"),
    )
    order = ["shard", "block", "doc_id", "size", "text_crc32"]
    # The place in the source only splits equal rows, which may take each other's slots.
    placed = (
        rows.withColumn("source", F.monotonically_increasing_id())
        .repartitionByRange(*order, "source")
        .sortWithinPartitions(*order)
        .drop("source")
        .withColumn("at", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("slice", F.shiftright("at", PLACE_BITS).cast("int"))
        .withColumn("place", F.col("at").bitwiseAND(F.lit(2**PLACE_BITS - 1)))
    )
    # One row for each slice and one more for each shard that begins inside one.
    slices = placed.groupBy("shard", "slice").agg(
        F.count("*").alias("rows"), F.min("place").alias("first")
    )
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        "shard", "slice", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("offset")
    )
    return placed.join(F.broadcast(offsets), ["shard", "slice"]).select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("offset") + F.col("place")).alias("slot"),
        "grown_shard",
    )


def shard_sql(shards: int) -> str:
    """The same columns in DuckDB, for shards of equal weight."""

    def shard(count: int) -> str:
        scores = ", ".join(
            f"{{'score': -1 / ln((('0x' || substr(md5(k || '#{s}'), 1, {DRAW_DIGITS}))::BIGINT"
            f" + 0.5) / {float(16**DRAW_DIGITS)!r}::DOUBLE), 'place': {-s}}}"
            for s in range(count)
        )
        return f"-list_max([{scores}]).place"

    step = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
    entry = reduce(
        lambda inner, _: f"list_transform({inner}, lambda v: {step.format('v')})",
        range(8),
        "range(0::BIGINT, 256::BIGINT)",
    )
    return f"""
    WITH crc AS (SELECT {entry} AS entries),
    keyed AS (
        SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS k, coalesce(text, '') AS t,
            CASE WHEN text IS NULL THEN 1 ELSE strlen(text) + 1 END AS size
        FROM documents),
    digits AS (SELECT *, hex(encode(t)) AS h FROM keyed),
    summed AS (
        SELECT *, xor(list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(range(strlen(t)), lambda i:
                ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT)),
            lambda a, b: xor(a >> 8, entries[xor(a & 255, b) + 1])), 4294967295) AS text_crc32
        FROM digits, crc),
    placed AS (
        SELECT *, ({shard(shards)})::INTEGER AS shard, ({shard(shards + 1)})::INTEGER AS grown_shard,
            substr(md5(k), 1, {BLOCK_DIGITS}) AS block
        FROM summed)
    SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
        row_number() OVER (PARTITION BY shard ORDER BY block, doc_id NULLS FIRST, size,
            text_crc32) - 1 AS slot, grown_shard
    FROM placed"""
