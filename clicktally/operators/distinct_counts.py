"""Exact numbers of distinct values that can be merged, as bitmaps over numbered values.

Every value of a dimension has one number for good. The values of an offer are then bits, in words of 64
numbers, and a piece holds those words of its 32,768 numbers that have a bit, with their places; a union is
a bitwise or, so pieces of any runs can be merged in any order, and one that is merged twice counts once. A
hot offer has a piece of up to 512 words for each 32,768 numbers and no list of values. An offer of few
values has no more words than values, however far apart their numbers lie.

Words are made and merged by hash aggregations of fixed width, which spill, so no task holds bitmaps of
pieces that are nearly empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a number belongs to.
VALUE = ("dimension", "value")

# A word has 2^6 numbers, a piece 2^9 words.
WORD_BITS = 6
PIECE_BITS = 9
WORDS = 2**PIECE_BITS


def number_values(values: DataFrame, above: int) -> DataFrame:
    """A number greater than ``above`` for each distinct value, counted up within each partition.

    The numbers depend on how the rows lie, so the result has to be stored before it is used.
    """
    distinct = values.select(*VALUE).distinct()
    return distinct.select(*VALUE, (F.monotonically_increasing_id() + above + 1).alias("number"))


def value_bitmaps(values: DataFrame, numbers: DataFrame, *by: str) -> DataFrame:
    """Bitmaps of the numbers of the values, per ``by``, dimension and piece.

    ``values`` are rows of :func:`dimension_values`; those without a number are left out.
    """
    number = F.col("number")
    word = F.shiftright(number, WORD_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(2**WORD_BITS)).cast("int"))
    numbered = values.join(numbers, list(VALUE))
    return _pieces(numbered.select(*by, "dimension", word.alias("word"), bit.alias("bits")), *by)


def _merged_words(words: DataFrame, *by: str) -> DataFrame:
    return words.groupBy(*by, "dimension", "word").agg(F.bit_or("bits").alias("bits"))


def _words(bitmaps: DataFrame, *by: str) -> DataFrame:
    """The words of bitmaps, a row each."""
    word = F.col("piece") * WORDS + F.col("held.place")
    held = bitmaps.select(*by, "dimension", "piece", F.explode("bits").alias("held"))
    return held.select(*by, "dimension", word.alias("word"), F.col("held.bits").alias("bits"))


def _pieces(words: DataFrame, *by: str) -> DataFrame:
    """The union of words, put together per ``by``, dimension and piece."""
    piece = F.shiftright("word", PIECE_BITS).alias("piece")
    held = F.struct(F.pmod("word", F.lit(WORDS)).cast("short").alias("place"), "bits")
    merged = _merged_words(words, *by)
    return merged.groupBy(*by, "dimension", piece).agg(F.collect_list(held).alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, *by: str) -> DataFrame:
    """The union of bitmaps, per ``by``, dimension and piece."""
    return _pieces(_words(bitmaps, *by), *by)


def distinct_counts(bitmaps: DataFrame, *by: str) -> DataFrame:
    """The number of distinct values per ``by`` and dimension."""
    merged = _merged_words(_words(bitmaps, *by), *by)
    return merged.groupBy(*by, "dimension").agg(F.sum(F.bit_count("bits")).alias("n_values"))
