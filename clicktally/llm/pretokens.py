"""Pre-tokens of a byte-level BPE, and how often each occurs in a table."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.llm.chunks import blocks, require_form

# The special token, which is found before anything else.
SPECIAL = "<|endoftext|>"

# Fixed pattern of the vocabulary, with white space written out.
_SPACE = r"\t-\r \x85\xa0  -     　"
_ANY = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)

# The same for texts without a character from U+0250 on, where letters and digits are few ranges.
_NARROW_TEXT = re.compile("[\x00-ɏ]*")
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_DIGITS = "0-9²³¹¼-¾"
_NARROW_SPACE = r"\t-\r \x85\xa0"
_NARROW = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_DIGITS}]+"
    rf"| ?[^{_NARROW_SPACE}{_LETTERS}{_DIGITS}]+"
    rf"|[{_NARROW_SPACE}]+(?![^{_NARROW_SPACE}])|[{_NARROW_SPACE}]+"
)

# Different pre-tokens that a task counts before it hands them on, and their characters together.
COUNTED = 250_000
COUNTED_CHARS = 8_000_000

# Bytes of a pre-token from which on it counts as rare, however often it occurs: what is sent to all tasks
# or kept by the driver has so many bytes for each word at most.
LONGEST_BYTES = 64


def pre_tokens(text: str | None) -> list[str]:
    """The pre-tokens of a text in order; a special token is one of its own."""
    if not text:
        return []
    if SPECIAL in text:
        first, *rest = text.split(SPECIAL)
        found = pre_tokens(first)
        for part in rest:
            found.append(SPECIAL)
            found += pre_tokens(part)
        return found
    return (_NARROW if _NARROW_TEXT.fullmatch(text) else _ANY).findall(text)


def pre_token_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``times`` for every different pre-token of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def rows() -> Iterator[pa.RecordBatch]:
            words = list(counts)
            for first in range(0, len(words), 65_536):
                part = words[first : first + 65_536]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array([counts[word] for word in part], pa.int64())],
                    ["word", "times"],
                )

        for batch in batches:
            for block in blocks(batch):
                for text in block.column("text").to_pylist():
                    counts.update(pre_tokens(text))
                if len(counts) >= COUNTED or sum(map(len, counts)) >= COUNTED_CHARS:
                    yield from rows()
                    counts.clear()
        yield from rows()

    partial = docs.select("text").mapInArrow(count, "word string, times long")
    return partial.groupBy("word").agg(F.sum("times").alias("times"))


def frequent(counts: DataFrame, bound: int) -> DataFrame:
    """The rows of short words that are at least one in ``bound`` of all: so there are at most that many.

    Together they have no more than ``bound * LONGEST_BYTES`` bytes, whatever the texts.
    """
    total = counts.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    short = F.octet_length("word") <= LONGEST_BYTES
    return counts.filter(short & (F.col("times") * bound >= total))


def require_pre_tokens(path: str) -> None:
    """Raise unless the pre-tokens of a vocabulary file are those of this module."""
    tokens = [token["content"] for token in require_form(path, spaced=True)["added_tokens"]]
    if tokens not in ([], [SPECIAL]):
        raise ValueError(f"{path}: other special tokens than {SPECIAL}")
