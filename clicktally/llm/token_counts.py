"""Tokens of every text, from the pieces of every different pre-token.

The pre-tokens of all texts are counted once, and each different one is cut into pieces once. The
pieces of frequent pre-tokens, of which there is a proven number at most, go to all tasks, which add
them up for each text without a row for each word. What is rare stays a row of text, pre-token and
frequency, and is joined to the pieces. Token ids are never made for a text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.llm.chunks import blocks, load_tokenizer
from clicktally.llm.pretokens import (
    frequent,
    pre_token_counts,
    pre_tokens,
    require_pre_tokens,
)
from clicktally.session import fresh_path

# Most pre-tokens that are sent to all tasks: those that make up a millionth of all. Each has at most
# ``LONGEST_BYTES``, so they are no more than 64 MB, and typically 10.
BROADCAST_WORDS = 2**20

PARTS = "row long, doc_id long, n_bytes long, word string, times long, counted long"


def with_pieces(counts: DataFrame, tokenizer_path: str) -> DataFrame:
    """Add ``pieces`` to rows with ``word``: its tokens, by the tokenizers library."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(tokenizer_path)
        for batch in batches:
            words = batch.column("word").to_pylist()
            found = tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
            pieces = np.bincount(np.array(found.word_ids, np.int64), minlength=len(words))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pieces)], [*batch.schema.names, "pieces"]
            )

    return counts.mapInArrow(cut, "word string, times long, pieces long")


def count_tokens(
    docs: DataFrame, tokenizer_path: str, limit: int, most: int = BROADCAST_WORDS
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` for rows of ``doc_id`` and ``text``.

    A null text is empty and has no tokens. Repeated rows get a row each, null ids are carried, and other
    columns are left out.
    """
    require_pre_tokens(tokenizer_path)
    spark = docs.sparkSession
    path = fresh_path(spark, "pieces")
    with_pieces(pre_token_counts(docs), tokenizer_path).write.parquet(path)
    pieces = spark.read.parquet(path)
    known = spark.sparkContext.broadcast(
        {row.word: row.pieces for row in frequent(pieces, most).collect()}
    )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        of = known.value.get
        for batch in batches:
            for block in blocks(batch):
                texts = block.column("text")
                sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
                out = []
                for doc_id, text, size in zip(
                    block.column("doc_id").to_pylist(), texts.to_pylist(), sizes, strict=True
                ):
                    words = pre_tokens(text)
                    found = list(map(of, words))
                    rare = Counter(w for w, n in zip(words, found, strict=True) if n is None)
                    # A key that no pre-token can be, so that these rows match nothing.
                    out.append((row, doc_id, size, f"\x00{row}", 0, sum(filter(None, found))))
                    out += [(row, None, None, word, times, 0) for word, times in rare.items()]
                    row += 1
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(values, pa.string() if place == 3 else pa.int64())
                        for place, values in enumerate(columns)
                    ],
                    [field.split()[0] for field in PARTS.split(", ")],
                )

    parts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        add_up, PARTS
    )
    joined = parts.join(pieces.select("word", "pieces"), "word", "left")
    more = F.coalesce(F.col("times") * F.col("pieces"), F.lit(0))
    return (
        joined.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_bytes").alias("n_bytes"),
            F.sum(F.col("counted") + more).alias("n_tokens"),
        )
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
