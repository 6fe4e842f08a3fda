"""Periodic runs of words in texts: stretches that repeat themselves three times or more.

Words are read in order, and every lag between a word and an earlier occurrence of it is a diagonal. A word
that occurs again makes the diagonals of its lags one match longer; a diagonal that it does not lengthen has
ended, and is a run if it is long enough. There is nothing to go back for.

Only occurrences are looked at that can belong to a run. A run of period ``q`` is at least ``3 * q`` words
long, so with ``C`` a power of two, ``q`` above half of it and not above it, its words also agree in the
``C - 1`` words before them. An earlier occurrence therefore counts with its context of ``C`` words, and
only the latest one with a lag up to ``C``: a period no longer than the context that is not the latest one
has a smaller period as a divisor. So a word has at most one lag for each size of contexts, and the
diagonals are the runs themselves. Contexts have numbers, those of twice the size from two of half the
size, for many texts at once; they grow as long as any context occurs again.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clicktally.llm.chunks import blocks

LEAST_WORDS = 24
LEAST_PERIODS = 3

# The size of the shortest contexts: periods up to it need as many matches in a row.
SHORTEST = 8

# Bytes of text whose words are numbered together.
GROUP_BYTES = 4_000_000

Run = tuple[int, int, int]


def _numbered(keys: np.ndarray) -> np.ndarray:
    return pd.factorize(keys)[0].astype(np.int64)


def _extended(contexts: np.ndarray, size: int) -> np.ndarray:
    """Numbers of contexts of twice a size; the first words of all texts have contexts of their own."""
    joined = np.full(len(contexts), -1, np.int64)
    if len(contexts) > size:
        late, early = contexts[size:], contexts[:-size]
        whole = (late >= 0) & (early >= 0)
        span = int(contexts.max(initial=0)) + 1
        joined[size:][whole] = _numbered(late[whole] * span + early[whole])
    return joined


def _lags(contexts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places with an earlier occurrence at a lag of this size, the lags, and if any context repeats."""
    places = np.flatnonzero(contexts >= 0)
    order = places[np.argsort(contexts[places], kind="stable")]
    again = np.flatnonzero(contexts[order[1:]] == contexts[order[:-1]])
    lags = order[again + 1] - order[again]
    fits = (lags <= size) & ((lags > size // 2) | (size == SHORTEST))
    at = order[again + 1][fits]
    sorted_by_place = np.argsort(at)
    return at[sorted_by_place], lags[fits][sorted_by_place], len(again) > 0


def _ended(places: Sequence[int], lags: Sequence[int], size: int) -> Iterator[Run]:
    """Start, length and period of the runs among diagonals of one size of contexts, as they end."""
    matches, last, lag = 0, -1, 0
    for place, now in zip([*places, -2], [*lags, 0], strict=True):
        if matches and place == last + 1 and now == lag:
            matches += 1
        else:
            # The context of the first match, and one period before it, belong to the run.
            length = matches + size - 1 + lag
            if matches and length >= max(LEAST_WORDS, LEAST_PERIODS * lag):
                yield last + 1 - length, length, lag
            matches, lag = 1, now
        last = place


def runs_of_words(texts: Sequence[np.ndarray]) -> list[list[Run]]:
    """``(start, length, period)`` of the runs of each text, ordered; texts are arrays of word numbers."""
    # A word that occurs nowhere else stands between two texts.
    sizes = np.array([len(words) for words in texts], np.int64)
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    joined = np.full(int(sizes.sum()) + len(texts), -1, np.int64)
    for start, words in zip(starts, texts, strict=True):
        joined[start : start + len(words)] = words
    contexts, size = joined, 1
    found: list[list[Run]] = [[] for _ in texts]
    longest = int(sizes.max(initial=0))
    while size < SHORTEST or size // 2 < longest // LEAST_PERIODS:
        if size >= SHORTEST:
            places, lags, repeated = _lags(contexts, size)
            for start, length, period in _ended(places.tolist(), lags.tolist(), size):
                text = int(np.searchsorted(starts, start, "right")) - 1
                found[text].append((start - int(starts[text]), length, period))
            if not repeated:
                break
        contexts = _extended(contexts, size)
        size *= 2
    return [sorted(runs, key=lambda run: (run[0], run[2])) for runs in found]


def rewritten(words: list, doc_id: int | None) -> list:
    """The words of a document, where one in ten repeats a passage of its own, told by its id.

    Documents without an id or without words are as they are.
    """
    if doc_id is None or not words:
        return words
    code = zlib.crc32(str(doc_id).encode())
    if code % 10:
        return words
    rest = code // 10
    first = rest % len(words)
    period = 1 + (len(words) - first) // (3 + rest % 8)
    passage = words[first : first + period]
    times = -(-(len(words) - first) // period)
    return (words[:first] + passage * times)[: len(words)]


def best_run(runs: list[Run]) -> Run | None:
    """The run with the greatest exact length by period; the first of them, then the shortest period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list, runs: list[Run]) -> list:
    """The words without what follows the first period of a run."""
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()] if not kept.all() else words


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_runs", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("period", T.LongType()),
        T.StructField("exponent_milli", T.LongType()),
        T.StructField("runs_sha256", T.StringType()),
        T.StructField("collapsed_sha256", T.StringType()),
    ]
)

FOUND = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField(
            "runs",
            T.ArrayType(
                T.StructType(
                    [T.StructField(name, T.LongType()) for name in ("start", "length", "period")]
                )
            ),
        ),
        T.StructField("collapsed", T.StringType()),
    ]
)


def _documents(batch: pa.RecordBatch, rewrite: bool) -> Iterator[tuple[int | None, list, list[Run]]]:
    """Id, words and runs of every document of a batch."""
    ids = batch.column("doc_id").to_pylist()
    texts = [(text or "").encode().split() for text in batch.column("text").to_pylist()]
    if rewrite:
        texts = [rewritten(words, doc_id) for words, doc_id in zip(texts, ids, strict=True)]
    flat = pa.array([word for words in texts for word in words], pa.binary())
    numbers = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    parts = np.split(numbers, np.cumsum([len(words) for words in texts])[:-1]) if texts else []
    yield from zip(ids, texts, runs_of_words(parts), strict=True)


def _digests(documents: Iterator[tuple[int | None, list, list[Run]]]) -> Iterator[tuple]:
    for doc_id, words, runs in documents:
        lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
        best = best_run(runs)
        places = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        kept = b" ".join(collapsed(words, runs))
        yield doc_id, len(runs), *places, _sha256(lines.encode()), _sha256(kept)


def _mapped(docs: DataFrame, rewrite: bool, rows, schema: T.StructType) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    wanted = to_arrow_schema(schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, chars=GROUP_BYTES):
                columns = list(zip(*rows(_documents(block, rewrite)), strict=True))
                arrays = [pa.array(column, field.type) for column, field in zip(columns, wanted)]
                if arrays:
                    yield pa.RecordBatch.from_arrays(arrays, schema=wanted)

    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(add, schema)


def periodic_runs(docs: DataFrame, rewrite: bool = False) -> DataFrame:
    """``doc_id``, ``runs`` (start, length and period in words) and the ``collapsed`` text of every row.

    A run is a stretch of words with smallest period ``q`` that is at least three periods and 24 words long
    and that no neighbour extends. Words are what stands between ASCII white space; runs may overlap and
    are ordered by start, then period. The collapsed text keeps the first period of each run and joins the
    words by single spaces. Null and empty texts have no runs and an empty text; repeated rows get a row
    each, null ids are carried, other columns are left out. ``rewrite`` first makes passages repeat, see
    ``rewritten``.
    """

    def rows(documents: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, words, runs in documents:
            fields = [dict(zip(("start", "length", "period"), run, strict=True)) for run in runs]
            yield doc_id, fields, b" ".join(collapsed(words, runs)).decode()

    return _mapped(docs, rewrite, rows, FOUND)


def run_digests(docs: DataFrame, rewrite: bool = False) -> DataFrame:
    """Number of runs, the run with most periods and checksums, for the rows of ``periodic_runs``.

    ``start``, ``length``, ``period`` and ``exponent_milli`` are null where there is no run; the checksums
    never are. Of runs with equally many periods the first counts, then that of the shortest period.
    """
    return _mapped(docs, rewrite, _digests, SCHEMA)
