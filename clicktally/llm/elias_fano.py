"""Token files with Elias-Fano document boundaries.

A file holds the ids of its documents in one array, two bytes each where the vocabulary allows, and
the ends of the documents as an Elias-Fano sequence: the low bits of every end packed, the high bits
as one bit vector with a bit per document, about two bits per document above the packed ones. A sample
of every 64th set bit finds the end of any document by reading a few words, so there is no table of
64-bit offsets. The document ids are a second such sequence.

``write_token_files`` sorts the documents by id, one range per task, and writes numbered files;
``read_token_files`` reads them back. A file is written beside its place and moved there whole, so a
task that runs twice leaves one file, and nothing depends on what an executor keeps.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktally.llm.chunks import blocks, encoder

MAGIC = b"TOKEF001"
SAMPLE = 64

# Runs of values, of SAMPLE each, that a reader holds at once.
RUNS = 32
HEADER = struct.Struct("<8sqqqqq")
SEQUENCE = struct.Struct("<qqqqqq")
LONGEST = 2**62

# Tokens after which a task starts its next file, and tokens of the files that a task reads.
FILE_TOKENS = 16_000_000
READ_TOKENS = 64_000_000

MANIFEST = "path string, part int, number int, n_docs long, n_tokens long"


@dataclass
class EliasFano:
    """A sequence of integers that never falls, given as ``first`` plus encoded differences."""

    first: int
    count: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray
    samples: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        first = int(values[0]) if len(values) else 0
        offsets = values.astype(np.uint64) - np.uint64(first & (2**64 - 1))
        top = int(offsets[-1]) if len(values) else 0
        low_bits = max(0, (top // max(1, len(values))).bit_length() - 1)
        places = (offsets >> np.uint64(low_bits)).astype(np.int64) + np.arange(len(values))
        bits = np.zeros(int(places[-1]) + 1 if len(values) else 0, np.uint8)
        bits[places] = 1
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((offsets[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        return cls(
            first,
            len(values),
            low_bits,
            np.packbits(low.ravel(), bitorder="little"),
            np.packbits(bits, bitorder="little"),
            places[::SAMPLE].astype(np.uint32 if len(bits) < 2**32 else np.uint64),
        )

    def _low(self, start: int, end: int) -> np.ndarray:
        """The low bits of the values from ``start`` to ``end``."""
        if not self.low_bits:
            return np.zeros(end - start, np.uint64)
        first = start * self.low_bits
        last = end * self.low_bits
        bits = np.unpackbits(self.low[first // 8 : -(-last // 8)], bitorder="little")
        bits = bits[first % 8 : first % 8 + last - first].reshape(-1, self.low_bits)
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return (bits * weights).sum(1, dtype=np.uint64)

    def _value(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        offsets = (high.astype(np.uint64) << np.uint64(self.low_bits)) | low
        return (offsets + np.uint64(self.first & (2**64 - 1))).astype(np.int64)

    def select(self, index: int) -> int:
        """The value at a place, from the nearest sample on."""
        if not 0 <= index < self.count:
            raise IndexError(index)
        place = int(self.samples[index // SAMPLE])
        missing = index % SAMPLE
        byte = place // 8
        seen = np.unpackbits(self.high[byte : byte + 1], bitorder="little")
        seen[: place % 8] = 0
        while True:
            found = np.flatnonzero(seen)
            if missing < len(found):
                place = byte * 8 + int(found[missing])
                break
            missing -= len(found)
            byte += len(seen) // 8
            seen = np.unpackbits(self.high[byte : byte + SAMPLE], bitorder="little")
        high = np.array([place - index])
        return int(self._value(high, self._low(index, index + 1))[0])

    def values(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        return self._value(places - np.arange(self.count), self._low(0, self.count))

    def runs(self) -> Iterator[np.ndarray]:
        """The values in runs of ``SAMPLE``, each from its sample to the next one."""
        for run, place in enumerate(self.samples[: -(-self.count // SAMPLE)].tolist()):
            first, last = run * SAMPLE, min((run + 1) * SAMPLE, self.count)
            stop = int(self.samples[run + 1]) if last < self.count else 8 * len(self.high)
            bits = np.unpackbits(self.high[place // 8 : -(-stop // 8)], bitorder="little")
            bits[: place % 8] = 0
            places = place // 8 * 8 + np.flatnonzero(bits)[: last - first]
            yield self._value(places - np.arange(first, last), self._low(first, last))

    def to_bytes(self) -> bytes:
        wide = self.samples.itemsize
        sizes = (len(self.low), len(self.high), len(self.samples) * wide)
        head = SEQUENCE.pack(self.first, self.count, self.low_bits * 16 + wide, *sizes)
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, data: memoryview) -> tuple[EliasFano, int]:
        """The sequence at the start of the data, and how many bytes it takes."""
        first, count, bits, *sizes = SEQUENCE.unpack_from(data)
        ends = np.cumsum([SEQUENCE.size, *sizes]).tolist()
        low, high, samples = (data[a:b] for a, b in zip(ends, ends[1:], strict=False))
        wide = {4: np.uint32, 8: np.uint64}[bits % 16]
        return (
            cls(
                first,
                count,
                bits // 16,
                np.frombuffer(low, np.uint8),
                np.frombuffer(high, np.uint8),
                np.frombuffer(samples, wide),
            ),
            ends[-1],
        )


class TokenFile:
    """A token file whose head is in memory; ``document(i)`` reads the ids of one document."""

    def __init__(self, source: pa.NativeFile):
        self.source = source
        magic, self.width, self.nulls, self.n_docs, self.ids_at, self.n_tokens = HEADER.unpack(
            source.read_at(HEADER.size, 0)
        )
        if magic != MAGIC:
            raise ValueError("not a token file")
        view = memoryview(source.read_at(self.ids_at, 0))
        self.ends, size = EliasFano.from_bytes(view[HEADER.size :])
        self.keys, _ = EliasFano.from_bytes(view[HEADER.size + size :])

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from one place to another, which alone are read."""
        kind = {2: np.dtype("<u2"), 4: np.dtype("<u4")}[self.width]
        data = self.source.read_at((end - start) * self.width, self.ids_at + start * self.width)
        return np.frombuffer(data, kind)

    def document(self, index: int) -> np.ndarray:
        start = self.ends.select(index - 1) if index else 0
        return self.ids(start, self.ends.select(index))

    def doc_ids(self) -> list[int | None]:
        """The ids of the documents; those without one come first."""
        return [None] * self.nulls + self.keys.values().tolist()

    @staticmethod
    def pack(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, width: int) -> bytes:
        known = [key for key in doc_ids if key is not None]
        ends = EliasFano.of(np.cumsum(lengths, dtype=np.int64)).to_bytes()
        keys = EliasFano.of(np.array(known, np.int64)).to_bytes()
        gap = -(HEADER.size + len(ends) + len(keys)) % 8
        ids_at = HEADER.size + len(ends) + len(keys) + gap
        head = HEADER.pack(
            MAGIC, width, len(doc_ids) - len(known), len(doc_ids), ids_at, len(ids)
        )
        body = ids.astype(f"<u{width}")
        return b"".join([head, ends, keys, bytes(gap), body.tobytes()])


def open_store(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path and the path in it; one without a scheme is local or mounted."""
    return pyarrow.fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")


def _write_whole(folder: str, name: str, data: bytes, attempt: str) -> None:
    store, path = open_store(folder)
    with store.open_output_stream(f"{path}/.{name}-{attempt}") as out:
        out.write(data)
    store.move(f"{path}/.{name}-{attempt}", f"{path}/{name}")


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    spaced: bool = True,
    width: int = 2,
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Write the ids of ``doc_id`` and ``text`` in ascending order of ids; return the manifest.

    Each document ends with ``end_id``. A null text is empty, null ids come first, rows of one id lie
    side by side in the order of their texts' hashes; other columns are left out. ``width`` is the
    number of bytes of an id, 2 or 4. An empty table gives an empty manifest. The manifest is stored
    beside the files: writing is done when this returns.
    """
    spark = docs.sparkSession
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    where = {"folder": folder, "tokenizer": tokenizer_path}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part, attempt = context.partitionId(), str(context.taskAttemptId())
        encode = encoder(where["tokenizer"], spaced).encode
        keys, lengths, ids, total, number = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            name = f"tokens-{part:06d}-{number:06d}.bin"
            size = np.concatenate(lengths)
            data = TokenFile.pack(keys, size, np.concatenate(ids), width)
            _write_whole(where["folder"], name, data, attempt)
            row = [f"{where['folder']}/{name}"], [part], [number], [len(keys)], [total]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(value, kind)
                    for value, kind in zip(
                        row, [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                    )
                ],
                ["path", "part", "number", "n_docs", "n_tokens"],
            )

        for batch in batches:
            for block in blocks(batch):
                found, size = encode(block.column("text").to_pylist())
                found = np.insert(found, np.cumsum(size), end_id)
                if len(found) and found.max() >= 2 ** (8 * width):
                    raise ValueError(f"an id needs more than {width} bytes")
                ids.append(found.astype(f"<u{width}"))
                lengths.append(size + 1)
                keys += block.column("doc_id").to_pylist()
                total += len(found)
                if total >= file_tokens:
                    yield close()
                    keys, lengths, ids, total, number = [], [], [], 0, number + 1
        if keys:
            yield close()

    tie = F.xxhash64("text")
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id", tie)
        .sortWithinPartitions("doc_id", tie)
    )
    manifest = f"{folder}/manifest"
    ordered.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def placed_files(manifest: DataFrame) -> tuple[DataFrame, int]:
    """``path`` of every file and ``base``, the tokens before it; and the number of tasks to read them.

    The tokens of the parts before a part, one number for each task that wrote, are added up by the
    driver; those before a file within its part by a window over the part. There is a task for every
    ``READ_TOKENS`` tokens, but for no less than a file, and no fewer than there are cores.
    """
    spark = manifest.sparkSession
    parts = manifest.groupBy("part").agg(F.sum("n_tokens"), F.count("*")).collect()
    bases, tokens, files = [], 0, 0
    for part, held, count in sorted(parts):
        bases.append((part, tokens))
        tokens, files = tokens + held, files + count
    before = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    within = manifest.withColumn("within", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    placed = within.join(spark.createDataFrame(bases, "part int, tokens long"), "part")
    wanted = max(-(-tokens // READ_TOKENS), spark.sparkContext.defaultParallelism)
    paths = placed.select("path", (F.col("tokens") + F.col("within")).alias("base"))
    return paths, max(1, min(files, wanted))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``start`` over all files, ``n_tokens`` and ``ids_crc32``.

    The checksum is that of the ids as little-endian unsigned 32-bit integers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(
                batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True
            ):
                folder, _, name = path.rpartition("/")
                store, place = open_store(folder)
                with store.open_input_file(f"{place}/{name}") as source:
                    yield from documents_of(TokenFile(source), base)

    def documents_of(tokens: TokenFile, base: int) -> Iterator[pa.RecordBatch]:
        keys, first, start = tokens.doc_ids(), 0, 0
        # The ends and ids are held for some runs at a time, never as a table of the file.
        for runs in batched(tokens.ends.runs(), RUNS):
            ends = np.concatenate(runs)
            starts = np.concatenate([[start], ends[:-1]])
            ids = tokens.ids(start, int(ends[-1]))
            sums = [
                zlib.crc32(ids[a:b].astype("<u4"))
                for a, b in zip((starts - start).tolist(), (ends - start).tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[first : first + len(ends)], pa.int64()),
                    pa.array(starts + base),
                    pa.array(ends - starts),
                    pa.array(sums, pa.int64()),
                ],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )
            first, start = first + len(ends), int(ends[-1])

    files, tasks = placed_files(manifest)
    return files.repartitionByRange(tasks, "base").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
