"""Hierarchical packing of token sequences into windows of several sizes.

Every task packs the documents it reads, so nothing is shuffled. A document goes to the tier of the
smallest window that holds it; a longer one is first cut into whole windows of the largest size.
Windows are filled from the largest tier down: the gap behind a long piece takes whole pieces of
shorter tiers, and at last a cut one that closes it exactly. A tier that has no shorter pieces left
to fill from cuts its own. What is left of a task, less than one largest window, is cut into windows
of falling powers of two, below the smallest tier too, so that nothing is padded.

The windows of one round are dealt to step groups of one token budget, largest first to the least
filled group, so that every step of a training run costs about the same.
"""

from __future__ import annotations

import heapq
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clicktally.llm.chunks import MEMORY, blocks, encoder

TIERS = (512, 1024, 2048, 4096)

# Tokens of a step group, and of the documents that are packed in one round.
STEP_TOKENS = 32_768
ROUND_TOKENS = 2_000_000

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long,"
    " window int, step_group long, ids binary"
)


class Packer:
    """Packs pieces ``(document, start, ids)``; each call of ``round`` returns closed windows."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers = sorted(tiers)
        self.pieces = {tier: deque() for tier in self.tiers}
        self.tokens = 0

    def _route(self, document, start: int, ids: np.ndarray, front: bool = False) -> None:
        tier = next(tier for tier in self.tiers if len(ids) <= tier)
        (self.pieces[tier].appendleft if front else self.pieces[tier].append)(
            (document, start, ids)
        )

    def add(self, document, ids: np.ndarray) -> None:
        self.tokens += len(ids)
        largest = self.tiers[-1]
        whole = len(ids) // largest * largest
        for start in range(0, whole, largest):
            self._route(document, start, ids[start : start + largest])
        if len(ids) > whole:
            self._route(document, whole, ids[whole:])

    def _fit(self, tier: int, gap: int):
        """A piece of a shorter tier for a gap, whole if one fits and else cut; or None."""
        shorter = [size for size in reversed(self.tiers) if size < tier and self.pieces[size]]
        for size in shorter:
            if len(self.pieces[size][0][2]) <= gap:
                return self.pieces[size].popleft()
        for size in [*reversed(shorter), tier]:
            if self.pieces[size]:
                document, start, ids = self.pieces[size].popleft()
                if len(ids) > gap:
                    self._route(document, start + gap, ids[gap:], front=True)
                return document, start, ids[:gap]
        return None

    def _fill(self, tier: int) -> tuple[list, int]:
        """One window of a tier and the gap that is left."""
        window = [self.pieces[tier].popleft()]
        gap = tier - len(window[0][2])
        while gap and (piece := self._fit(tier, gap)):
            window.append(piece)
            gap -= len(piece[2])
        return window, gap

    def round(self, last: bool = False) -> list[tuple[int, list]]:
        """Closed windows with their size; what does not fill one waits, unless it is the last.

        The largest tier is a power of two, so the rest of the last round can be cut into such sizes.
        """
        closed, waiting = [], []
        for tier in reversed(self.tiers):
            while self.pieces[tier]:
                window, gap = self._fill(tier)
                if gap:
                    waiting += window
                else:
                    closed.append((tier, window))
        if last and waiting:
            while left := sum(len(ids) for _, _, ids in waiting):
                size = min(self.tiers[-1], 1 << (left.bit_length() - 1))
                closed.append((size, self._take(waiting, size)))
        else:
            for piece in waiting:
                self._route(*piece)
        self.tokens = sum(len(piece[2]) for tier in self.tiers for piece in self.pieces[tier])
        return closed

    @staticmethod
    def _take(pieces: list, size: int) -> list:
        """Take so many tokens off the front of the pieces."""
        taken = []
        while size:
            document, start, ids = pieces.pop(0)
            taken.append((document, start, ids[:size]))
            if len(ids) > size:
                pieces.insert(0, (document, start + size, ids[size:]))
            size -= len(taken[-1][2])
        return taken


def step_groups(windows: list[tuple[int, list]], step_tokens: int) -> list[int]:
    """The group of every window: largest first, each to the group with the fewest tokens."""
    total = sum(size for size, _ in windows)
    loads = [(0, group) for group in range(max(1, -(-total // step_tokens)))]
    groups = [0] * len(windows)
    for place in sorted(range(len(windows)), key=lambda place: -windows[place][0]):
        load, group = heapq.heappop(loads)
        groups[place] = group
        heapq.heappush(loads, (load + windows[place][0], group))
    return groups


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    spaced: bool = False,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    memory: int = MEMORY,
) -> DataFrame:
    """One row per piece of ``doc_id`` and ``text``, with its ids as unsigned 32-bit integers.

    Every document ends with ``end_id``, so an empty or null text has one token; a null or repeated
    id is carried as it is, and other columns are left out. Every id lies in exactly one piece. Every
    window is full. ``sequence_id`` and ``step_group`` hold the number of the task in their upper bits.
    ``memory`` is the number of pieces of text that a worker remembers.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        encode = encoder(tokenizer_path, spaced, memory).encode
        packer = Packer(tiers)
        sequences, steps = base, base

        def rows(windows: list[tuple[int, list]]) -> Iterator[pa.RecordBatch]:
            nonlocal sequences, steps
            groups = step_groups(windows, step_tokens)
            out = []
            for (size, window), group in zip(windows, groups, strict=True):
                offset = 0
                for (doc_id, tokens), start, ids in window:
                    out.append(
                        (doc_id, start, len(ids), tokens, sequences, offset, size, steps + group)
                        + (ids.tobytes(),)
                    )
                    offset += len(ids)
                sequences += 1
            steps += max(groups, default=-1) + 1
            kinds = [pa.int64()] * 6 + [pa.int32(), pa.int64(), pa.binary()]
            names = [field.split()[0] for field in PIECES.split(", ")]
            for first in range(0, len(out), 4096):
                columns = zip(*out[first : first + 4096], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)],
                    names,
                )

        for batch in batches:
            for block in blocks(batch):
                ids, lengths = encode(block.column("text").to_pylist())
                ids = np.insert(ids, np.cumsum(lengths), end_id).astype("<u4")
                ends = np.cumsum(lengths + 1).tolist()
                for doc_id, start, end in zip(
                    block.column("doc_id").to_pylist(), [0, *ends], ends, strict=False
                ):
                    packer.add((doc_id, end - start), ids[start:end])
                if packer.tokens >= ROUND_TOKENS:
                    yield from rows(packer.round())
        yield from rows(packer.round(last=True))

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(pack, PIECES)
