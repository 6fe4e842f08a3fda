"""Ids of whole texts by the tokenizers library, with a memory of the pieces already encoded.

A text is cut where the tokenizer always cuts: at a space or a newline that stands between two
characters that are not white space. Each piece is encoded by the library once and then remembered,
since natural text repeats its words. A text that has other white space next to a cut, or the start of
a special token, is handed to the library whole, so the ids are the library's for every text. Files for
which these cuts are not proven are refused.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, compress, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute

# What one Python worker remembers: pieces of up to so many characters, and no more pieces, and bytes of
# them and their ids, than these; beyond, it drops the half that was used less. Longer pieces, as texts
# without spaces have them, are encoded like others and not kept. With what Python needs for a piece
# this is about 250 MB for words, and 500 MB at most.
LONGEST = 128
MEMORY = 1_000_000
MEMORY_BYTES = 192_000_000

# The number of a piece that is not kept, from which on they count.
PASSING = 2**40

# The normalizer and pre-tokenizer for which the cuts of this module are proven, for files
# whose words keep the space before them and for those that drop white space.
SPACED_FORM = (None, {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True})
DROPPED_FORM = (
    {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {
                    "Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
                },
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False},
        ],
    },
)

# White space but for space and newline; white space beside a space or newline.
OTHER_SPACE = re.compile(r"[^\S \n]")
NEXT_TO_SPACE = re.compile(r"[ \n]\s|\s[ \n]")

# Characters of text that are encoded at once.
BLOCK_CHARS = 2_000_000


def load_tokenizer(path: str):
    """The tokenizer of a vocabulary file, on one thread, as its file describes it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _without_offsets(part):
    """A part of a file without what only tells how places in texts are reported."""
    if isinstance(part, dict):
        return {key: _without_offsets(value) for key, value in part.items() if key != "trim_offsets"}
    return [_without_offsets(value) for value in part] if isinstance(part, list) else part


def require_form(path: str, spaced: bool) -> dict:
    """The vocabulary file, if texts may be cut as this module does; raises if that is not proven."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    form = _without_offsets([data.get("normalizer"), data.get("pre_tokenizer")])
    model = data["model"]
    plain = model.get("type") == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
    tokens = data.get("added_tokens") or []
    marked = all(
        token["content"].startswith("<|")
        and not any(token.get(flag) for flag in ("single_word", "lstrip", "rstrip", "normalized"))
        for token in tokens
    )
    if form != list(SPACED_FORM if spaced else DROPPED_FORM) or not plain or not marked:
        raise ValueError(f"{path}: not a vocabulary file whose texts may be cut at spaces")
    return data


def blocks(
    batch: pa.RecordBatch, column: str = "text", chars: int = BLOCK_CHARS
) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts are about ``chars`` bytes long together.

    The texts are a column or the field ``text`` of one.
    """
    texts = batch.column(column)
    if pa.types.is_struct(texts.type):
        texts = texts.field("text")
    sizes = np.nan_to_num(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False))
    group = (np.cumsum(sizes) // chars).astype(np.int64)
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(start, end - start)


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``start, start + 1, ...`` of every range, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class _Slots(dict):
    """Numbers pieces in the order they are first asked for; long ones apart, in ``passing``."""

    def __init__(self, *known):
        super().__init__(*known)
        self.passing: dict[str, int] = {}

    def __missing__(self, piece: str) -> int:
        if len(piece) > LONGEST:
            return PASSING + self.passing.setdefault(piece, len(self.passing))
        self[piece] = number = len(self)
        return number


class ChunkEncoder:
    """Encodes lists of texts; ``spaced`` tells that a word keeps the space before it."""

    def __init__(self, path: str, spaced: bool, memory: int = MEMORY):
        require_form(path, spaced)
        self.memory = memory
        self.chars = 0
        self.tokenizer = load_tokenizer(path)
        self.spaced = spaced
        self.slot = _Slots()
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)
        self.stops = {
            stop: self.tokenizer.encode(stop, add_special_tokens=False).ids[0] for stop in ".,"
        }

    def _forget(self) -> None:
        """Keep the half of the pieces that was used most."""
        half = min(self.memory, len(self.slot)) // 2
        kept = np.sort(np.argpartition(-self.uses, half)[:half])
        pieces = list(self.slot)
        self.slot = _Slots(zip((pieces[i] for i in kept.tolist()), range(len(kept))))
        self.chars = sum(map(len, self.slot))
        self.flat = self.flat[expand(self.starts[kept], self.lengths[kept])]
        self.lengths = self.lengths[kept]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.uses = self.uses[kept] // 2

    def _odd(self, text: str) -> bool:
        """Whether the tokenizer may cut elsewhere than at the spaces and newlines."""
        if "<|" in text:
            return True
        if not self.spaced:
            return False
        if not text or text[0].isspace() or text[-1].isspace():
            return True
        if any(pair in text for pair in ("  ", "\n\n", " \n", "\n ")):
            return True
        # No white space but the space is printable, and this test is the faster one.
        if text.replace("\n", "").isprintable():
            return False
        return bool(OTHER_SPACE.search(text) and NEXT_TO_SPACE.search(text))

    def _pieces(self, text: str) -> list[str]:
        if self._odd(text):
            return []
        if self.spaced:
            return f"\n{text}".replace("\n", " \n").split(" ")[1:]
        return text.replace("\n", " ").split(" ")

    def _library(self, pieces: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after the other, and how many each has, by the library."""
        words = (
            [piece if piece[:1] == "\n" else f" {piece}" for piece in pieces]
            if self.spaced
            else pieces
        )
        encoding = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        lengths = np.bincount(np.array(encoding.word_ids, np.int64), minlength=len(words))
        return np.array(encoding.ids, np.int32), lengths

    def _learn(self, known: int) -> None:
        """Encode the pieces from a number on.

        A full stop or comma after a Latin letter is always cut off and has an id of its own, so such
        a piece is made from the one without it, which is encoded if it is new too. Not after a
        letter that ends in a mark when it is made small, since marks and stops are one pre-token.
        """
        fresh = list(islice(reversed(self.slot), len(self.slot) - known))[::-1]
        ended = [
            piece
            for piece in fresh
            if piece[-1:] in self.stops
            and piece[-2:-1].lower()[-1:].isalpha()
            and piece[-2] < "\u0250"
        ]
        # A stem is shorter than its piece, so it is kept as well.
        stems = np.fromiter(
            map(self.slot.__getitem__, (piece[:-1] for piece in ended)), np.int64, len(ended)
        )
        made = np.fromiter(map(self.slot.__getitem__, ended), np.int64, len(ended))
        # The stems may be new as well.
        stems_from = len(self.slot) - known - len(fresh)
        fresh += list(islice(reversed(self.slot), stems_from))[::-1]
        new = len(fresh)
        self.chars += sum(map(len, fresh))
        by_library = np.ones(new, bool)
        by_library[made - known] = False
        pieces = list(compress(fresh, by_library))
        ids, sizes = self._library(pieces)
        lengths, starts = np.zeros(new, np.int64), np.zeros(new, np.int64)
        lengths[by_library] = sizes
        starts[by_library] = len(self.flat) + np.cumsum(sizes) - sizes
        self.lengths = np.concatenate([self.lengths, lengths])
        self.starts = np.concatenate([self.starts, starts])
        self.uses = np.concatenate([self.uses, np.zeros(new, np.int64)])
        # A stem may itself be made of another one only if it ended in a stop, not in a letter.
        sizes = self.lengths[stems]
        ends = np.cumsum(sizes)
        stops = np.array([self.stops[piece[-1]] for piece in ended], np.int32)
        of_stems = np.concatenate([self.flat, ids])
        ended_ids = np.insert(of_stems[expand(self.starts[stems], sizes)], ends, stops)
        self.lengths[made] = sizes + 1
        self.starts[made] = len(of_stems) + np.cumsum(sizes + 1) - (sizes + 1)
        self.flat = np.concatenate([of_stems, ended_ids.astype(np.int32)])

    def encode(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has; null is empty."""
        texts = [text or "" for text in texts]
        cut = [self._pieces(text) for text in texts]
        # A character takes four bytes at most.
        if len(self.slot) > self.memory or 4 * self.chars + self.flat.nbytes > MEMORY_BYTES:
            self._forget()
        known = len(self.slot)
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        slots = np.fromiter(
            map(self.slot.__getitem__, chain.from_iterable(cut)), np.int64, counts.sum()
        )
        if len(self.slot) > known:
            self._learn(known)
        starts, lengths, flat = self.starts, self.lengths, self.flat
        if self.slot.passing:
            found, sizes = self._library(list(self.slot.passing))
            starts = np.concatenate([starts, len(flat) + np.cumsum(sizes) - sizes])
            lengths, flat = np.concatenate([lengths, sizes]), np.concatenate([flat, found])
            passing = slots >= PASSING
            slots[passing] += len(self.slot) - PASSING
            self.slot.passing = {}
        self.uses += np.bincount(slots, minlength=len(self.uses))[: len(self.uses)]
        lengths = lengths[slots]
        ids = flat[expand(starts[slots], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum([0, *counts])]
        lead = int(self.spaced)
        if lead:
            first = ends[:-1][counts > 0]
            keep = np.ones(len(ids), bool)
            keep[first] = False
            ids = ids[keep]
            ends = ends - np.concatenate([[0], np.cumsum(counts > 0)])
        doc_lengths = np.diff(ends)
        odd = [i for i in np.flatnonzero(counts == 0).tolist() if texts[i]]
        if not odd:
            return ids, doc_lengths
        parts, at = [], 0
        for i in odd:
            whole = self.tokenizer.encode(texts[i], add_special_tokens=False).ids
            parts += [ids[at : ends[i]], np.array(whole, np.int32)]
            at = ends[i]
            doc_lengths[i] = len(whole)
        return np.concatenate([*parts, ids[at:]]), doc_lengths


_encoders: dict[tuple[str, bool, int], ChunkEncoder] = {}


def encoder(path: str, spaced: bool, memory: int = MEMORY) -> ChunkEncoder:
    """The encoder of this Python worker, which keeps its memory from task to task."""
    key = path, spaced, memory
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(*key)
    return _encoders[key]
