"""BPE by a minimal acyclic transducer of frequent words, and exact merges for all others.

Frequent pre-tokens of the corpus are merged once. Their bytes are the paths of an automaton in which
words with equal endings share states; every arc carries how many words come before those behind
it, so the sum along a path is the number of the word, and with it the place of its ids. The automaton
is a file of sorted arrays that all workers of an executor map into memory. A batch of words walks it
in step, byte by byte. Words that it does not hold are merged by the merge ranks of the vocabulary, all
words of a batch at a time: each round merges the best pair of every word.
"""

from __future__ import annotations

import json
import mmap
import struct
from collections.abc import Iterator, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktally.llm.chunks import blocks, expand
from clicktally.llm.elias_fano import open_store
from clicktally.llm.pretokens import (
    SPECIAL,
    frequent,
    pre_token_counts,
    pre_tokens,
    require_pre_tokens,
)
from clicktally.session import fresh_path

# Most words of the automaton: those that are one of so many pre-tokens of the corpus.
LEXICON_WORDS = 2**20

# Words outside the automaton whose ids a worker remembers, and bytes of these and their ids; a block of
# texts may add as much as it has itself.
REMEMBERED = 200_000
REMEMBERED_BYTES = 64_000_000

# Bytes of text that are encoded at once: the arrays of a block take about 50 times as much.
CODEC_CHARS = 500_000

NO_PAIR = np.int32(2**31 - 1)


def byte_characters() -> list[str]:
    """The character by which the vocabulary writes each byte: itself, or one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in plain]
    of = {byte: chr(byte) for byte in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [of[byte] for byte in range(256)]


class Vocabulary:
    """The merges of a byte-level vocabulary file and the bytes of its ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        ids = data["model"]["vocab"]
        characters = byte_characters()
        byte_of = {character: byte for byte, character in enumerate(characters)}
        self.byte_ids = np.array([ids[character] for character in characters], np.int64)
        self.special = {token["content"]: token["id"] for token in data["added_tokens"]}
        merges = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = order.astype(np.int32)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)
        pieces = {i: bytes(byte_of[c] for c in token) for token, i in ids.items()}
        pieces |= {i: token.encode() for token, i in self.special.items()}
        table = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        self.piece_sizes = np.array([len(piece) for piece in table], np.int64)
        self.piece_starts = np.cumsum(self.piece_sizes) - self.piece_sizes
        self.piece_bytes = np.frombuffer(b"".join(table), np.uint8)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        places = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[places] == keys, self.pair_ranks[places], NO_PAIR)

    def merge(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after the other, and how many each has; no word is empty."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        lengths = np.zeros(len(words), np.int64)
        done_ids, done_owners = [], []
        # The rank of each id with the next one of its word.
        rank = np.full(len(ids), NO_PAIR)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inside] = self._ranks(ids[inside], ids[inside + 1])
        while len(ids):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            counts = np.diff(np.append(starts, len(ids)))
            best = np.repeat(np.minimum.reduceat(rank, starts), counts)
            finished = best == NO_PAIR
            if finished.any():
                done_ids.append(ids[finished])
                done_owners.append(owner[finished])
                open_ = ~finished
                ids, owner, rank, best = ids[open_], owner[open_], rank[open_], best[open_]
                if not len(ids):
                    break
            chosen = np.flatnonzero(rank == best)
            # Of overlapping pairs, as in "aaa", every second one from the left of their run.
            fresh = np.diff(chosen, prepend=-2) != 1
            place = np.arange(len(chosen)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            chosen = chosen[place % 2 == 0]
            ids[chosen] = self.merged[rank[chosen]]
            keep = np.ones(len(ids), bool)
            keep[chosen + 1] = False
            at = (np.cumsum(keep) - 1)[chosen]
            ids, owner, rank = ids[keep], owner[keep], rank[keep]
            changed = np.concatenate([at, at[at > 0] - 1])
            rank[changed] = NO_PAIR
            inside = changed[changed + 1 < len(ids)]
            inside = inside[owner[inside] == owner[inside + 1]]
            rank[inside] = self._ranks(ids[inside], ids[inside + 1])
        if not done_ids:
            return ids, lengths
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owners)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.bincount(owner, minlength=len(words))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ids; an id outside the vocabulary has none."""
        ids = ids[ids < len(self.piece_sizes)]
        return self.piece_bytes[expand(self.piece_starts[ids], self.piece_sizes[ids])].tobytes()


    def text(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are not UTF-8 become U+FFFD."""
        return self.decode(ids).decode("utf-8", "replace")


HEADER = struct.Struct("<8sqqqq")
MAGIC = b"BPEMAT01"


class Transducer:
    """A minimal acyclic automaton whose words are numbered, with the ids of each word.

    ``keys`` are the arcs in order: the state above the byte. State 0 is the start. ``before`` is what
    an arc adds to the number of a word, and ``final`` tells the states where words end.
    """

    def __init__(self, keys, targets, before, final, ends, ids):
        self.keys, self.targets, self.before = keys, targets, before
        self.final, self.ends, self.ids = final, ends, ids

    @classmethod
    def of(cls, words: Sequence[bytes], lengths: np.ndarray, ids: np.ndarray) -> Transducer:
        """The automaton of different words in ascending order.

        Words are added one by one. The states of the last word that the next one does not pass
        are complete then, and are replaced by an equal state if there is one.
        """
        known: dict[tuple, int] = {}
        arcs: list[dict[int, int]] = []
        ends: list[bool] = []
        behind: list[int] = []

        def settled(state: dict[int, int], end: bool) -> int:
            signature = (end, tuple(state.items()))
            if signature not in known:
                known[signature] = len(arcs)
                arcs.append(state)
                ends.append(end)
                behind.append(end + sum(behind[target] for target in state.values()))
            return known[signature]

        path: list[tuple[dict[int, int], bool]] = [({}, False)]
        last = b""

        def settle(depth: int) -> None:
            while len(path) > depth + 1:
                state, end = path.pop()
                path[-1][0][last[len(path) - 1]] = settled(state, end)

        for word in words:
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            settle(shared)
            path += [({}, place == len(word) - 1) for place in range(shared, len(word))]
            last = word
        settle(0)
        start = settled(*path[0])
        # Number the start 0 and keep the others in order.
        number = {start: 0}
        for state in range(len(arcs)):
            if state != start:
                number[state] = len(number)
        by_number = sorted(number, key=number.__getitem__)
        keys, targets, before = [], [], []
        for state in by_number:
            total = int(ends[state])
            for byte, target in arcs[state].items():
                keys.append(number[state] << 8 | byte)
                targets.append(number[target])
                before.append(total)
                total += behind[target]
        return cls(
            np.array(keys, np.int64),
            np.array(targets, np.int64),
            np.array(before, np.int64),
            np.array([ends[state] for state in by_number], bool),
            np.cumsum(lengths, dtype=np.int64),
            ids.astype(np.int32),
        )

    def numbers(self, words: Sequence[bytes]) -> np.ndarray:
        """The number of every word in the order of the automaton, -1 for a word that it lacks."""
        out = np.full(len(words), -1, np.int64)
        if not len(self.keys) or not len(words):
            return out
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        state, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        walking, step = np.arange(len(words)), 0
        while len(walking):
            ended = sizes[walking] == step
            there = walking[ended]
            hit = there[self.final[state[there]]]
            out[hit] = number[hit]
            walking = walking[~ended]
            wanted = state[walking] << 8 | text[starts[walking] + step]
            places = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            found = self.keys[places] == wanted
            walking, places = walking[found], places[found]
            number[walking] += self.before[places]
            state[walking] = self.targets[places]
            step += 1
        return out

    def ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered words one after the other, and how many each has."""
        starts = np.where(numbers > 0, self.ends[numbers - 1], 0)
        lengths = self.ends[numbers] - starts
        return self.ids[expand(starts, lengths)].astype(np.int64), lengths

    def to_bytes(self) -> bytes:
        head = HEADER.pack(MAGIC, len(self.keys), len(self.final), len(self.ends), len(self.ids))
        arrays = (self.keys, self.targets, self.before, self.ends, self.ids, self.final)
        return head + b"".join(array.tobytes() for array in arrays)

    @classmethod
    def map(cls, path: str) -> Transducer:
        """The automaton of a file, read through the memory map of the file."""
        with open(path, "rb") as file:
            data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        magic, arcs, states, words, ids = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a transducer")
        at, arrays = HEADER.size, []
        for kind, count in (
            *((np.int64, arcs),) * 3, (np.int64, words), (np.int32, ids), (np.bool_, states)
        ):
            arrays.append(np.frombuffer(data, kind, count, at))
            at += arrays[-1].nbytes
        keys, targets, before, ends, all_ids, final = arrays
        return cls(keys, targets, before, final, ends, all_ids)


class Numbers(dict):
    """Numbers words in the order they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Codec:
    """Encodes lists of texts with a transducer, and merges what it lacks."""

    def __init__(self, vocabulary: Vocabulary, transducer: Transducer):
        self.vocabulary, self.transducer = vocabulary, transducer
        self._forget()

    def _forget(self) -> None:
        self.others, self.chars = Numbers(), 0
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _merge(self, words: list[str]) -> None:
        """Merge new words; a special token has its own id and is not merged."""
        special = self.vocabulary.special
        ids, lengths = self.vocabulary.merge([word.encode() for word in words])
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
        for place in [i for i, word in enumerate(words) if word in special]:
            starts[place], lengths[place] = len(self.flat), 1
            self.flat = np.append(self.flat, np.int32(special[words[place]]))
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])

    def _others(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words outside the transducer, and how many each has."""
        if len(self.others) > REMEMBERED or 4 * self.chars + self.flat.nbytes > REMEMBERED_BYTES:
            self._forget()
        known = len(self.others)
        places = np.fromiter(map(self.others.__getitem__, words), np.int64, len(words))
        if len(self.others) > known:
            new = list(islice(self.others, known, None))
            self.chars += sum(map(len, new))
            self._merge(new)
        lengths = self.lengths[places]
        return self.flat[expand(self.starts[places], lengths)].astype(np.int64), lengths

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has; null is empty."""
        cut = [pre_tokens(text) for text in texts]
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        slot = Numbers()
        slots = np.fromiter(
            map(slot.__getitem__, chain.from_iterable(cut)), np.int64, counts.sum()
        )
        words = list(slot)
        if not words:
            return np.zeros(0, np.int64), counts
        numbers = self.transducer.numbers([word.encode() for word in words])
        held = np.flatnonzero(numbers >= 0)
        lengths = np.zeros(len(words), np.int64)
        ids, lengths[held] = self.transducer.ids_of(numbers[held])
        lacking = np.flatnonzero(numbers < 0)
        if len(lacking):
            more, lengths[lacking] = self._others([words[i] for i in lacking.tolist()])
            ids = np.concatenate([ids, more])
        order = np.concatenate([held, lacking])
        starts = np.zeros(len(words), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        sizes = lengths[slots]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *counts])]
        return ids[expand(starts[slots], sizes)], np.diff(ends)


def build_transducer(docs: DataFrame, tokenizer_path: str, most: int = LEXICON_WORDS) -> str:
    """Store the transducer of the frequent words of all texts in the shared folder; its path.

    ``most`` is a proven bound of its words: each is at least one in so many pre-tokens. They are short
    ones, so the driver holds ``most * LONGEST_BYTES`` bytes of them at most.
    """
    require_pre_tokens(tokenizer_path)
    spark = docs.sparkSession
    counts = pre_token_counts(docs).checkpoint()
    words = sorted(
        row.word.encode() for row in frequent(counts, most).collect() if row.word != SPECIAL
    )
    ids, lengths = (
        Vocabulary(tokenizer_path).merge(words)
        if words
        else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    )
    path = f"{fresh_path(spark, 'lexicon')}.bin"
    store, place = open_store(path)
    with store.open_output_stream(place) as out:
        out.write(Transducer.of(words, lengths, ids).to_bytes())
    return path


_codecs: dict[tuple[str, str], Codec] = {}
_vocabularies: dict[str, Vocabulary] = {}


def _vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def encode_documents(
    docs: DataFrame, tokenizer_path: str, transducer_path: str, decoded: bool = False
) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids``, unsigned 32-bit integers, for ``doc_id`` and ``text``.

    Spark copies the transducer to every executor, whose workers map it. A null text is empty and
    has no ids. Repeated rows get a row each, null ids are carried, other columns are left out. With
    ``decoded`` there is a column ``text`` of what the ids decode to, made by the same worker.
    """
    spark = docs.sparkSession
    spark.sparkContext.addFile(transducer_path)
    name = transducer_path.rpartition("/")[2]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import SparkFiles

        key = tokenizer_path, name
        if key not in _codecs:
            _codecs.clear()
            _codecs[key] = Codec(_vocabulary(tokenizer_path), Transducer.map(SparkFiles.get(name)))
        codec = _codecs[key]
        for batch in batches:
            for block in blocks(batch, chars=CODEC_CHARS):
                ids, lengths = codec.encode(block.column("text").to_pylist())
                ends = np.concatenate([[0], np.cumsum(lengths)])
                offsets = pa.array(4 * ends, pa.int32())
                data = pa.py_buffer(ids.astype("<u4").tobytes())
                binary = pa.Array.from_buffers(
                    pa.binary(), len(lengths), [None, offsets.buffers()[1], data]
                )
                columns = [block.column("doc_id"), pa.array(lengths), binary]
                if decoded:
                    texts = [
                        codec.vocabulary.text(ids[a:b])
                        for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False)
                    ]
                    columns.append(pa.array(texts, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    fields = ["doc_id long", "n_tokens long", "ids binary", *["text string"] * decoded]
    names = [field.split()[0] for field in fields]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        encode, ", ".join(fields)
    )


def decode_documents(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """Add ``text`` to rows with ``ids``: the text of the ids, null for null.

    Bytes that are not UTF-8 become U+FFFD, as the tokenizers library decodes them.
    """
    names = encoded.columns

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(tokenizer_path)
        for batch in batches:
            texts = [
                None if ids is None else vocabulary.text(np.frombuffer(ids, "<u4").astype(np.int64))
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*names, "text"]
            )

    schema = T.StructType([*encoded.schema.fields, T.StructField("text", T.StringType())])
    return encoded.mapInArrow(decode, schema)
