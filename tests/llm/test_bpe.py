"""The transducer, exact merges and token counts against the tokenizers library."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clicktally.llm import pretokens, token_counts, transducer
from clicktally.llm.chunks import load_tokenizer
from clicktally.llm.queries import op1_transducer_bpe, op9_pre_token_counts

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = load_tokenizer(BYTE_BPE)
VOCABULARY = transducer.Vocabulary(BYTE_BPE)
PARTS = st.sampled_from(
    [" ", "\n", "  ", "\t", "\r\n", "a", "Bc", "éç", "'s", "'ll", "12", "²", "½", "Σ", "İ", "́", " "]
    + [" ", "\x1c", "\x85", "\x00", "<|endoftext|>", "<|", "日本", "😀", ".", ",\n", "_", "ªº", "ɐ", "×"]
)
TEXTS = st.lists(PARTS, max_size=12).map("".join)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_pre_tokens_are_those_of_the_library(text):
    if pretokens.SPECIAL not in text:
        found = [text[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(text)]
        assert pretokens.pre_tokens(text) == found


def test_every_narrow_character_is_cut_as_the_library_does():
    for code in range(0x250):
        text = f"a{chr(code)}1 {chr(code)}b{chr(code)}{chr(code)} .{chr(code)}"
        found = [text[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(text)]
        assert pretokens.pre_tokens(text) == found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aeAthin géĀ日😀.'", min_size=1, max_size=30), max_size=8))
def test_merges_are_exact(words):
    words = [word for text in words for word in pretokens.pre_tokens(text)]
    ids, lengths = VOCABULARY.merge([word.encode() for word in words])
    wanted = [LIBRARY.encode(word, add_special_tokens=False).ids for word in words]
    assert ids.tolist() == [i for found in wanted for i in found]
    assert lengths.tolist() == [len(found) for found in wanted]


@given(st.sets(st.binary(min_size=1, max_size=6), max_size=60), st.lists(st.binary(max_size=6)))
def test_transducer_numbers_its_words_and_no_others(words, others):
    words = sorted(words)
    lengths = np.array([1 + len(w) % 3 for w in words], np.int64)
    ids = np.arange(lengths.sum())
    automaton = transducer.Transducer.of(words, lengths, ids)
    assert automaton.numbers(words).tolist() == list(range(len(words)))
    known = {word: i for i, word in enumerate(words)}
    assert automaton.numbers(others).tolist() == [known.get(word, -1) for word in others]
    found, sizes = automaton.ids_of(np.arange(len(words)))
    assert (found.tolist(), sizes.tolist()) == (ids.tolist(), lengths.tolist())


def test_transducer_is_minimal_and_maps(tmp_path):
    words = sorted(a + b for a in (b"un", b"re", b"out") for b in (b"do", b"doing", b"done"))
    automaton = transducer.Transducer.of(words, np.ones(9, np.int64), np.arange(9))
    # One start, the letters of the three beginnings, and one copy of the shared endings.
    assert len(automaton.final) == 1 + 1 + 1 + 2 + 1 + 6
    (tmp_path / "a.bin").write_bytes(automaton.to_bytes())
    mapped = transducer.Transducer.map(str(tmp_path / "a.bin"))
    assert mapped.numbers(words).tolist() == list(range(9))
    assert mapped.ids_of(np.array([3, 8]))[0].tolist() == [3, 8]


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_codec_with_a_small_transducer(texts):
    words = sorted(word.encode() for word in ("a", " the", "日本", "\n"))
    ids, lengths = VOCABULARY.merge(words)
    codec = transducer.Codec(VOCABULARY, transducer.Transducer.of(words, lengths, ids))
    for _ in range(2):
        found, sizes = codec.encode(texts)
        assert found.tolist() == [i for text in texts for i in ids_of(text)]
        assert sizes.tolist() == [len(ids_of(text)) for text in texts]
    for text in texts:
        ids = ids_of(text)
        decoded = VOCABULARY.decode(np.array(ids, np.int64)).decode("utf-8", "replace")
        assert decoded == LIBRARY.decode(ids, skip_special_tokens=False) == text


def test_decoding_of_cut_characters():
    rng = random.Random(4)
    for _ in range(200):
        ids = [rng.randrange(50_257) for _ in range(rng.randint(0, 9))]
        found = VOCABULARY.decode(np.array(ids, np.int64)).decode("utf-8", "replace")
        assert found == LIBRARY.decode(ids, skip_special_tokens=False)


def check_bpe(rows, documents):
    wanted = Counter()
    for doc_id, text in documents:
        ids = ids_of(text)
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        wanted[
            doc_id,
            len(ids),
            hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        ] += 1
    assert Counter(map(tuple, rows)) == wanted


def test_op1(spark, documents, sf_dir):
    check_bpe(op1_transducer_bpe(spark, sf_dir).collect(), documents)


def digests(frame):
    from pyspark.sql import functions as F

    return frame.select("doc_id", "n_tokens", F.sha2("ids", 256), F.sha2("text", 256)).collect()


@pytest.mark.parametrize("most", [1, 50, 2**20])
def test_odd_documents_whatever_the_lexicon_holds(spark, odd_documents, no_documents, most):
    path = transducer.build_transducer(odd_documents, BYTE_BPE, most)
    encoded = transducer.encode_documents(odd_documents, BYTE_BPE, path)
    docs = [(row.doc_id, row.text) for row in odd_documents.collect()]
    check_bpe(digests(transducer.decode_documents(encoded, BYTE_BPE)), docs)
    path = transducer.build_transducer(no_documents, BYTE_BPE, most)
    encoded = transducer.encode_documents(no_documents, BYTE_BPE, path)
    assert transducer.decode_documents(encoded, BYTE_BPE).collect() == []


def check_counts(rows, documents, limit):
    wanted = Counter()
    for doc_id, text in documents:
        n = len(ids_of(text))
        wanted[doc_id, len((text or "").encode()), n, n > limit] += 1
    assert Counter(map(tuple, rows)) == wanted


def test_op9(spark, documents, sf_dir):
    check_counts(op9_pre_token_counts(spark, sf_dir).collect(), documents, 512)


@pytest.mark.parametrize("most", [1, 20, 2**20])
def test_counts_of_odd_documents(spark, odd_documents, no_documents, most):
    docs = [(row.doc_id, row.text) for row in odd_documents.collect()]
    rows = token_counts.count_tokens(odd_documents, BYTE_BPE, 5, most).collect()
    check_counts(rows, docs, 5)
    assert token_counts.count_tokens(no_documents, BYTE_BPE, 5, most).collect() == []
