"""Shards, quality rules and secret scans against plain versions; no Python in their plans."""

import hashlib
import math
import random
import re
import string
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clicktally.llm import quality, secrets, sharding
from clicktally.llm.queries import op4_rendezvous_shards, op6_decision_list, op7_entropy_secrets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_shard(doc_id, weights):
    def score(shard):
        key = "" if doc_id is None else str(doc_id)
        digits = int(hashlib.md5(f"{key}#{shard}".encode()).hexdigest()[:13], 16)
        return -weights[shard] / math.log((digits + 0.5) / 16**13)

    return max(range(len(weights)), key=lambda shard: (score(shard), -shard))


def check_shards(rows, documents, weights, grown):
    found = Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in rows)
    wanted = Counter()
    for doc_id, text in documents:
        data = (text or "").encode()
        shards = plain_shard(doc_id, weights), plain_shard(doc_id, grown)
        wanted[(doc_id, len(data) + 1, zlib.crc32(data), *shards)] += 1
    assert found == wanted
    slots = defaultdict(list)
    for row in rows:
        slots[row.shard].append(row.slot)
        assert row.grown_shard in (row.shard, len(weights))
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))


def test_op4(spark, documents, sf_dir):
    rows = op4_rendezvous_shards(spark, sf_dir).collect()
    check_shards(rows, documents, [1.0] * 8, [1.0] * 9)


def test_weighted_shards_of_odd_documents(spark, odd_documents, no_documents):
    rows = sharding.assign_shards(odd_documents, [1.0, 4.0]).collect()
    docs = [(row.doc_id, row.text) for row in odd_documents.collect()]
    check_shards(rows, docs, [1.0, 4.0], [1.0, 4.0, 4.0])
    assert sharding.assign_shards(no_documents, [1.0]).collect() == []
    with pytest.raises(ValueError):
        sharding.assign_shards(odd_documents, [0.0])


def test_shares_follow_weights_and_few_rows_move(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows = sharding.assign_shards(docs, [1.0, 2.0, 1.0]).collect()
    shares = Counter(row.shard for row in rows)
    assert abs(shares[1] / len(rows) - 0.5) < 0.02
    moved = [row for row in rows if row.shard != row.grown_shard]
    assert {row.grown_shard for row in moved} == {3}
    assert abs(len(moved) / len(rows) - 0.2) < 0.02


def plain_statistics(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {
        i + k for i, window in enumerate(windows) if counts[window] > 1 for k in range(8)
    }
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def check_quality(rows, documents):
    wanted = Counter()
    for doc_id, text in documents:
        base = plain_statistics(text)
        wanted[(doc_id, *base, base[0] < 20 or 100 * base[4] > 30 * base[0])] += 1
    assert Counter(tuple(row)[:7] for row in rows) == wanted
    assert not any(row.kept for row in rows if row.base_failed)


def test_op6(spark, documents, sf_dir):
    check_quality(op6_decision_list(spark, sf_dir).collect(), documents)


def test_rules_find_bad_documents_that_they_have_not_seen(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rules = quality.learn_rules(
        quality.labelled_statistics(docs, labels.filter("doc_id % 2 = 0"))
    )
    assert rules.conjunctions
    judged = quality.quality_verdicts(docs, rules).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    rows = judged.collect()
    good = [row.kept for row in rows if row.quality == 1 and not row.base_failed]
    bad = [row.kept for row in rows if row.quality == 0]
    assert sum(good) > 0.98 * len(good)
    assert sum(bad) < 0.15 * len(bad)


@pytest.mark.parametrize("texts", [1, 2000])
def test_rows_of_a_hot_id_are_numbered_by_many_tasks(spark, texts):
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    kept = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        docs = spark.range(3000).selectExpr(
            "if(id < 2000, 7, id) AS doc_id", f"concat('text ', id % {texts}) AS text"
        )
        found = sharding.assign_shards(docs, (1.0,) * 3).withColumn("task", F.spark_partition_id())
        rows = found.collect()
    finally:
        spark.conf.set(setting, kept)
    for shard in range(3):
        own = [row for row in rows if row.shard == shard]
        assert sorted(row.slot for row in own) == list(range(len(own)))
    hot = [row for row in rows if row.doc_id == 7]
    assert len(rows) == 3000 and len(hot) == 2000
    in_order = [(row["size"], row.text_crc32) for row in sorted(hot, key=lambda row: row.slot)]
    assert in_order == sorted(in_order)
    assert max(Counter(row.task for row in hot).values()) < 1200


def test_one_text_of_an_id_teaches(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    single = quality.labelled_statistics(docs, labels)
    held = single[0]["labelled"]
    hot = docs.union(docs.withColumn("doc_id", F.lit(held).cast(docs.schema["doc_id"].dataType)))
    rows = quality.labelled_statistics(hot, labels)
    assert len(rows) == len({row["labelled"] for row in rows})
    assert [r for r in rows if r["labelled"] != held] == [r for r in single if r["labelled"] != held]
    assert rows == quality.labelled_statistics(hot.union(hot).repartition(5), labels)


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 10**6))
def test_statistics_of_repetitive_texts(spark, seed):
    rng = random.Random(seed)
    texts = [
        "".join(rng.choice(["a ", "b ", "c\n", " ", "a b a b ", "|", "A"]) for _ in range(rng.randint(0, 90)))
        for _ in range(60)
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_quality(quality.quality_verdicts(docs, quality.Rules(())).collect(), enumerate(texts))


def test_learned_list_is_one_ordered_conditional(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(900):
        row = {name: rng.random() for name in quality.FEATURES}
        row["bad"] = int(row["symbol_rate"] > 0.7 or (row["repeat_share"] > 0.6 and row["n_words"] < 0.4))
        rows.append(row)
    rules = quality.learn_rules(rows)
    wrong = [row for row in rows if rules.keeps(row) == bool(row["bad"])]
    assert len(wrong) < 0.03 * len(rows)
    frame = spark.createDataFrame(
        [tuple(row[name] for name in quality.FEATURES) for row in rows],
        ", ".join(f"{name} double" for name in quality.FEATURES),
    )
    columns = {name: F.col(name) for name in quality.FEATURES}
    kept = [r[0] for r in frame.select(rules.verdict(columns)).collect()]
    assert kept == [rules.keeps(row) for row in rows]
    assert quality.learn_rules([]).conjunctions == ()


def test_odd_quality(spark, odd_documents, no_documents):
    rules = quality.Rules(((quality.Test("symbol_rate", True, 0.5),),))
    docs = [(row.doc_id, row.text) for row in odd_documents.collect()]
    check_quality(quality.quality_verdicts(odd_documents, rules).collect(), docs)
    assert quality.quality_verdicts(no_documents, rules).collect() == []
    labels = spark.createDataFrame(
        [(1, None, 0), (None, 1, 0), (2, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int"
    )
    rows = quality.labelled_statistics(odd_documents, labels)
    assert all(row["labelled"] == 2 for row in rows)


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ALLOWED = [re.compile(p) for p in secrets.ALLOWED]


def plain_base(text):
    return sorted(
        [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
        + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    )


def plain_entropy(text):
    spans = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        value = m[0]
        if any(p.search(value) for p in ALLOWED):
            continue
        limit = secrets.HEX_LIMIT if re.fullmatch("[0-9A-Fa-f]+", value) else secrets.MIXED_LIMIT
        hot = []
        for i in range(len(value) - 19):
            counts = Counter(value[i : i + 20]).values()
            entropy = math.log2(20) - sum(c * math.log2(c) for c in counts) / 20
            if entropy >= limit - 1e-9:
                hot.append(i)
        if hot:
            spans.append((m.start() + hot[0], 3, m.start() + hot[-1] + 20))
    return spans


def written(spans):
    names = ("assign", "access", "hex", "entropy")
    return ",".join(f"{names[kind]}:{start}:{end}" for start, kind, end in spans)


def check_secrets(rows, documents):
    wanted = Counter()
    for doc_id, text in documents:
        base = plain_base(text or "")
        counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
        digest = hashlib.sha256(written(base).encode()).hexdigest()
        spans = written(sorted(base + plain_entropy(text or "")))
        wanted[(doc_id, *counts, digest, spans)] += 1
    assert Counter(map(tuple, rows)) == wanted


def test_op7(spark, documents, sf_dir):
    check_secrets(op7_entropy_secrets(spark, sf_dir).collect(), documents)


PARTS = [
    "password", "PassWD", "secret", "Token", "api_key", "apikey", "ſecret", ":", "=", " = ", '"', "'",
    " ", "\n", "AKIA", "ABCDEFGH12345678", "AKIAABCDEFGHIJKLMN", "0123456789abcdef", "deadbeef", "DEAD",
    "x9Kq2LmZ7", "Tr4Vw8Yp", "hello-world", "é", "😀", "﷐", "/usr/local/share/dictionary", ".", "==",
    "123e4567-e89b-12d3-a456-426614174000", "abcdefghijklmnopqrstuvwxyz",
]


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(9)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(1500)]
    texts.append(" ".join(f"token={i:024x}" for i in range(700)))
    return list(enumerate(texts))


def test_planted_secrets(spark, planted):
    docs = spark.createDataFrame(planted, "doc_id long, text string")
    check_secrets(secrets.secret_spans(docs).collect(), planted)


def test_keys_without_digits(spark):
    keys = ["QzXvKpWmTjRbNcYdHsLg", "kWqz-xTbR-0193-pLvJ-QmZd", "hKqVbZrTnXwYmLdPcGsF/jWtQ", "aBcDeFgHiJkLmNoPqRsT"]
    words = [
        "/usr/local/share/dictionary", "severalWordsRunTogetherHere", "AbstractReader/LargeFactory",
        "A-Tale-of-Two-Cities-by-Dickens", "LOUD_NAME_OF_CONSTANT_42", "abcdefghijklmnopqrstuvwxyz",
        "one-two/" * 5000 + "three",
    ]
    docs = spark.createDataFrame(
        [(i, f"say {text} now") for i, text in enumerate(keys + words)], "doc_id long, text string"
    )
    found = {row.doc_id: row.spans for row in secrets.secret_spans(docs).collect()}
    assert found == {
        i: f"entropy:4:{4 + len(text)}" if i < len(keys) else "" for i, text in enumerate(keys + words)
    }
    masked = {row.doc_id: row.text for row in secrets.redact(docs).collect()}
    assert all(masked[i] == "say [secret] now" for i in range(len(keys)))


def fast_entropy(value, limit):
    """Start of the first and end of the last hot window, with counts from sums over the whole text."""
    codes = np.frombuffer(value.encode(), np.uint8)
    total = np.zeros(len(value) - 19)
    for code in np.unique(codes):
        so_far = np.concatenate([[0], np.cumsum(codes == code)])
        count = (so_far[20:] - so_far[:-20]).astype(float)
        total += np.where(count > 1, count * np.log2(np.maximum(count, 1)), 0)
    hot = np.flatnonzero(math.log2(20) - total / 20 >= limit - 1e-9)
    return (int(hot[0]), int(hot[-1]) + 20) if len(hot) else None


@pytest.mark.parametrize("letters", ["base64", "hex", "dull"])
def test_long_candidates_take_linear_time(spark, letters):
    rng = random.Random(letters)
    digits = "0123456789ABCDEF"
    alphabet = {"base64": string.ascii_letters + string.digits + "+/", "hex": digits, "dull": "aB1"}[letters]
    # The ends are dull, so that spans do not simply reach over the whole candidate.
    dull = "A1" * 1500
    docs = [(n, f"see {dull}{''.join(rng.choices(alphabet, k=n))}{dull} end") for n in (50, 200_000, 1_000_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    started = time.monotonic()
    found = {row.doc_id: row.spans for row in secrets.secret_spans(frame).collect()}
    assert time.monotonic() - started < 60
    limit = secrets.HEX_LIMIT if letters == "hex" else secrets.MIXED_LIMIT
    for n, text in docs:
        span = fast_entropy(text.split()[1], limit)
        windows = [s for s in found[n].split(",") if s.startswith("entropy")]
        assert windows == ([f"entropy:{4 + span[0]}:{4 + span[1]}"] if span else [])
        assert bool(span) == (letters != "dull")


def test_many_spans_are_masked_in_linear_time(spark):
    text = " ".join(f"token={i:024x} é" for i in range(20_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    started = time.monotonic()
    (row,) = secrets.redact(docs).collect()
    assert time.monotonic() - started < 20
    assert row.text == " ".join(["[secret] é"] * 20_000)


def test_redaction(spark, planted):
    docs = spark.createDataFrame(planted, "doc_id long, text string")
    redacted = {row.doc_id: row.text for row in secrets.redact(docs, "*").collect()}
    for doc_id, text in planted:
        at, out = 0, ""
        for start, _, end in sorted(plain_base(text) + plain_entropy(text)):
            if start >= at:
                out += text[at:start] + "*"
            at = max(at, end)
        assert redacted[doc_id] == out + text[at:]


def test_odd_secrets(spark, odd_documents, no_documents):
    docs = [(row.doc_id, row.text) for row in odd_documents.collect()]
    check_secrets(secrets.secret_spans(odd_documents).collect(), docs)
    assert secrets.secret_spans(no_documents).collect() == []
    clean = secrets.redact(odd_documents)
    assert clean.columns == odd_documents.columns
    assert clean.count() == odd_documents.count()
    assert clean.filter("text is null").count() == odd_documents.filter("text is null").count()


@pytest.mark.parametrize("query", [op4_rendezvous_shards, op6_decision_list, op7_entropy_secrets])
def test_plans_hold_no_python(spark, sf_dir, query):
    plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
