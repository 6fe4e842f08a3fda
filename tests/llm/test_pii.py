"""Personal data against a plain version; no Python in the plan."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest

from clicktally.llm import pii
from clicktally.llm.queries import op11_personal_data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def iban(value):
    value = value.replace(" ", "")
    if len(value) != pii.IBAN_LENGTHS.get(value[:2]):
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def confirmed(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(part) <= 255 for part in value.split(".")),
        "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
        "iban": lambda: iban(value),
        "ssn": lambda: digits[:3] not in ("000", "666") and value[0] != "9"
        and digits[3:5] != "00" and digits[5:] != "0000",
        "local_phone": lambda: True,
        "bank_code": lambda: sum(int(d) * w for d, w in zip(digits, (3, 7, 1) * 3)) % 10 == 0,
    }[kind]()


def plain_spans(text):
    found = []
    for number, (name, kind) in enumerate(pii.KINDS.items()):
        pattern = BASE.get(name) or kind.pattern.removeprefix("()")
        hits = list(re.finditer(pattern, text))
        for k, hit in enumerate(hits):
            if not confirmed(name, hit[0]):
                continue
            left = text[max(hits[k - 1].end() if k else 0, hit.start() - pii.AROUND) : hit.start()]
            next_start = hits[k + 1].start() if k + 1 < len(hits) else len(text)
            right = text[hit.end() : min(next_start, hit.end() + pii.AROUND)]

            def nearby(words):
                whole = rf"(?i)(?<![^\W_])(?:{words})(?![^\W_])"
                return any(re.search(whole, part) for part in (left, right))

            score = kind.score + nearby(kind.words) * kind.gain - nearby(kind.against) * kind.loss
            score = min(100, max(0, score))
            if name in BASE or score >= pii.ENOUGH:
                found.append((hit.start(), number, hit.end(), score))
    return sorted(found)


def written(spans):
    names = list(pii.KINDS)
    return ",".join(f"{names[kind]}:{start}:{end}" for start, kind, end, _ in spans)


def plain_row(doc_id, text):
    found = plain_spans(text or "")
    base = [span for span in found if span[1] < 4]
    counts = [sum(span[1] == kind for span in base) for kind in range(4)]
    digest = hashlib.sha256(written(base).encode()).hexdigest()
    return doc_id, *counts, digest, written(found), ",".join(str(span[3]) for span in found)


def check(rows, documents):
    assert Counter(map(tuple, rows)) == Counter(plain_row(*doc) for doc in documents)


def test_op11(spark, documents, sf_dir):
    check(op11_personal_data(spark, sf_dir).collect(), documents)


PARTS = [
    "a.b@mail.example.com", "x@y", "me@host.de.", "@", "_", "%+-", ".", "1.2.3.4", "256.1.1.1", "10.0.0.255",
    "0001.02.003.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "378282246310005", "0000000000000",
    "+1 (743) 555-3824", "+49 30 123456", "+1", "+12345678901234567890", "DE89 3704 0044 0532 0130 00",
    "GB82WEST12345698765432", "DE88370400440532013000", "FR14 2004 1010 0505 0001 3M02 606", "XX12 3456 7890 1234",
    "123-45-6789", "000-12-3456", "212 555 0123", "(212) 555-0123", "212.555.0123", "021000021", "021000022",
    "phone", "Tel", "call me", "ip address", "version", "card", "order", "SSN", "routing", "ABA", "example",
    "konto", "teléfono", "callous", " ", " ", " ", ", ", "\n", ": ", "-", "é", "😀", "﷐", "7", "abc", "A1",
]


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(11)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 16))) for _ in range(2500)]
    texts += [" ".join(rng.choices(PARTS, k=rng.randint(2, 12))) for _ in range(1500)]
    return list(enumerate(texts))


def test_planted_data(spark, planted):
    docs = spark.createDataFrame(planted, "doc_id long, text string")
    rows = pii.personal_spans(docs).collect()
    check(rows, planted)
    kinds = Counter(span.split(":")[0] for row in rows for span in row.spans.split(",") if span)
    assert set(kinds) == set(pii.KINDS)


def test_words_nearby_decide(spark):
    texts = ["call 212 555 0123", "grid 212 555 0123", "call x" + " " * 48 + "212 555 0123", "1.2.3.4 release"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {row.doc_id: (row.spans, row.scores) for row in pii.personal_spans(docs).collect()}
    assert found[0] == ("local_phone:5:17", "75")
    assert found[1] == found[2] == ("", "")
    assert found[3] == ("ip:0:7", "20")


def test_masks(spark, planted):
    docs = spark.createDataFrame(planted, "doc_id long, text string")
    masked = {row.doc_id: row.text for row in pii.mask_personal(docs, "*").collect()}
    for doc_id, text in planted:
        at, out = 0, ""
        for start, _, end, _ in plain_spans(text):
            if start >= at:
                out += text[at:start] + "*"
            at = max(at, end)
        assert masked[doc_id] == out + text[at:]


@pytest.mark.parametrize(
    "text",
    ["a" * 1_000_000, "1" * 1_000_000, "1 " * 500_000, "a@" * 500_000, "+1" * 500_000, "1." * 300_000,
     "me@host.de " * 50_000, "+1 555 555 5555, " * 40_000, "AB12 " * 200_000, "+1" + "(" * 1_000_000],
    ids=lambda text: text[:6],
)
def test_long_texts_take_linear_time(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    started = time.monotonic()
    (row,) = pii.personal_spans(docs).collect()
    assert time.monotonic() - started < 30
    counts = {"1.": 75_000, "me": 50_000, "+1 ": 40_000}
    wanted = next((n for start, n in counts.items() if text.startswith(start)), 0)
    assert row.n_email + row.n_ip + row.n_phone + row.n_card == wanted


def test_odd_documents(spark, odd_documents, no_documents):
    check(pii.personal_spans(odd_documents).collect(), [(r.doc_id, r.text) for r in odd_documents.collect()])
    assert pii.personal_spans(no_documents).collect() == []
    masked = pii.mask_personal(odd_documents)
    assert masked.columns == odd_documents.columns
    assert masked.count() == odd_documents.count()
    assert masked.filter("text is null").count() == odd_documents.filter("text is null").count()


def test_plan_holds_no_python(spark, sf_dir):
    plan = op11_personal_data(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
