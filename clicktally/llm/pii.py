r"""Personal data in texts: patterns propose, check digits confirm, words nearby decide.

A pattern proposes spans. A validator looks at the digits or letters of a span alone: the Luhn sum of
cards, the remainder by 97 of account numbers, the weighted sum of bank codes, the ranges of addresses and
social security numbers. What it does not confirm is dropped. Each kind then has a score in hundredths,
which rises if one of its words stands nearby, and falls if a word does that speaks against it. Spans of
the base kinds stay whatever their score; those of the other kinds need ``ENOUGH``.

Everything is a Spark expression of the row. Nearby means within ``AROUND`` code points before or after a
span, as far as the next proposal of its kind. No pattern reads a run of characters twice: a run that
failed is not tried again from its middle, so long texts take linear time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktally.llm.expressions import let
from clicktally.llm.places import matches, replaced

AROUND = 48
ENOUGH = 60


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """12 to 19 digits, with one sign between two of them at most, whose Luhn sum is right."""
    digits = _digits(value)
    sized = F.length(digits).between(12, 19)
    return F.when(F.length(value) <= 37, sized & F.call_function("luhn_check", digits)).otherwise(False)


def _phone_digits(value: Column) -> Column:
    return F.length(_digits(value)).between(9, 15)


def _byte_parts(value: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
    return value.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _always(value: Column) -> Column:
    return F.lit(True)


# The length of an account number in each country that has its own.
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
    "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21,
    "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24,
    "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}


def _iban(value: Column) -> Column:
    """The length of its country and the remainder 1 by 97, letters being 10 to 35."""
    lengths = F.create_map(*(F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair))

    def confirmed(compact: Column) -> Column:
        turned = F.concat(F.substring(compact, 5, 64), F.left(compact, F.lit(4)))

        def step(rest: Column, place: Column) -> Column:
            code = F.ascii(F.substring(turned, place, F.lit(1)))
            return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

        rest = F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step)
        sized = F.length(compact) == F.try_element_at(lengths, F.left(compact, F.lit(2)))
        return F.when(sized, rest == 1).otherwise(False)

    return let(F.replace(value, F.lit(" "), F.lit("")), confirmed)


def _social_security(value: Column) -> Column:
    return value.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")


def _bank_code(value: Column) -> Column:
    """Nine digits whose sum with the weights 3, 7 and 1 in turn is a multiple of ten."""

    def weighted(total: Column, place: Column) -> Column:
        weight = F.element_at(F.array(F.lit(3), F.lit(7), F.lit(1)), (place - 1) % 3 + 1)
        return total + weight * (F.ascii(F.substring(value, place, F.lit(1))) - 48)

    return F.aggregate(F.sequence(F.lit(1), F.lit(9)), F.lit(0), weighted) % 10 == 0


@dataclass(frozen=True)
class Kind:
    """One kind of personal data: what proposes it, confirms it, and speaks for and against it."""

    pattern: str
    confirms: Callable[[Column], Column]
    score: int
    words: str
    gain: int
    against: str = "example|sample|dummy"
    loss: int = 20


# A run of local letters begins after another character, or right after the match before.
_EMAIL = (
    r"()((?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)"
)
_IP = r"()((?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++)"
_CARD = r"()([0-9](?:[\x20-]?[0-9])++)"
_PHONE = r"()(\+[0-9][\x20().0-9-]+[0-9])"
# Spans of other kinds do not begin or end within a longer number or word.
_LEFT, _RIGHT = r"(?<![A-Za-z0-9+.(-])", r"(?![A-Za-z0-9]|[.-][0-9])"

BASE = {
    "email": Kind(_EMAIL, _always, 90, "e-?mail|mail|contact|write", 10),
    "ip": Kind(_IP, _byte_parts, 60, "ip|address|host|server|login|client", 30, "version|release|build|section", 40),
    "card": Kind(_CARD, _luhn, 70, "card|visa|mastercard|amex|credit|debit|payment", 30, "isbn|order|tracking", 40),
    "phone": Kind(_PHONE, _phone_digits, 75, "phone|tel|telephone|mobile|cell|call|fax", 25),
}
ADDED = {
    "iban": Kind(
        rf"()({_LEFT}[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}+{_RIGHT})",
        _iban, 85, "iban|account|konto|compte|cuenta|bank", 15,
    ),
    "ssn": Kind(
        rf"()({_LEFT}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_RIGHT})",
        _social_security, 50, "ssn|social security|taxpayer", 40,
    ),
    "local_phone": Kind(
        rf"()({_LEFT}(?<![0-9)]\x20)\(?[0-9]{{3}}\)?[\x20.-][0-9]{{3}}[\x20.-][0-9]{{4}}{_RIGHT})",
        _always, 40, "phone|tel|telephone|mobile|cell|call|fax|telefon|téléphone|teléfono", 35,
    ),
    "bank_code": Kind(rf"()({_LEFT}[0-9]{{9}}{_RIGHT})", _bank_code, 20, "routing|aba|bank code", 60),
}
KINDS = BASE | ADDED


def _nearby(match: Column, words: str) -> Column:
    """Whether a word stands, whole and in letters of either case, to the left or right of a match."""
    pattern = rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{words})(?![\p{{L}}\p{{N}}])"
    return match["left"].rlike(pattern) | match["right"].rlike(pattern)


def _found(text: Column, number: int, kind: Kind) -> Column:
    """Start, number of the kind, end and score of what a kind finds in a text."""

    def scored(match: Column) -> Column:
        score = (
            F.lit(kind.score)
            + F.when(_nearby(match, kind.words), kind.gain).otherwise(0)
            - F.when(_nearby(match, kind.against), kind.loss).otherwise(0)
        )
        return F.struct(
            match["start"].alias("start"),
            F.lit(number).alias("kind"),
            match["end"].alias("end"),
            F.least(F.lit(100), F.greatest(F.lit(0), score)).alias("score"),
        )

    confirmed = F.filter(matches(text, kind.pattern, AROUND), lambda match: kind.confirms(match["value"]))
    found = F.transform(confirmed, scored)
    return found if number < len(BASE) else F.filter(found, lambda s: s["score"] >= ENOUGH)


def spans(text: Column) -> Column:
    """The spans of a text: start, kind as a number, end and score, in that order.

    Kinds are numbered in the order of ``KINDS``. Starts and ends count code points, the end is not
    included. Spans of different kinds may overlap. A null or empty text has none.
    """
    whole = F.coalesce(text, F.lit(""))
    found = [_found(whole, number, kind) for number, kind in enumerate(KINDS.values())]
    return F.array_sort(F.concat(*found))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end`` joined by commas."""
    names = F.array(*(F.lit(name) for name in KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def personal_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts and digest of the base spans, all spans and their scores, for every row.

    Scores are hundredths, joined by commas in the order of the spans. Null and empty texts have no spans,
    repeated rows get a row each, null ids are carried, other columns are left out. A text that holds the
    character of the marks is read as if it held another one of the same kind.
    """

    def count(found: Column, number: int) -> Column:
        return F.size(F.filter(found, lambda s: s["kind"] == number)).cast("long")

    def report(found: Column) -> Column:
        base = F.filter(found, lambda s: s["kind"] < len(BASE))
        return F.struct(
            *(count(found, number).alias(f"n_{name}") for number, name in enumerate(BASE)),
            F.sha2(written(base), 256).alias("base_sha256"),
            written(found).alias("spans"),
            F.array_join(F.transform(found, lambda s: s["score"].cast("string")), ",").alias("scores"),
        )

    return docs.select("doc_id", let(spans(F.col("text")), report).alias("found")).select(
        "doc_id", "found.*"
    )


def mask_personal(docs: DataFrame, mask: str = "[private]") -> DataFrame:
    """Replace the spans of every text by a mask; spans that overlap become one. Null stays null."""
    text = F.col("text")
    return docs.withColumn("text", let(spans(text), lambda found: replaced(text, found, mask)))
