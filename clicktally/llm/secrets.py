r"""Secrets in texts: fixed patterns, and the entropy of sliding windows over candidate strings.

Everything is a Spark expression of the row.

A candidate is a run of at least ``WINDOW`` characters of keys. A window of so many characters slides
over it, and how often each character stands in it is counted on: one count rises with the character that
enters, one falls with the one that leaves. The sum of ``count * log2(count)`` over the window's characters,
and with it the Shannon entropy, follows from the two counts that change. Hexadecimal runs and runs of
mixed characters have limits of their own. What the allow list matches, such as words, paths and UUIDs, is
no candidate; letters of mixed cases are on it only in the shape of words. A span reaches over all
windows of a candidate above its limit. The time grows with the length of a candidate alone.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktally.llm.expressions import let
from clicktally.llm.places import matches, replaced

# Fixed patterns: a prefix and a value each, and the length that the part named needs.
ASSIGN = (
    r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
    r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?)"""
    r"""([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"()(AKIA[A-Z0-9]+)"
HEX = r"()([0-9a-f]{16,})"
KINDS = {"assign": (ASSIGN, 12), "access": (ACCESS, 18), "hex": (HEX, 16)}

WINDOW = 20
CANDIDATE = r"()([A-Za-z0-9+/_=-]{20,})"
HEX_LIMIT = 3.0
MIXED_LIMIT = 3.7

# A number, or letters in the shape of words: small ones, capitals, a capitalised word, or words run
# together, each with two small letters at least. No group matches in two ways, and the loops keep what
# they matched, so a long candidate takes linear time and no deep stack.
GROUP = r"(?:[A-Z]?[a-z]{2,}(?:[A-Z][a-z]{2,})*+|[A-Z]?[a-z]|[A-Z]+|[0-9]+)"
ALLOWED = (
    # one word, one number
    r"^[A-Z]?[a-z]+$",
    r"^[A-Z]+$",
    r"^[0-9]+$",
    # words run together, and words joined by signs, as in paths and names
    rf"^[/_=+-]*{GROUP}(?:[/_=+-]+{GROUP})*+[/_=+-]*$",
    # a UUID
    r"^[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$",
)

# The characters of candidates. Their counts are numbers of five bits, twelve of them in a long.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
BITS = 5
COUNTS = 12

# ``count * log2(count)`` for each count, in units small enough to add whole numbers without any error.
UNIT = 2**40
WEIGHTS = [0, *(round(count * math.log2(count) * UNIT) for count in range(1, WINDOW + 1))]

# Characters of a candidate that are split at once.
PART = 1024


def _hot_windows(value: Column, limit: Column) -> Column:
    """Start of the first and end of the last window whose entropy reaches the limit, or -1.

    The candidate is read in parts. The state holds the counts, the weighted sum, the places found, the
    number of characters before the part, and the characters of the last window before it.
    """
    weights = F.array(*(F.lit(weight) for weight in WEIGHTS))
    most = (math.log2(WINDOW) - limit) * (WINDOW * UNIT)

    def count(counts: Column, character: Column) -> Column:
        held = F.get(counts, F.floor(character / COUNTS).cast("int"))
        return F.call_function("shiftrightunsigned", held, character % COUNTS * BITS).bitwiseAND(F.lit(31))

    def changed(counts: Column, character: Column, by: int) -> Column:
        one = F.call_function("shiftleft", F.lit(by).cast("long"), character % COUNTS * BITS)
        place = F.floor(character / COUNTS).cast("int")
        return F.transform(counts, lambda held, i: F.when(i == place, held + one).otherwise(held))

    def slide(state: Column, enters: Column, leaves: Column, place: Column) -> Column:
        def added(held: Column) -> Column:
            total = state["sum"] + F.get(weights, (held + 1).cast("int")) - F.get(weights, held.cast("int"))
            counts = changed(state["counts"], enters, 1)

            def removed(counts: Column) -> Column:
                out = count(counts, leaves).cast("int")
                less = total + F.get(weights, out - 1) - F.get(weights, out)
                return F.struct(changed(counts, leaves, -1).alias("counts"), less.alias("sum"))

            kept = F.struct(counts.alias("counts"), total.alias("sum"))
            return F.when(place > WINDOW, let(counts, removed)).otherwise(kept)

        def found(window: Column) -> Column:
            hot = (place >= WINDOW) & (window["sum"] <= most)
            return F.struct(
                window["counts"].alias("counts"),
                window["sum"].alias("sum"),
                F.when(hot & (state["first"] < 0), place - WINDOW).otherwise(state["first"]).alias("first"),
                F.when(hot, place).otherwise(state["last"]).alias("last"),
            )

        return let(let(count(state["counts"], enters), added), found)

    def over(state: Column, part: Column) -> Column:
        """Read one part of the candidate."""

        def of_characters(characters: Column) -> Column:
            held = F.size(state["tail"])

            def step(inner: Column, i: Column) -> Column:
                leaves = F.get(characters, i - WINDOW)
                return slide(inner, F.get(characters, i), leaves, state["at"] + i - held + 1)

            windows = F.aggregate(
                F.sequence(held, F.size(characters) - 1),
                F.struct(*(state[name].alias(name) for name in ("counts", "sum", "first", "last"))),
                step,
            )
            return let(
                windows,
                lambda end: F.struct(
                    end["counts"].alias("counts"),
                    end["sum"].alias("sum"),
                    end["first"].alias("first"),
                    end["last"].alias("last"),
                    (state["at"] + F.length(part)).alias("at"),
                    F.slice(characters, -WINDOW, WINDOW).alias("tail"),
                ),
            )

        codes = F.transform(F.split(part, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
        return let(F.concat(state["tail"], codes), of_characters)

    words = -(-len(ALPHABET) // COUNTS)
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), words).alias("counts"),
        F.lit(0).cast("long").alias("sum"),
        F.lit(-1).alias("first"),
        F.lit(-1).alias("last"),
        F.lit(0).alias("at"),
        F.array().cast("array<int>").alias("tail"),
    )
    parts = F.regexp_extract_all(value, F.lit(f".{{{WINDOW},{PART}}}|.+"), F.lit(0))
    return F.aggregate(parts, start, over)


def _span(start: Column, kind: int, end: Column) -> Column:
    return F.struct(
        start.cast("int").alias("start"), F.lit(kind).alias("kind"), end.cast("int").alias("end")
    )


def _base_spans(text: Column, kind: int, pattern: str, least: int) -> Column:
    long_enough = F.filter(matches(text, pattern), lambda match: F.length(match["value"]) >= least)
    return F.transform(long_enough, lambda match: _span(match["start"], kind, match["end"]))


def _entropy_spans(text: Column) -> Column:
    def suppressed(match: Column) -> Column:
        return reduce(or_, (match["value"].rlike(pattern) for pattern in ALLOWED))

    def hot(match: Column) -> Column:
        limit = F.when(match["value"].rlike("^[0-9A-Fa-f]+$"), HEX_LIMIT).otherwise(MIXED_LIMIT)
        windows = let(limit, lambda held: _hot_windows(match["value"], held))
        return F.struct(match["start"].alias("start"), windows.alias("hot"))

    candidates = F.filter(matches(text, CANDIDATE), lambda match: ~suppressed(match))
    found = F.filter(F.transform(candidates, hot), lambda match: match["hot"]["first"] >= 0)
    return F.transform(
        found,
        lambda match: _span(
            match["start"] + match["hot"]["first"], len(KINDS), match["start"] + match["hot"]["last"]
        ),
    )


def spans(text: Column) -> Column:
    """The spans of a text: start, kind as a number, and end, in that order.

    Kinds are numbered in the order of ``KINDS``, entropy last. Starts and ends count code points, the
    end is not included. A null or empty text has no spans.
    """
    whole = F.coalesce(text, F.lit(""))
    base = [
        _base_spans(whole, kind, pattern, least)
        for kind, (pattern, least) in enumerate(KINDS.values())
    ]
    return F.array_sort(F.concat(*base, _entropy_spans(whole)))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end`` joined by commas."""
    names = F.array(*(F.lit(name) for name in (*KINDS, "entropy")))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def secret_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts and digest of the base spans, and all spans, for every row.

    Repeated rows get a row each, null ids are carried, other columns are left out.
    """

    def count(found: Column, kind: int) -> Column:
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")

    def report(found: Column) -> Column:
        counts = [count(found, kind).alias(f"n_{name}") for kind, name in enumerate(KINDS)]
        base = F.filter(found, lambda s: s["kind"] < len(KINDS))
        return F.struct(
            *counts, F.sha2(written(base), 256).alias("base_sha256"), written(found).alias("spans")
        )

    return docs.select("doc_id", let(spans(F.col("text")), report).alias("found")).select(
        "doc_id", "found.*"
    )


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """Replace the spans of every text by a mask; spans that overlap become one. Null stays null."""
    text = F.col("text")
    return docs.withColumn("text", let(spans(text), lambda found: replaced(text, found, mask)))
