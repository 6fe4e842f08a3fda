"""Quality rules learned as a decision list over statistics of a text.

The statistics are Spark expressions of the row. ``learn_rules`` takes the statistics of labelled
documents and covers the bad ones rule by rule: a rule grows by the threshold test that gains most on
two thirds of the rows, is pruned on the last third as long as that makes it more precise there, and is
kept if it is precise enough; the rows it covers are set aside for the next one. What no rule covers
is kept. ``Rules.verdict`` is the list as one ordered Spark conditional.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktally.llm.expressions import let

SPACE = " \t\n\x0b\x0c\r"
NO_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MARKS = "!?"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8

# Labelled documents from which the rules are learned, those of the smallest hashed ids.
SAMPLE = 8000

FEATURES = (
    "symbol_rate",
    "capital_rate",
    "mark_rate",
    "repeat_share",
    "dup_line_share",
    "distinct_share",
    "word_length",
    "n_words",
)


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _repeated_words(hashes: Column) -> Column:
    """Words in windows that occur at least twice, from the hashes of the words in order."""
    windows = F.when(
        F.size(hashes) >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(1))),
            lambda start: F.xxhash64(F.slice(hashes, start, WINDOW)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def repeated_places(ordered: Column) -> Column:
        same = lambda w, k: (F.get(ordered, k - 1)["h"] == w["h"]) | (
            F.get(ordered, k + 1)["h"] == w["h"]
        )
        return F.array_sort(F.transform(F.filter(ordered, same), lambda w: w["i"]))

    def covered(places: Column) -> Column:
        return F.aggregate(
            F.transform(
                places,
                lambda place, k: F.least(
                    F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - place, F.lit(WINDOW))
                ),
            ),
            F.lit(0),
            lambda total, more: total + more,
        )

    def of_windows(found: Column) -> Column:
        ordered = F.array_sort(
            F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        return F.when(
            F.size(F.array_distinct(found)) < F.size(found),
            let(let(ordered, repeated_places), covered),
        ).otherwise(0)

    return let(windows, of_windows)


def statistics(text: Column) -> Column:
    """The counts of a text as a struct; a null text has no words.

    Windows of eight words are compared by 64-bit hashes of the words' hashes. A text in which no
    window occurs twice, seen from the number of different hashes, needs no sorting; else the windows
    are sorted by hash and place, and the words of those equal to a neighbour are counted once each.
    """
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(F.btrim(whole, F.lit(SPACE)), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(NO_SPACE))

    def counts(hashes: Column, lines: Column) -> Column:
        values = {
            "n_words": F.size(hashes),
            "word_chars": _without(whole, SPACE),
            "n_symbols": F.length(whole) - _without(whole, SYMBOLS),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": _repeated_words(hashes),
            "n_lines": F.size(lines),
            "n_capitals": F.length(whole) - _without(whole, CAPITALS),
            "n_marks": F.length(whole) - _without(whole, MARKS),
            "n_distinct": F.size(F.array_distinct(hashes)),
        }
        return F.struct(*(value.cast("long").alias(name) for name, value in values.items()))

    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda hashes: let(lines, lambda found: counts(hashes, found)),
    )


def features(counts: Column) -> dict[str, Column]:
    """The numbers that rules test, by name; shares of nothing are 0."""

    def share(part: str, whole: str) -> Column:
        return counts[part].cast("double") / F.greatest(counts[whole], F.lit(1))

    return {
        "symbol_rate": share("n_symbols", "word_chars"),
        "capital_rate": share("n_capitals", "word_chars"),
        "mark_rate": share("n_marks", "word_chars"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "distinct_share": share("n_distinct", "n_words"),
        "word_length": share("word_chars", "n_words"),
        "n_words": counts["n_words"].cast("double"),
    }


def base_failed(counts: Column) -> Column:
    return (counts["n_words"] < 20) | (100 * counts["n_repeat_words"] > 30 * counts["n_words"])


@dataclass(frozen=True)
class Test:
    """A feature against a threshold: above it, or not above it."""

    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return (row[self.feature] > self.threshold) == self.above

    def condition(self, columns: dict[str, Column]) -> Column:
        value = columns[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.4g}"


@dataclass(frozen=True)
class Rules:
    """Conjunctions that reject, in order; a text that none covers is kept."""

    conjunctions: tuple[tuple[Test, ...], ...]

    def verdict(self, columns: dict[str, Column]) -> Column:
        """Whether a text is kept, as one conditional with a branch for each rule."""
        chain = None
        for conjunction in self.conjunctions:
            condition = F.lit(True)
            for test in conjunction:
                condition = condition & test.condition(columns)
            chain = (F if chain is None else chain).when(condition, F.lit(False))
        return F.lit(True) if chain is None else chain.otherwise(F.lit(True))

    def keeps(self, row: dict) -> bool:
        return not any(all(test.holds(row) for test in tests) for tests in self.conjunctions)

    def __str__(self) -> str:
        return "\n".join(
            "reject if " + " and ".join(map(str, tests)) for tests in self.conjunctions
        )


def _counts(rows: Sequence[dict], tests: Sequence[Test]) -> tuple[int, int]:
    covered = [row["bad"] for row in rows if all(test.holds(row) for test in tests)]
    return sum(covered), len(covered) - sum(covered)


def _best_test(rows: Sequence[dict], names: Sequence[str], cuts: int) -> tuple[float, Test | None]:
    """The test with the largest information gain over the bad rows that it still covers."""
    bad = sum(row["bad"] for row in rows)
    before = math.log2(bad / len(rows))
    best, chosen = 0.0, None
    for name in names:
        ordered = sorted((row[name], row["bad"]) for row in rows)
        bad_below = 0
        step = max(1, len(ordered) // cuts)
        for place, (value, is_bad) in enumerate(ordered[:-1], 1):
            bad_below += is_bad
            following = ordered[place][0]
            inner = 3 * step < place < len(rows) - 3 * step
            if value == following or (inner and place % step):
                continue
            threshold = (value + following) / 2
            for above, hits, size in (
                (False, bad_below, place),
                (True, bad - bad_below, len(rows) - place),
            ):
                if hits and (gain := hits * (math.log2(hits / size) - before)) > best + 1e-9:
                    best, chosen = gain, Test(name, above, threshold)
    return best, chosen


def learn_rules(
    rows: Sequence[dict],
    names: Sequence[str] = FEATURES,
    precision: float = 0.9,
    support: int = 8,
    most_rules: int = 12,
    most_tests: int = 4,
    cuts: int = 256,
) -> Rules:
    """Rules from rows that hold the features and ``bad``; every third row prunes.

    A rule must be right about ``precision`` of what it covers, on the growing and on the pruning rows
    together, and cover ``support`` rows. Without bad rows there are no rules.
    """
    left, rules = list(rows), []
    while len(rules) < most_rules:
        grow = [row for place, row in enumerate(left) if place % 3]
        prune = left[::3]
        tests: list[Test] = []
        covered = grow
        while len(tests) < most_tests and 0 < sum(row["bad"] for row in covered) < len(covered):
            _, test = _best_test(covered, names, cuts)
            if test is None:
                break
            tests.append(test)
            covered = [row for row in covered if test.holds(row)]
        if not tests:
            break

        def worth(part: Sequence[Test], prune: Sequence[dict] = prune) -> float:
            bad, good = _counts(prune, part)
            return (bad - good) / (bad + good) if bad + good else -1.0

        length = max(range(1, len(tests) + 1), key=lambda n: (worth(tests[:n]), -n))
        tests = tests[:length]
        bad, good = _counts(left, tests)
        if bad + good < support or bad < precision * (bad + good):
            break
        rules.append(tuple(tests))
        left = [row for row in left if not all(test.holds(row) for test in tests)]
    return Rules(tuple(rules))


def labelled_statistics(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[dict]:
    """Features and ``bad`` of at most ``sample`` labelled documents, by the order of hashed ids.

    The labels are chosen before the texts are read, so only chosen texts are measured. Of several rows
    of one id the text with the smallest hash teaches, taken by every task before the shuffle. A label
    without quality, and a document that fails the base rules anyway, teach nothing.
    """
    chosen = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("labelled"))
        .agg(F.min("quality").alias("label"))
        .orderBy(F.xxhash64("labelled"), "labelled")
        .limit(sample)
    )
    found = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
        .groupBy("labelled", "label")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    )
    measured = let(
        statistics(F.col("text")),
        lambda counts: F.struct(
            base_failed(counts).alias("failed"),
            *(value.alias(name) for name, value in features(counts).items()),
        ),
    )
    collected = found.select(
        "labelled", (F.col("label") == 0).cast("int").alias("bad"), measured.alias("measured")
    ).collect()
    rows = [
        {"labelled": row.labelled, "bad": row.bad, **row.measured.asDict()}
        for row in collected
        if not row.measured.failed
    ]
    return sorted(rows, key=lambda row: ((row["labelled"] * 2654435761) % 2**32, *row.values()))


def judged(text: Column, rules: Rules) -> Column:
    """The counts of a text as a struct with ``base_failed`` and ``kept``."""
    return let(
        statistics(text),
        lambda counts: F.struct(
            counts.alias("counts"),
            base_failed(counts).alias("base_failed"),
            (~base_failed(counts) & rules.verdict(features(counts))).alias("kept"),
        ),
    )


def quality_verdicts(docs: DataFrame, rules: Rules) -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed`` and ``kept`` for every row.

    A null text has no words and fails. Repeated rows get a row each, null ids are carried, and
    other columns are left out.
    """
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = docs.select("doc_id", judged(F.col("text"), rules).alias("judged"))
    return found.select(
        "doc_id",
        *(F.col(f"judged.counts.{name}") for name in base),
        "judged.base_failed",
        "judged.kept",
    )


def drop_poor(docs: DataFrame, rules: Rules) -> DataFrame:
    """The rows whose text is kept, with all their columns."""
    return docs.filter(judged(F.col("text"), rules)["kept"])
