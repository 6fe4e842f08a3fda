"""Severity of toxic texts by cumulative-link ordinal regression.

The labels only tell toxic from not, so the grades are made from them: 0 for the others, and for toxic
ones 1 to 3 by how dense the features are that tell the toxic apart in the sample, cut at the terciles.
The model has one weight for each feature, shared by all grades, and one threshold for each grade:
``P(grade >= g) = sigmoid(weights . x - threshold[g])``. The expected severity is the sum of these
probabilities. A feature is ``log(1 + occurrences among 100 words)`` of a word or of a beginning of
words, which catches what is inflected. A word is a run of letters of any script, so where a script puts
no space between words it is a whole phrase.

The features come from a chi-squared test on a sample of labelled documents, counted by Spark; the
model is fitted on the driver to the features of the same sample, both of a size that a parameter
bounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktally.llm.chunks import blocks

# Labelled documents of the sample, those of the smallest hashed ids, and features of the model.
SAMPLE = 8000
FEATURES = 512

# The chi-squared statistic that a feature needs, and the grades above 0.
SIGNIFICANCE = 20.0
GRADES = 3

# Beginnings of words that are features beside the words, and words whose features are remembered.
BEGINNINGS = (4, 5, 6, 7)
REMEMBERED = 100_000

# Letters of any script with their marks; the pattern splits words the same way in Java and in Python.
WORD = r"\p{L}[\p{L}\p{M}]*"
_WORD = regex.compile(WORD)


class Lexicon(dict):
    """The numbers of the features of a word: itself and its beginnings, if the model has them."""

    def __init__(self, chosen: tuple[str, ...]):
        super().__init__()
        self.numbers = {feature: i for i, feature in enumerate(chosen)}

    def __missing__(self, word: str) -> list[int]:
        if len(self) >= REMEMBERED:
            self.clear()
        parts = [word, *(f"^{word[:size]}" for size in BEGINNINGS if len(word) >= size)]
        self[word] = found = [self.numbers[part] for part in parts if part in self.numbers]
        return found


def feature_counts(text: str | None, lexicon: Lexicon) -> tuple[dict[int, int], int]:
    """How often the chosen features occur in a text, by number, and how many words it has."""
    words = _WORD.findall((text or "").lower())
    counts: dict[int, int] = {}
    for found in filter(None, map(lexicon.__getitem__, words)):
        for number in found:
            counts[number] = counts.get(number, 0) + 1
    return counts, len(words)


def features(rows: list[tuple[dict[int, int], int]], width: int) -> np.ndarray:
    """One row of ``log(1 + occurrences among 100 words)`` for each text."""
    out = np.zeros((len(rows), width))
    for place, (counts, total) in enumerate(rows):
        for number, count in counts.items():
            out[place, number] = np.log1p(100 * count / total)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


@dataclass(frozen=True)
class OrdinalModel:
    """Weights of features and ascending thresholds of grades."""

    features: tuple[str, ...]
    weights: np.ndarray
    thresholds: np.ndarray

    def reached(self, x: np.ndarray) -> np.ndarray:
        """The probability of every grade above 0 or a higher one."""
        return sigmoid((x @ self.weights)[:, None] - self.thresholds)


def fit_ordinal(
    x: np.ndarray, grades: np.ndarray, penalty: float = 1.0, steps: int = 600
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximise the cumulative-link likelihood.

    A grade that all or none of the rows reach counts as if half a row did otherwise. The thresholds are a first one and positive steps, so they stay in order; the weights carry an L2
    penalty. Adam runs for a fixed number of steps from fixed starts, so the fit repeats.
    """
    levels = int(max(grades.max(initial=0), 1))
    rates = np.array([(grades >= g).mean() for g in range(1, levels + 1)])
    rates = np.clip(rates, 0.5 / len(grades), 1 - 0.5 / len(grades))
    start = np.log((1 - rates) / rates)
    gaps = np.log(np.maximum(np.diff(start), 0.05))
    parameters = np.concatenate([np.zeros(x.shape[1]), start[:1], gaps])
    mean, square = np.zeros_like(parameters), np.zeros_like(parameters)
    width = x.shape[1]
    places = np.arange(len(grades))
    for step in range(1, steps + 1):
        weights, first, steps_up = parameters[:width], parameters[width], np.exp(parameters[width + 1 :])
        thresholds = first + np.concatenate([[0.0], np.cumsum(steps_up)])
        reached = sigmoid((x @ weights)[:, None] - thresholds)
        bounds = np.concatenate([np.ones((len(x), 1)), reached, np.zeros((len(x), 1))], axis=1)
        likely = np.maximum(bounds[places, grades] - bounds[places, grades + 1], 1e-9)
        slopes = bounds * (1 - bounds)
        score = -(slopes[places, grades] - slopes[places, grades + 1]) / likely
        by_threshold = np.zeros_like(thresholds)
        for grade in range(1, levels + 1):
            at, below = grades == grade, grades == grade - 1
            by_threshold[grade - 1] = (slopes[at, grade] / likely[at]).sum() - (
                slopes[below, grade] / likely[below]
            ).sum()
        gradient = np.concatenate(
            [
                x.T @ score + penalty * weights,
                [by_threshold.sum()],
                [by_threshold[g:].sum() * steps_up[g - 1] for g in range(1, levels)],
            ]
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        rate = 0.1 * min(1.0, 3 * (1 - step / (steps + 1)))
        parameters = parameters - rate * (mean / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.999**step)) + 1e-8
        )
    thresholds = parameters[width] + np.concatenate([[0.0], np.cumsum(np.exp(parameters[width + 1 :]))])
    return parameters[:width], thresholds


def severity_grades(toxic: np.ndarray, density: np.ndarray) -> np.ndarray:
    """Grade 0 for what is not toxic, and 1 to 3 by the terciles of density among the toxic."""
    known = density[(toxic == 1) & (density > 0)]
    cuts = np.quantile(known, [1 / 3, 2 / 3]) if len(known) else np.zeros(2)
    return np.where(toxic == 1, 1 + (density[:, None] > cuts).sum(1), 0).astype(np.int64)


def _words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _features_of(words: Column) -> Column:
    beginnings = [
        F.transform(
            F.filter(words, lambda w: F.length(w) >= size),
            lambda w: F.concat(F.lit("^"), F.substring(w, 1, size)),
        )
        for size in BEGINNINGS
    ]
    return F.concat(words, *beginnings)


def _sketch(words: Column) -> Column:
    """The smallest hash of three words in a row, which near copies mostly share."""
    last = F.greatest(F.size(words) - 2, F.lit(1))
    return F.array_min(
        F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, 3)))
    )


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most_features: int = FEATURES
) -> OrdinalModel:
    """The model of at most ``sample`` labelled documents and ``most_features`` features.

    Of several rows of one id the text with the smallest hash teaches, taken by every task before the
    shuffle. Of documents that share their smallest hash of three words, as copies do, one teaches, so that
    the label of a much copied text counts once. Labels without id or verdict are left out, of several
    for one id the highest counts. Without toxic and other documents the model has no features and
    gives the rate of the labels.
    """
    spark = docs.sparkSession
    chosen = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("labelled"))
        .agg(F.max("toxic").alias("label"))
        .orderBy(F.xxhash64("labelled"), "labelled")
        .limit(sample)
    )
    texts = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
        .groupBy("labelled", "label")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    )
    words = _words_of(F.col("text"))
    labelled = texts.select("labelled", "label", words.alias("words")).checkpoint()
    # Teachers are told by two numbers a row, whose smallest a task takes before the shuffle; the words
    # stay where they are.
    teachers = (
        labelled.select("labelled", _sketch(F.col("words")).alias("sketch"))
        .groupBy("sketch")
        .agg(F.min("labelled").alias("labelled"))
    )
    found = labelled.join(teachers.select("labelled"), "labelled", "left_semi").checkpoint()
    totals = found.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic"))
    n, toxic = (float(value) for value in totals.first())
    a, b = F.col("in_toxic"), F.col("in_all") - F.col("in_toxic")
    numerator = n * F.pow(a * (n - toxic) - b * toxic, F.lit(2))
    spread = toxic * (n - toxic) * F.col("in_all") * (n - F.col("in_all"))
    every = found.withColumn("feature", F.explode(_features_of(F.col("words"))))
    counted = every.groupBy("feature", "labelled", "label").agg(F.count("*").alias("times"))
    telling = (
        counted.groupBy("feature")
        .agg(
            F.count("*").cast("double").alias("in_all"),
            F.sum("label").cast("double").alias("in_toxic"),
        )
        .filter((F.col("in_all") >= 5) & (F.col("in_all") < n))
        .withColumn("chi2", numerator / F.greatest(spread, F.lit(1.0)))
        .filter(F.col("chi2") >= SIGNIFICANCE)
        .orderBy(F.desc("chi2"), "feature")
        .limit(most_features)
        .select("feature", (a * (n - toxic) > b * toxic).alias("positive"))
    ).checkpoint()
    chosen_rows = telling.collect()
    chosen_features = tuple(row.feature for row in chosen_rows)
    positive = {i for i, row in enumerate(chosen_rows) if row.positive}
    telling = spark.createDataFrame(
        list(enumerate(chosen_features)), "number int, feature string"
    )
    held = (
        counted.join(F.broadcast(telling), "feature")
        .groupBy("labelled")
        .agg(F.collect_list(F.struct("number", F.col("times").cast("int").alias("times"))).alias("held"))
    )
    # Two lists of numbers for each of the sample, no longer than the features.
    rows = (
        found.select("labelled", "label", F.size("words").alias("total"))
        .join(held, "labelled", "left")
        .select("labelled", "label", "total", "held.number", "held.times")
        .orderBy("labelled")
        .collect()
    )
    if not rows:
        return OrdinalModel((), np.zeros(0), np.full(GRADES, np.inf))
    x = np.zeros((len(rows), len(chosen_features)))
    density = np.zeros(len(rows))
    for place, row in enumerate(rows):
        times = np.array(row.times or [], np.float64)
        x[place, row.number or []] = np.log1p(100 * times / max(row.total, 1))
        density[place] = times[np.isin(row.number or [], list(positive))].sum() / max(row.total, 1)
    grades = severity_grades(np.array([row.label for row in rows]), density)
    weights, thresholds = fit_ordinal(x, grades)
    return OrdinalModel(chosen_features, weights, thresholds)


SEVERITY = "doc_id long, expected_severity double, grade int, toxic_probability double, rejected boolean"


_lexicons: dict[tuple[str, ...], Lexicon] = {}


def _judge(model: OrdinalModel, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The probabilities of the grades, and which texts are toxic rather than not."""
    lexicon = _lexicons.get(model.features)
    if lexicon is None:
        lexicon = _lexicons[model.features] = Lexicon(model.features)
    counts = [feature_counts(text, lexicon) for text in texts]
    reached = model.reached(features(counts, len(model.features)))
    return reached, reached[:, 0] >= 0.5


def severities(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """Expected severity, most likely grade and verdict for every row of ``doc_id`` and ``text``.

    A null or empty text has no features. Repeated rows get a row each, null ids are carried, other
    columns are left out.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                reached, rejected = _judge(model, block.column("text").to_pylist())
                ends = np.ones((len(reached), 1)), np.zeros((len(reached), 1))
                each = -np.diff(np.concatenate([ends[0], reached, ends[1]], axis=1), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("doc_id"),
                        pa.array(np.round(reached.sum(1), 6)),
                        pa.array(each.argmax(1).astype(np.int32)),
                        pa.array(np.round(reached[:, 0], 6)),
                        pa.array(rejected),
                    ],
                    [field.split()[0] for field in SEVERITY.split(", ")],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        score, SEVERITY
    )


def drop_toxic(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The rows whose text is not toxic, with all their columns."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                _, rejected = _judge(model, block.column("text").to_pylist())
                yield block.filter(pa.array(~rejected))

    return docs.mapInArrow(keep, docs.schema)
