"""The ordinal model: its gradient, its fit and held-out accuracy."""

import math
import re
from collections import Counter

import numpy as np
import pytest
import regex

from clicktally.llm import queries, toxicity
from clicktally.llm.queries import op5_ordinal_toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels")]


def test_thresholds_are_ordered_and_weights_shared():
    rng = np.random.default_rng(2)
    x = rng.random((4000, 3))
    latent = x @ np.array([4.0, -3.0, 0.0]) + rng.logistic(size=4000)
    grades = (latent[:, None] > np.array([0.0, 1.0, 2.5])).sum(1)
    weights, thresholds = toxicity.fit_ordinal(x, grades, penalty=0.01, steps=1500)
    assert np.allclose(weights, [4.0, -3.0, 0.0], atol=0.35)
    assert np.allclose(thresholds, [0.0, 1.0, 2.5], atol=0.25)
    reached = toxicity.OrdinalModel(("a", "b", "c"), weights, thresholds).reached(x)
    assert (np.diff(reached, axis=1) <= 0).all()


def test_features_follow_the_words():
    lexicon = toxicity.Lexicon(("idiot", "^idio", "mot"))
    counts, total = toxicity.feature_counts("Idiot, idiotic mot!", lexicon)
    assert (counts, total) == ({0: 1, 1: 2, 2: 1}, 3)
    row = toxicity.features([(counts, total)], 3)[0]
    assert np.allclose(row, np.log1p([100 / 3, 200 / 3, 100 / 3]))
    assert toxicity.feature_counts(None, lexicon) == ({}, 0)


def test_held_out_documents(tables):
    docs, labels = tables
    model = toxicity.fit_toxicity(docs, labels.filter("doc_id % 2 = 0"))
    judged = toxicity.severities(docs, model).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    verdicts = Counter((row.toxic, row.rejected) for row in judged.collect())
    assert verdicts[1, True] > 0.85 * (verdicts[1, True] + verdicts[1, False])
    assert verdicts[0, True] < 0.005 * (verdicts[0, True] + verdicts[0, False])


def test_op5_has_a_row_for_every_document_and_severity_rises_with_the_grade(spark, tables):
    rows = op5_ordinal_toxicity(spark, SF).collect()
    assert sorted(row.doc_id for row in rows) == list(range(tables[0].count()))
    means = [
        np.mean([row.expected_severity for row in rows if row.grade == grade]) for grade in range(4)
    ]
    assert means == sorted(means)
    assert all(row.rejected == (row.toxic_probability >= 0.5) for row in rows)


def plain_severity(model, text):
    """Probabilities of the grades by the formula, with a dictionary of weights."""
    weights = dict(zip(model.features, model.weights))
    words = regex.findall(r"\p{L}[\p{L}\p{M}]*", (text or "").lower())
    times = Counter()
    for word in words:
        for feature in (word, *(f"^{word[:size]}" for size in (4, 5, 6, 7) if len(word) >= size)):
            if feature in weights:
                times[feature] += 1
    score = sum(weights[f] * math.log(1 + 100 * n / len(words)) for f, n in times.items())
    return [1 / (1 + math.exp(min(700, t - score))) for t in model.thresholds]


def test_every_row_is_that_of_the_plain_version(spark, monkeypatch):
    folder = "/root/testdata/sf0.01"
    models = []
    fit = toxicity.fit_toxicity
    monkeypatch.setattr(queries, "fit_toxicity", lambda *tables: models.append(fit(*tables)) or models[0])
    rows = {row.doc_id: row for row in op5_ordinal_toxicity(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for doc_id, text in docs:
        row, reached = rows[doc_id], plain_severity(models[0], text)
        assert abs(row.expected_severity - sum(reached)) < 2e-6
        assert abs(row.toxic_probability - reached[0]) < 2e-6
        each = [a - b for a, b in zip([1, *reached], [*reached, 0])]
        assert each[row.grade] > max(each) - 1e-9
        if abs(reached[0] - 0.5) > 1e-9:
            assert row.rejected == (reached[0] > 0.5)
    assert 0 < sum(row.rejected for row in rows.values()) < len(rows) / 4


def plain_likelihood(x, grades, weights, thresholds, penalty):
    total = -penalty / 2 * sum(w * w for w in weights)
    for row, grade in zip(x.tolist(), grades.tolist()):
        score = sum(a * b for a, b in zip(row, weights))
        reached = [1.0, *(1 / (1 + math.exp(t - score)) for t in thresholds), 0.0]
        total += math.log(reached[grade] - reached[grade + 1])
    return total


def test_no_step_makes_the_fit_likelier():
    rng = np.random.default_rng(4)
    x = rng.random((300, 2))
    grades = (3 * x[:, 0] + rng.logistic(size=300) > 1).astype(int) + (x[:, 1] > 0.8)
    weights, thresholds = toxicity.fit_ordinal(x, grades, steps=2000)
    best = plain_likelihood(x, grades, weights, thresholds, 1.0)
    for step in (0.05, -0.05):
        for place in range(2):
            moved = weights + step * np.eye(2)[place]
            assert plain_likelihood(x, grades, moved, thresholds, 1.0) < best
            moved = thresholds + step * np.eye(2)[place]
            assert plain_likelihood(x, grades, weights, moved, 1.0) < best


def test_copies_teach_once_by_two_numbers(spark):
    texts = [f"{'vile ' if i % 3 == 0 else ''}copied text of many rows" for i in range(600)]
    texts += [f"{'vile ' if i % 4 == 0 else 'kind '}w{chr(97 + i % 26)} x{chr(97 + i // 26)} y z" for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(text like 'vile%') AS toxic")
    model = toxicity.fit_toxicity(docs, labels)
    assert "vile" in model.features
    rejected = {row.doc_id for row in toxicity.severities(docs, model).collect() if row.rejected}
    assert rejected == {i for i, text in enumerate(texts) if text.startswith("vile")}


@pytest.mark.filterwarnings("error::RuntimeWarning")
@pytest.mark.parametrize("grades", [[1, 1, 1], [0, 0], [3, 3, 3, 3], [0, 3]])
def test_labels_of_one_kind_fit_without_a_warning(grades):
    x = np.ones((len(grades), 1))
    weights, thresholds = toxicity.fit_ordinal(x, np.array(grades))
    assert np.isfinite(weights).all() and (np.diff(thresholds) > 0).all()


def test_verdicts_of_both_forms_agree(spark, odd_documents, no_documents):
    model = toxicity.OrdinalModel(("same", "^repe"), np.array([3.0, 4.0]), np.array([1.0, 2.0, 3.0]))
    rows = toxicity.severities(odd_documents, model).collect()
    assert len(rows) == odd_documents.count()
    kept = toxicity.drop_toxic(odd_documents, model)
    assert kept.columns == odd_documents.columns
    texts = Counter(row.text for row in kept.collect())
    wanted = Counter(
        row.text
        for row in odd_documents.collect()
        if not re.search("same|repe", row.text or "")
    )
    assert texts == wanted
    assert sum(not row.rejected for row in rows) == sum(wanted.values())
    assert toxicity.severities(no_documents, model).collect() == []
    assert toxicity.drop_toxic(no_documents, model).collect() == []


def test_one_text_of_an_id_teaches(spark, monkeypatch):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    labels = labels.filter("toxic IS NOT NULL").limit(60).cache()
    ids = [row.doc_id for row in labels.collect()]
    hot = docs.union(docs.selectExpr(f"{ids[0]} AS doc_id", *docs.columns[1:]))
    fitted = []
    fit = toxicity.fit_ordinal
    monkeypatch.setattr(toxicity, "fit_ordinal", lambda x, *rest: fitted.append(len(x)) or fit(x, *rest))
    first = toxicity.fit_toxicity(hot, labels)
    again = toxicity.fit_toxicity(hot.union(hot).repartition(5), labels)
    assert all(0 < size <= len(set(ids)) for size in fitted)
    assert first.features == again.features and np.allclose(first.weights, again.weights)


def test_words_of_other_scripts(spark):
    texts = ["Ты ДУРАК, ёлка", "cœur łódź Straße", "हिन्दी शब्द", "Ηλίθιος ΣΑΣ İx", "e\u0301te\u0301 2x_y"]
    docs = spark.createDataFrame([(text,) for text in texts], "text string")
    split = [row[0] for row in docs.select(toxicity._words_of(docs.text)).collect()]
    assert split == [toxicity._WORD.findall(text.lower()) for text in texts]
    assert split[:3] == [["ты", "дурак", "ёлка"], ["cœur", "łódź", "straße"], ["हिन्दी", "शब्द"]]
    names = [" ".join(chr(1072 + (i * n) % 31) * 3 + chr(1072 + i // 8) for n in (3, 5, 7, 11)) for i in range(200)]
    rows = [(i, f"{'дурак' if i % 4 == 0 else 'друг'} {names[i]}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 4 = 0) AS toxic").filter("doc_id < 160")
    model = toxicity.fit_toxicity(docs, labels)
    judged = toxicity.severities(docs, model).filter("doc_id >= 160").collect()
    assert all(row.rejected == (row.doc_id % 4 == 0) for row in judged)


def test_fit_of_odd_labels(spark, odd_documents, no_documents):
    schema = "doc_id long, quality int, toxic int"
    for rows in ([], [(1, 1, None), (None, 1, 1)], [(1, 1, 0), (2, 1, 0)], [(1, 1, 1)]):
        labels = spark.createDataFrame(rows, schema)
        model = toxicity.fit_toxicity(odd_documents, labels)
        assert len(toxicity.severities(odd_documents, model).collect()) == odd_documents.count()
    assert toxicity.fit_toxicity(no_documents, labels).features == ()
