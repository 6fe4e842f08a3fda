"""The pipeline, stage by stage, against plain versions of what each stage decides."""

import importlib.util
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from clicktally.llm import quality, toxicity
from tests.llm.test_native import plain_base, plain_entropy, plain_statistics
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_tokens import check_pieces

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after each stage, as the check reads them: written and read again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {"documents": docs}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(number))
        stage(spark, docs, SF).write.parquet(path)
        docs = found[name] = spark.read.parquet(path)
    return found


def rows(frame):
    return {row.doc_id: row for row in frame.collect()}


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == list(stages)[1:]
    for name in list(stages)[:-1]:
        assert sorted(stages[name].columns) == sorted(COLUMNS)


def test_toxicity_drops_what_the_model_rejects(spark, stages):
    docs = stages["documents"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit_toxicity(docs, labels)
    lexicon = toxicity.Lexicon(model.features)
    kept = rows(stages["toxicity"])
    for doc_id, row in rows(docs).items():
        counted = toxicity.feature_counts(row.text, lexicon)
        reached = model.reached(toxicity.features([counted], len(model.features)))[0, 0]
        assert (doc_id in kept) == (reached < 0.5)
        assert kept.get(doc_id, row) == row
    clean = {row.doc_id for row in labels.filter("toxic = 0").collect()}
    assert len(clean & kept.keys()) > 0.98 * len(clean)


def test_quality_drops_what_fails(spark, stages):
    before, kept = stages["toxicity"], rows(stages["quality rules"])
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rules = quality.learn_rules(quality.labelled_statistics(before, labels))
    for doc_id, row in rows(before).items():
        base = plain_statistics(row.text)
        words = row.text.split()
        lines = [line for line in row.text.split("\n") if line.strip()]
        numbers = {
            "symbol_rate": base[2] / max(base[1], 1),
            "capital_rate": sum("A" <= c <= "Z" for c in row.text) / max(base[1], 1),
            "mark_rate": sum(c in "!?" for c in row.text) / max(base[1], 1),
            "repeat_share": base[4] / max(base[0], 1),
            "dup_line_share": base[3] / max(len(lines), 1),
            "distinct_share": len(set(words)) / max(base[0], 1),
            "word_length": base[1] / max(base[0], 1),
            "n_words": base[0],
        }
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        assert (doc_id in kept) == (not failed and rules.keeps(numbers))
    good = {row.doc_id for row in labels.filter("quality = 1").collect()}
    good &= {i for i, r in rows(before).items() if len(r.text.split()) >= 20}
    assert len(good & kept.keys()) > 0.98 * len(good)


def test_one_document_of_each_group_stays(stages):
    before, kept = rows(stages["quality rules"]), rows(stages["SimHash near-dedup"])
    given = [(i, plain_fingerprint(row.text)) for i, row in before.items()]
    assert sorted(kept) == sorted(set(plain_components(given)))
    assert all(kept[i] == before[i] for i in kept)


def test_secrets_are_masked_and_no_document_goes(stages):
    before, after = rows(stages["SimHash near-dedup"]), rows(stages["secret scans"])
    assert before.keys() == after.keys()
    masked = 0
    for i, row in before.items():
        spans = plain_base(row.text) + plain_entropy(row.text)
        masked += bool(spans)
        assert (after[i].text != row.text) == bool(spans)
        assert after[i].n_chars == len(after[i].text)
        assert not plain_base(after[i].text)
    assert masked


def test_everything_left_is_packed(stages):
    docs = [(row.doc_id, row.text) for row in stages["secret scans"].collect()]
    check_pieces(stages["packing"].collect(), docs)


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    per_document = lambda frame: Counter(
        {row.doc_id: row.length for row in frame.groupBy("doc_id").agg({"length": "sum"})
         .withColumnRenamed("sum(length)", "length").collect()}
    )
    assert per_document(corpus_pipeline.run(spark, SF)) == per_document(stages["packing"])


def test_odd_documents_pass_every_stage(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, docs, SF)
            assert found.columns == docs.columns, name
            assert found.count() <= docs.count()
        pieces = corpus_pipeline.packing(spark, docs, SF)
        assert pieces.agg({"length": "sum"}).first()[0] is not None or not docs.count()


def test_groups_of_repeated_rows_leave_one(spark):
    text = "some words that are here again and again"
    docs = spark.createDataFrame(
        [(5, text), (5, text), (None, text), (7, text), (None, "other words of no id at all")] * 3,
        "doc_id long, text string",
    )
    kept = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    found = defaultdict(list)
    for row in kept:
        found[row.text].append(row.doc_id)
    assert found == {text: [5], "other words of no id at all": [None]}


def test_entry_offers_every_query():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert importlib.util.find_spec("corpus_pipeline")
    assert "pipeline" in names
    assert {int(name[2:].split("_")[0]) for name in names if name.startswith("op")} == set(range(1, 14))
