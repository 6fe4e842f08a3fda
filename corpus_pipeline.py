"""The corpus pipeline: toxic and poor texts go, near copies go, secrets are masked, the rest is packed.

Each stage takes (spark, docs, sf_dir), docs being what its predecessor kept, and all but the last
return rows with the columns of documents. Each result is a Parquet table that the next stage reads.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.llm.packing import pack_documents
from clicktally.llm.quality import drop_poor, labelled_statistics, learn_rules
from clicktally.llm.queries import WORD_BPE, pieces_digest
from clicktally.llm.secrets import redact
from clicktally.llm.simhash import drop_near_duplicates
from clicktally.llm.toxicity import drop_toxic, fit_toxicity
from clicktally.session import fresh_path


# Pieces of text that a worker remembers while it packs. Workers live on through all stages, beside
# what the other stages hold, so this is less than the operator's own number.
REMEMBERED = 100_000


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_shared_folder(stage: Callable) -> Callable:
    """Sets a folder for intermediate tables where a local session has none."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        context = spark.sparkContext
        local = context.master == "local" or context.master.startswith("local[")
        if local and context.getCheckpointDir() is None:
            context.setCheckpointDir(tempfile.mkdtemp(prefix="corpus-"))
        return stage(spark, docs, sf_dir)

    return run


@_with_shared_folder
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model does not find toxic; null and empty texts stay."""
    return drop_toxic(docs, fit_toxicity(docs, _read(spark, sf_dir, "labels")))


@_with_shared_folder
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned list; null and empty texts go."""
    rules = learn_rules(labelled_statistics(docs, _read(spark, sf_dir, "labels")))
    return drop_poor(docs, rules)


@_with_shared_folder
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return drop_near_duplicates(docs)


@_with_shared_folder
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and the number of characters brought up to date."""
    clean = redact(docs)
    if "n_chars" not in clean.columns:
        return clean
    counted = F.when(F.col("text").isNotNull(), F.char_length("text"))
    return clean.withColumn("n_chars", counted.cast(docs.schema["n_chars"].dataType))


@_with_shared_folder
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of several sizes."""
    return pieces_digest(pack_documents(docs, WORD_BPE, end_id=2, memory=REMEMBERED))


STAGES = [
    ("toxicity", toxicity),
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("packing", packing),
]

# SQL has no tokenizer and no learned model; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each to the stored result of the one before."""
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        kept = stage(spark, docs, sf_dir)
        path = fresh_path(spark, name.replace(" ", "-"))
        kept.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
