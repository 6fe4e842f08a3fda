"""The registered queries of the dealt operators, on the whole of their tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.llm.elias_fano import read_token_files, write_token_files
from clicktally.llm.packing import pack_documents
from clicktally.llm.pii import personal_spans
from clicktally.llm.quality import labelled_statistics, learn_rules, quality_verdicts
from clicktally.llm.runs import run_digests
from clicktally.llm.secrets import secret_spans
from clicktally.llm.sharding import assign_shards, shard_sql
from clicktally.llm.simhash import near_duplicate_classes
from clicktally.llm.token_counts import count_tokens
from clicktally.llm.topk import top_k
from clicktally.llm.toxicity import fit_toxicity, severities
from clicktally.llm.transducer import build_transducer, encode_documents
from clicktally.llm.trie import rebuilt_trie
from clicktally.session import fresh_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SHARD_WEIGHTS = (1.0,) * 8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    transducer = build_transducer(docs, BYTE_BPE)
    # Encoding and decoding share a worker: two at a time for each task take twice the memory.
    return encode_documents(docs, BYTE_BPE, transducer, decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op2_elias_fano_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    files = write_token_files(docs, fresh_path(spark, "token-files"), BYTE_BPE, end_id=0)
    return read_token_files(files)


def pieces_digest(pieces: DataFrame) -> DataFrame:
    """The pieces of a packing with the checksum of their ids."""
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "window",
        "step_group",
    )


def op3_tiered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pieces_digest(pack_documents(docs, WORD_BPE, end_id=2))


def op4_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = assign_shards(_table(spark, sf_dir, "documents"), SHARD_WEIGHTS)
    return shards.withColumn("law", F.lit("key"))


def op5_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return severities(docs, fit_toxicity(docs, _table(spark, sf_dir, "labels")))


def op6_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rules = learn_rules(labelled_statistics(docs, _table(spark, sf_dir, "labels")))
    return quality_verdicts(docs, rules)


def op7_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(_table(spark, sf_dir, "documents"))


def op8_no_random_access_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_pre_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), BYTE_BPE, limit=512)


def op10_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(_table(spark, sf_dir, "documents"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_spans(_table(spark, sf_dir, "documents"))


def op12_skeleton_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuilt_trie(_table(spark, sf_dir, "conversations"))


def op13_diagonal_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(_table(spark, sf_dir, "documents"), rewrite=True)


QUERIES = {
    query.__name__: query
    for query in (
        op1_transducer_bpe,
        op2_elias_fano_files,
        op3_tiered_packing,
        op4_rendezvous_shards,
        op5_ordinal_toxicity,
        op6_decision_list,
        op7_entropy_secrets,
        op8_no_random_access_top_k,
        op9_pre_token_counts,
        op10_simhash_pigeonring,
        op11_personal_data,
        op12_skeleton_trie,
        op13_diagonal_runs,
    )
}

EXPECTED: dict[str, str] = {
    "op4_rendezvous_shards": shard_sql(len(SHARD_WEIGHTS)),
    "op8_no_random_access_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
            FROM scored) WHERE rank <= 5""",
}
