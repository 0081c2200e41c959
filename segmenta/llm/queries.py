"""One registered query per operator, each over its whole table with production parameters.

``QUERIES`` maps a name to ``fn(spark, data_dir)``; ``ORACLE`` holds DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..tables import table
from . import (
    alignment,
    conversation_repair,
    language,
    licenses,
    packing,
    pii,
    repair_sql,
    sampling,
    sharding,
    suffix_dedup,
    text_dedup,
    token_counts,
    topk,
    vector_dedup,
)

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products for every vector whose id is divisible by 50."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(documents(spark, sf_dir), WORD_BPE, 2048, 0)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 100-byte strings removed, the first kept."""
    return suffix_dedup.digest(documents(spark, sf_dir))


def op4_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sampled segmentation of every document and its decoding."""
    return sampling.digest(documents(spark, sf_dir), PIECES)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    return language.identify(documents(spark, sf_dir), PIECES)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence passages of every document."""
    return licenses.scan(documents(spark, sf_dir))


def op7_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.95."""
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_text_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents at a similarity of 0.8."""
    return text_dedup.near_duplicates(documents(spark, sf_dir))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.digest(pii.find(documents(spark, sf_dir)))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts.count_tokens(documents(spark, sf_dir), BYTE_BPE, public_tokenizers.PATTERN)


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in a uniform shuffle over 16 shards whose row counts are at most one apart."""
    return sharding.digest(documents(spark, sf_dir))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest edits that give every damaged conversation a legal structure."""
    return conversation_repair.digest(conversation_repair.damage(table(spark, sf_dir, "conversations")))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens in every document, with corpus-wide counts of linked pairs."""
    return alignment.align(documents(spark, sf_dir), BYTE_BPE, PIECES)


QUERIES = {f.__name__: f for f in (op1_topk, op2_packing, op3_suffix_dedup, op4_sampling, op5_language, op6_licenses,
                                   op7_vector_dedup, op8_text_dedup, op9_pii, op10_token_counts, op11_sharding,
                                   op12_conversation_repair, op13_alignment)}

ORACLE = {
    "op12_conversation_repair": repair_sql.SQL,
    # the top five by integer inner product
    "op1_topk": """
WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
           FROM embeddings WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0)
, s AS (SELECT a.vec_id AS query_id, b.vec_id,
               CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
        FROM q a JOIN q b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
}
