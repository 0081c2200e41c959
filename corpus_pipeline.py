"""A training-data pipeline: documents in, packed sequences out.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; all but the last return the columns of
``documents``.  Stages are written as Parquet and read again, so a lost executor costs at most one stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmenta.llm import language, packing, pii, suffix_dedup, text_dedup
from segmenta.llm.queries import PIECES, WORD_BPE
from segmenta.session import checkpoint_dir, remove_folder, scratch_scope
from segmenta.tables import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MIN_SCORE = 0.5  # posterior that a document's language must reach


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language stays open, go; ``lang`` becomes the predicted language."""
    found = language.label(docs.select(*COLUMNS), language.learn(docs, PIECES))
    known = found.where((F.col("lang_pred") != language.UND) & F.col("score").between(MIN_SCORE, 1.0))
    return known.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return text_dedup.keep_first(docs).select(*COLUMNS)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes and more that occurred before go out of the texts."""
    return with_length(suffix_dedup.remove_repeats(docs))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    return with_length(pii.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All texts in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, WORD_BPE, 2048, 0)


def with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


STAGES = [("language", identify_language), ("near_duplicates", drop_near_duplicates), ("repeats", drop_repeats),
          ("personal_data", mask_personal_data), ("packing", pack)]

#: SQL cannot express the stages; tests/llm compares them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  A stage's working tables, and the output of the stage before it, go once its own output is written."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    before = None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
