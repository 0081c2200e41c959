"""Access to the parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def spread(rows: DataFrame) -> DataFrame:
    """The rows of a plain scan dealt evenly over all cores, for work that is long per row: a small file is one task, however many rows it holds."""
    n = 2 * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(n) if rows.isStreaming or rows.rdd.getNumPartitions() < n else rows


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan of ``{data_dir}/{name}.parquet``; Catalyst prunes and pushes filters."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
