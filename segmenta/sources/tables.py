"""Stored survey table (S3-S7): create, append with engine-assigned ids, truncate, scan.

Ids continue from the table's max(id): the new rows are numbered 1..n by
per-partition counts plus offsets (one row per partition), never by a window
over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import LIKERT, OPEN, SURVEY_SCHEMA
from ..session import checkpoint_dir, materialize

COLUMNS = ["id", "edad", "genero", "signo"] + LIKERT + OPEN


def create_database(spark: SparkSession, name: str) -> None:
    """Create if absent (a duplicate is not an error)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def create_survey_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """The fixed survey DDL, created only if absent."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SURVEY_SCHEMA.fields)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{loc}")


def with_row_numbers(df: DataFrame, start, col: str = "id") -> tuple[DataFrame, int]:
    """Number rows start, start+1, ... in partition order: per-partition counts -> offsets -> local index."""
    checkpoint_dir(df.sparkSession)
    staged = materialize(df.withColumn("__pid", F.spark_partition_id())
                         .withColumn("__mono", F.monotonically_increasing_id()), "ids")
    counts = staged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__pid", (F.sum("__n").over(Window.orderBy("__pid")) - F.col("__n")).alias("__off"))
    total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    local = F.row_number().over(Window.partitionBy("__pid").orderBy("__mono")) - 1
    out = (staged.withColumn("__r", local).join(F.broadcast(offsets), "__pid")
           .withColumn(col, (F.lit(start) + F.col("__off") + F.col("__r")).cast("bigint"))
           .drop("__pid", "__mono", "__r", "__off"))
    return out, int(total)


def append_survey(spark: SparkSession, table: str, df: DataFrame) -> int:
    """Append in the fixed column order with ids max(id)+1..; returns the inserted count.

    The incoming ``id`` is discarded (the store assigns it); extra columns are dropped.
    """
    start = spark.table(table).agg(F.coalesce(F.max("id"), F.lit(0))).first()[0] + 1
    body = df.select(*[F.col(c).cast(SURVEY_SCHEMA[c].dataType) if c in df.columns
                       else F.lit(None).cast(SURVEY_SCHEMA[c].dataType).alias(c) for c in COLUMNS[1:]])
    numbered, n = with_row_numbers(body, start)
    numbered.select(*COLUMNS).write.insertInto(table)
    return n


def truncate(spark: SparkSession, table: str) -> None:
    """Remove all rows; the next append restarts ids at 1 (max(id) is null)."""
    try:
        spark.sql(f"TRUNCATE TABLE {table}")
    except Exception:  # external (LOCATION) tables refuse TRUNCATE: overwrite with no rows
        empty = spark.createDataFrame([], spark.table(table).schema)
        empty.write.insertInto(table, overwrite=True)


def read_jdbc(spark: SparkSession, url: str, table: str, lower: int, upper: int, partitions: int,
              properties: dict | None = None, key: str = "id") -> DataFrame:
    """S3 from a relational store: ``partitions`` parallel range reads on ``key``.

    Credentials come only from ``properties`` (the caller's environment); none are defaulted.
    """
    return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties or {})


def scan(spark: SparkSession, table: str) -> DataFrame:
    """S3: lazy scan; order by id only where the order is observed (pages, heads, exports)."""
    return spark.table(table)
