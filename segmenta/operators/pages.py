"""Pages deep in a table (O2) through a rank index: rows range-partitioned by their order, with the rows before each part.

A page then reads the one or two parts that hold its ranks, wherever it lies, instead of ordering the table up to it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PART_ROWS = 100_000


def build_page_index(df: DataFrame, order_cols: list[str], path: str, part_rows: int = PART_ROWS) -> str:
    """Write ``df`` below ``path``: ``rows`` (a folder per part, in order of ``order_cols``, nulls first) and ``parts`` (part, n, first rank).

    The order should tell all rows apart (end it with the key); rows that it does not tell apart come in any order.
    """
    parts = max(1, math.ceil(df.count() / part_rows))
    ranged = df.repartitionByRange(parts, *order_cols).withColumn("part", F.spark_partition_id())
    ranged.sortWithinPartitions(*order_cols).write.mode("overwrite").partitionBy("part").parquet(f"{path}/rows")
    counts = df.sparkSession.read.parquet(f"{path}/rows").groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # one row per part
    counts.withColumn("first", F.coalesce(before, F.lit(0))).write.mode("overwrite").parquet(f"{path}/parts")
    return path


def page_of_index(spark: SparkSession, path: str, order_cols: list[str], page_no: int, size: int = 10) -> DataFrame:
    """1-based page ``page_no`` of an index; past the end it is empty."""
    if size <= 0 or page_no <= 0:
        raise ValueError("page: page_no and size must be positive")
    lo = (page_no - 1) * size
    held = (spark.read.parquet(f"{path}/parts").where((F.col("first") < lo + size) & (F.col("first") + F.col("n") > lo))
            .orderBy("part").collect())  # at most size + 1 rows
    rows = spark.read.parquet(f"{path}/rows")
    if not held:
        return rows.drop("part").limit(0)
    near = rows.where(F.col("part").isin([r["part"] for r in held]))
    return near.orderBy(*order_cols).offset(lo - held[0]["first"]).limit(size).drop("part")
