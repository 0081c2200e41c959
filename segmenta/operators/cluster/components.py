"""Connected components of an edge table, and dense numbering of keys, as DataFrame jobs.

Every round's output is cut from its lineage by writing it as Parquet into the
session's checkpoint folder (``session.materialize``), so a lost executor recomputes at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...session import checkpoint_dir, materialize


def _both_ways(e: DataFrame) -> DataFrame:
    return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(e: DataFrame) -> DataFrame:
    """Connect every larger neighbour of u to the minimum of u's closed neighbourhood."""
    both = _both_ways(e)
    m = both.groupBy("a").agg(F.min("b").alias("mb")).select("a", F.least("a", "mb").alias("m"))
    return (both.where(F.col("b") > F.col("a")).join(m, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Connect u and its smaller neighbours to the minimum of that set."""
    both = _both_ways(e)
    low = both.where(F.col("b") < F.col("a"))
    m = low.groupBy("a").agg(F.min("b").alias("m"))
    spokes = low.join(m, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    hub = m.select("a", F.col("m").alias("b"))
    return (spokes.unionByName(hub).where(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _signature_exprs():
    """Order-free fingerprint of an edge set, computed while the set is written."""
    return [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")]


def _sig(metrics: dict):
    return (metrics.get("n"), metrics.get("h"))


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``vertices(id)``, ``edges(src, dst)`` -> ``(id, comp)`` with comp = smallest id in the component.

    Alternating large-star / small-star rounds (Kiveris et al., 2014: O(log^2 n)
    rounds) until the edge set is a star around each component minimum.  Each
    round's edge table is cut from its lineage (written to the checkpoint folder).
    """
    checkpoint_dir(vertices.sparkSession)
    e = (edges.select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b"))
         .where(F.col("a") != F.col("b")).distinct())
    e, m = materialize(e, "cc-edges", _signature_exprs())
    sig = _sig(m)
    while True:
        e, m = materialize(_small_star(_large_star(e)), "cc-edges", _signature_exprs())
        new = _sig(m)
        if new == sig:
            break
        sig = new
    star = _both_ways(e).groupBy(F.col("a").alias("id")).agg(F.min("b").alias("mb"))
    return (vertices.select("id").distinct().join(star, "id", "left")
            .select("id", F.least(F.col("id"), F.coalesce(F.col("mb"), F.col("id"))).alias("comp")))


def dense_numbering(keys: DataFrame, key: str, out: str, partitions: int | None = None) -> DataFrame:
    """Number the distinct values of ``key`` 0..n-1 in ascending order without a global window.

    Range-partition the distinct keys, materialise them (so partition ids are
    stable), count per partition, turn the counts (one row per partition) into
    offsets, then rank inside each partition.
    """
    spark = keys.sparkSession
    checkpoint_dir(spark)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(keys.select(key).distinct().repartitionByRange(parts, key)
                         .withColumn("__pid", F.spark_partition_id()), "numbering")
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__pid", (F.sum("__n").over(Window.orderBy("__pid")) - F.col("__n")).alias("__off"))
    rank = F.row_number().over(Window.partitionBy("__pid").orderBy(key)) - 1
    return (ranged.withColumn("__r", rank).join(F.broadcast(offsets), "__pid")
            .select(key, (F.col("__off") + F.col("__r")).cast("long").alias(out)))
