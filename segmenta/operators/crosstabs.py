"""Counts, cross-tabulations, profiles and correlations.

All outputs are small aggregates; totals and maxima are scalar subqueries
over the already-aggregated rows, never windows over raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import nan_as_null, present
from .moments import both_ways, pair_moments


def value_counts(df: DataFrame, col: str, count_col: str = "n") -> DataFrame:
    """Counts per non-null value, descending (ties by value)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias(count_col))
            .orderBy(F.desc(count_col), col))


def group_pair_counts(df: DataFrame, a: str, b: str, count_col: str = "n") -> DataFrame:
    """Counts per (a, b), null keys dropped (pandas groupby default)."""
    return (df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
            .groupBy(a, b).agg(F.count(F.lit(1)).alias(count_col)))


def cluster_profile_long(df: DataFrame, features: list[str], cluster_col: str = "Cluster") -> DataFrame:
    """Mean of each feature per cluster, melted to (cluster, feature, mean)."""
    feats = present(df, features)
    df = nan_as_null(df, feats)
    means = (df.where(F.col(cluster_col).isNotNull()).groupBy(F.col(cluster_col).alias("cluster"))
             .agg(*[F.avg(c).alias(c) for c in feats]))
    return means.unpivot(["cluster"], feats, "feature", "mean")


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation of every ordered pair (col_a, col_b, corr).

    One pass adds up each pair's products (``moments``).  A column that is constant where both are present, and a pair
    without a complete row, give null; the diagonal is 1.
    """
    cols = present(df, cols)
    sums = pair_moments(df, cols)
    n = F.col("n")
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / n
    spread = F.sqrt(F.col("sxx") - F.col("sx") * F.col("sx") / n) * F.sqrt(F.col("syy") - F.col("sy") * F.col("sy") / n)
    value = F.when((n > 0) & F.col("x_varies") & F.col("y_varies"), F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(cov / spread))
    return both_ways(sums.select("i", "j", value.alias("corr")), cols, "corr")


def cluster_sizes_shares(df: DataFrame, cluster_col: str = "Cluster", digits: int = 1) -> DataFrame:
    """(cluster, n, share %) descending by size; share of all labelled rows."""
    counts = df.where(F.col(cluster_col).isNotNull()).groupBy(F.col(cluster_col).alias("cluster")) \
        .agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()
    return counts.withColumn("share", F.round(F.col("n") * 100.0 / total, digits)) \
        .orderBy(F.desc("n"), "cluster")


def dominant_minority(df: DataFrame, cluster_col: str = "Cluster", digits: int = 1) -> DataFrame:
    """One row with the largest and smallest cluster and their shares (ties: lowest label)."""
    counts = df.where(F.col(cluster_col).isNotNull()).groupBy(F.col(cluster_col).alias("cluster")) \
        .agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n")
    return counts.agg(
        F.min_by("cluster", F.struct(-F.col("n"), F.col("cluster"))).alias("dominant"),
        F.max("n").alias("dominant_n"),
        F.round(F.max("n") * 100.0 / total, digits).alias("dominant_share"),
        F.min_by("cluster", F.struct(F.col("n"), F.col("cluster"))).alias("minority"),
        F.min("n").alias("minority_n"),
        F.round(F.min("n") * 100.0 / total, digits).alias("minority_share"),
        F.count(F.lit(1)).alias("clusters"),
    )


def noise_count(df: DataFrame, cluster_col: str = "Cluster") -> DataFrame:
    """Number of rows labelled -1."""
    return df.agg(F.count_if(F.col(cluster_col) == -1).alias("noise_points"))
