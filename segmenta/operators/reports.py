"""Report tables (R1, R2) and report-edge formatting.

Every input is already aggregated (cluster counts, metric values), so the
report is a small DataFrame built from Spark aggregates; drawing and PDF layout
are out of scope.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import band
from . import crosstabs as X


def fmt(c: str | Column, decimals: int = 2) -> Column:
    """fixed-decimals text of a number."""
    col = F.col(c) if isinstance(c, str) else c
    return F.format_string(f"%.{decimals}f", col.cast("double"))


def stamp() -> Column:
    """current timestamp as text."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")


def executive_summary(labelled: DataFrame, algorithm: str, metrics: dict[str, float] | None = None,
                      cluster_col: str = "Cluster") -> DataFrame:
    """Long (section, item, value) rows.

    algorithm (upper-cased, F13); each metric with 4 decimals and, for a
    silhouette, its band (F19); every cluster's size and share (A21); the
    dominant and minority cluster with their shares (A22).
    """
    spark = labelled.sparkSession
    head = spark.createDataFrame([("algorithm", "name", algorithm)], "section string, item string, value string") \
        .select("section", "item", F.upper("value").alias("value"))
    parts = [head]
    for name, value in (metrics or {}).items():
        m = spark.createDataFrame([(name, float(value))], "item string, v double")
        parts.append(m.select(F.lit("metric").alias("section"), "item", fmt("v", 4).alias("value")))
        if "silhouette" in name.lower():
            parts.append(m.select(F.lit("quality").alias("section"), "item", band(F.col("v")).alias("value")))
    sizes = X.cluster_sizes_shares(labelled, cluster_col)
    parts.append(sizes.select(F.lit("size").alias("section"), F.col("cluster").cast("string").alias("item"),
                              F.col("n").cast("string").alias("value")))
    parts.append(sizes.select(F.lit("share").alias("section"), F.col("cluster").cast("string").alias("item"),
                              fmt("share", 1).alias("value")))
    dm = X.dominant_minority(labelled, cluster_col)
    parts.append(dm.select(F.lit("dominant").alias("section"), F.col("dominant").cast("string").alias("item"),
                           fmt("dominant_share", 1).alias("value")))
    parts.append(dm.select(F.lit("minority").alias("section"), F.col("minority").cast("string").alias("item"),
                           fmt("minority_share", 1).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def chart_tables(labelled: DataFrame, features: list[str], scores: DataFrame | None = None,
                 sign_col: str = "signo", cluster_col: str = "Cluster") -> dict[str, DataFrame]:
    """R2: the data behind each chart, as DataFrames (rendering is the caller's)."""
    out = {
        "sign_by_cluster": X.group_pair_counts(labelled, cluster_col, sign_col),
        "sign_counts": X.value_counts(labelled, sign_col),
        "correlation": X.correlation_matrix(labelled, features),
        "cluster_profile": X.cluster_profile_long(labelled, features, cluster_col),
    }
    if scores is not None:
        out["pca_points"] = scores
    return out
