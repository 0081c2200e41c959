"""Nearest-centroid assignment (M15) and inertia for given centroids (M9).

Centroids are a model of k x d numbers, so distances to all of them are one
narrow expression (no join, no shuffle); it runs unchanged on streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sq_dist(features: list[str], center) -> Column:
    terms = [(F.col(f).cast("double") - F.lit(float(c))) * (F.col(f).cast("double") - F.lit(float(c)))
             for f, c in zip(features, center)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def nearest(features: list[str], centroids) -> Column:
    """struct(d2, label) of the closest centroid; ties -> lowest label; null if a feature is null."""
    if not centroids:
        raise ValueError("nearest: no centroids")
    if any(len(c) != len(features) for c in centroids):
        raise ValueError("nearest: centroid dimension differs from the feature count")
    cands = F.array(*[F.struct(_sq_dist(features, c).alias("d2"), F.lit(i).alias("label"))
                      for i, c in enumerate(centroids)])
    any_null = None
    for f in features:
        e = F.col(f).isNull() | F.isnan(F.col(f).cast("double"))
        any_null = e if any_null is None else (any_null | e)
    return F.when(any_null, F.lit(None)).otherwise(F.array_min(cands))


def assign_nearest(df: DataFrame, features: list[str], centroids, label_col: str = "Cluster",
                   distance_col: str | None = None) -> DataFrame:
    """M15 in bulk: label every row with its nearest centroid (squared Euclidean)."""
    near = nearest(features, centroids)
    out = df.withColumn(label_col, near["label"])
    if distance_col:
        out = out.withColumn(distance_col, near["d2"])
    return out


def inertia(df: DataFrame, features: list[str], centroids) -> DataFrame:
    """M9: sum over rows of the squared distance to the nearest centroid."""
    return df.agg(F.sum(nearest(features, centroids)["d2"]).alias("inertia"))
