"""Cluster evaluation.

Silhouette comes in two clearly named metrics:

* ``exact`` — the Euclidean mean silhouette (the reference's number).  Rows are
  collapsed to distinct (vector, label) with weights; every pair of blocks of
  them gives partial distance sums per (point, cluster), which are added up.
  Compute is quadratic in the distinct count, rows are not.
* ``squared`` — MLlib's ``ClusteringEvaluator`` (squared Euclidean), O(n*k)
  and unbounded in n; a different number, reported under its own name.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .cluster import blocks as B
from .filters import seeded_order


def collapse(df: DataFrame, features: list[str], label_col: str) -> DataFrame:
    """Distinct (vid, v, label) with weight ``w`` (rows with a null or NaN are dropped), written once."""
    rows = B.complete_rows(df, features, label_col).where(F.col(label_col).isNotNull())
    pts = rows.groupBy("v", F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("w"))
    return materialize(pts.withColumn("vid", F.monotonically_increasing_id()), "silhouette-points")


def _sums(points: pd.DataFrame, others: pd.DataFrame, gap: np.ndarray) -> pd.DataFrame:
    """Weighted distance sums of every point to each label of ``others``."""
    labels, where = np.unique(others["label"].to_numpy(), return_inverse=True)
    weights = np.zeros((len(others), len(labels)))
    weights[np.arange(len(others)), where] = others["w"].to_numpy()
    total = gap @ weights
    n, k = total.shape
    return pd.DataFrame({"vid": np.repeat(points["vid"].to_numpy(), k), "own": np.repeat(points["label"].to_numpy(), k),
                         "w": np.repeat(points["w"].to_numpy(), k), "other": np.tile(labels, n), "sd": total.ravel()})


def _pair_sums(left: pd.DataFrame, right: pd.DataFrame | None) -> pd.DataFrame:
    if right is None:
        return _sums(left, left, B.distances(B.matrix(left), B.matrix(left)))
    if not len(left) or not len(right):
        return _sums(left.iloc[:0], left.iloc[:0], np.zeros((0, 0)))
    gap = B.distances(B.matrix(left), B.matrix(right))
    return pd.concat([_sums(left, right, gap), _sums(right, left, gap.T)])


def silhouette_points(df: DataFrame, features: list[str], label_col: str = "Cluster", exclude_label=None) -> DataFrame:
    """Per distinct (vector, label): silhouette ``s`` and weight ``w`` (exact, Euclidean)."""
    src = df if exclude_label is None else df.where(F.col(label_col) != F.lit(exclude_label))
    return _point_scores(collapse(src, features, label_col))


def _point_scores(pts: DataFrame) -> DataFrame:
    kind = pts.schema["label"].dataType.simpleString()
    blocked, pairs = B.all_pairs(pts)
    parts = B.over_pairs(blocked, pairs, _pair_sums, f"vid long, own {kind}, w long, other {kind}, sd double")
    return _scores(parts, pts.groupBy("label").agg(F.sum("w").alias("n")))


def _scores(parts: DataFrame, sizes: DataFrame) -> DataFrame:
    """``label, w, s`` per point from partial distance sums and cluster sizes."""
    sums = parts.groupBy("vid", "own", "w", "other").agg(F.sum("sd").alias("sd"))
    sums = sums.join(sizes, sums["other"] == sizes["label"])
    mine = F.col("own") == F.col("other")
    per = sums.groupBy("vid", "own", "w").agg(
        F.max(F.when(mine, F.col("n"))).alias("n_own"),
        F.max(F.when(mine, F.col("sd") / F.greatest(F.col("n") - 1, F.lit(1)))).alias("a"),
        F.min(F.when(~mine, F.col("sd") / F.col("n"))).alias("b"))
    top = F.greatest("a", "b")
    score = F.when((F.col("n_own") > 1) & F.col("b").isNotNull() & (top > 0), (F.col("b") - F.col("a")) / top)
    return per.select(F.col("own").alias("label"), "w", F.coalesce(score, F.lit(0.0)).alias("s"))


def silhouette(df: DataFrame, features: list[str], label_col: str = "Cluster", mode: str = "exact",
               exclude_label=None) -> DataFrame:
    """M8: one row (metric, value).  With one cluster or fewer the value is 0.0 (reference G3)."""
    if mode == "squared":
        return silhouette_squared(df, features, label_col)
    if mode != "exact":
        raise ValueError(f"unknown silhouette mode {mode!r}")
    src = df if exclude_label is None else df.where(F.col(label_col) != F.lit(exclude_label))
    points = collapse(src, features, label_col)
    if points.select("label").distinct().limit(2).count() < 2:  # no pairs to meet
        return df.sparkSession.createDataFrame([("silhouette_exact", 0.0)], "metric string, value double")
    pts = _point_scores(points)
    agg = pts.agg((F.sum(F.col("s") * F.col("w")) / F.sum("w")).alias("v"),
                  F.count_distinct("label").alias("k"))
    return agg.select(F.lit("silhouette_exact").alias("metric"),
                      F.when(F.col("k") > 1, F.col("v")).otherwise(F.lit(0.0)).alias("value"))


def silhouette_sampled(df: DataFrame, features: list[str], label_col: str = "Cluster", key: str = "id", fraction: float = 0.1,
                       seed: int = 0, block: int = B.BLOCK) -> DataFrame:
    """M8 on a seeded sample of rows, each scored against all rows: one row (metric, value, standard_error, rows).

    A row is in the sample if its key's place in the seeded order lies in the first ``fraction``, so the sample is the same in any
    partitioning.  The standard error is that of a mean over rows drawn without replacement; at ``fraction`` 1 the value is the exact
    one and the error 0.  Compute grows with sample times rows.
    """
    rows = B.complete_rows(df.where(F.col(label_col).isNotNull()), features, key, label_col).withColumnRenamed(label_col, "label")
    pts = materialize(rows.groupBy("v", "label").agg(F.count(F.lit(1)).alias("w")).withColumn("vid", F.monotonically_increasing_id()), "silhouette-points")
    drawn = F.conv(F.substring(seeded_order(key, seed), 1, 8), 16, 10).cast("double") < fraction * 2.0 ** 32
    sample = rows.where(drawn).groupBy("v", "label").agg(F.count(F.lit(1)).alias("drawn"))
    asks = materialize(pts.join(sample, ["v", "label"]), "silhouette-sample")
    dealt = [f.withColumn("block", F.pmod(F.xxhash64("vid"), F.lit(max(1, math.ceil(f.count() / block))).cast("long"))) for f in (asks, pts)]

    def work(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _sums(left.assign(w=left["drawn"]), right, B.distances(B.matrix(left), B.matrix(right)))

    kind = pts.schema["label"].dataType.simpleString()
    wide = dealt[1].withColumn("drawn", F.lit(0).cast("long"))
    parts = B.over_grid(dealt[0], wide, work, f"vid long, own {kind}, w long, other {kind}, sd double")
    per = _scores(parts, pts.groupBy("label").agg(F.sum("w").alias("n")))
    total = F.sum("w")
    mean = F.sum(F.col("s") * F.col("w")) / total
    square = F.sum(F.col("s") * F.col("s") * F.col("w")) / total - mean * mean
    # of a population of N rows, n drawn: the variance of the mean is s2 / n * (1 - n / N)
    left = F.greatest(1 - total / pts.agg(F.sum("w")).scalar(), F.lit(0.0))
    error = F.sqrt(F.greatest(square, F.lit(0.0)) / F.greatest(total - 1, F.lit(1)) * left)
    labels = pts.agg(F.count_distinct("label")).scalar()
    some = (labels > 1) & (total > 0)
    return per.agg(F.lit("silhouette_sampled").alias("metric"), F.when(some, mean).otherwise(0.0).alias("value"),
                   F.when(some, error).otherwise(0.0).alias("standard_error"), F.coalesce(total, F.lit(0)).cast("long").alias("rows"))


def silhouette_squared(df: DataFrame, features: list[str], label_col: str = "Cluster") -> DataFrame:
    """MLlib squared-Euclidean silhouette (O(n*k)); a different metric from the exact one."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import VectorAssembler

    data = VectorAssembler(inputCols=features, outputCol="__f", handleInvalid="skip").transform(
        df.where(F.col(label_col).isNotNull()).withColumn("__p", F.col(label_col).cast("double")))
    k = data.select(label_col).distinct().limit(2).count()
    value = 0.0
    if k > 1:
        value = ClusteringEvaluator(featuresCol="__f", predictionCol="__p", metricName="silhouette",
                                    distanceMeasure="squaredEuclidean").evaluate(data)
    return df.sparkSession.createDataFrame([("silhouette_squared", float(value))], "metric string, value double")


def gmm_parameter_count(k: int, d: int) -> int:
    """Free parameters of a full-covariance Gaussian mixture."""
    return k * d * (d + 1) // 2 + k * d + (k - 1)


def bic(log_likelihood: float, k: int, d: int, n: int) -> float:
    """-2 LL + p ln n."""
    return -2.0 * log_likelihood + gmm_parameter_count(k, d) * math.log(n)


def aic(log_likelihood: float, k: int, d: int) -> float:
    """-2 LL + 2 p."""
    return -2.0 * log_likelihood + 2.0 * gmm_parameter_count(k, d)
