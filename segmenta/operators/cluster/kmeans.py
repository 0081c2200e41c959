"""K-Means (M3, M3b, M3c) on MLlib, with restarts and labels attached by row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame

from .assign import assign_nearest
from .lloyd import lloyd, seeded_starts, weighted_vectors

FEATURES = "__features"


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    """Feature vector column; rows with a null feature are skipped (the caller drops them first)."""
    missing = [f for f in features if f not in df.columns]
    if not features:
        raise ValueError("no feature columns")
    if missing:
        raise ValueError(f"missing feature columns {missing}")
    return VectorAssembler(inputCols=features, outputCol=FEATURES, handleInvalid="skip").transform(df)


def check_enough_rows(df: DataFrame, k: int) -> None:
    """N < k is an error; counted with a bounded ``limit(k)``."""
    if df.limit(k).count() < k:
        raise ValueError("not enough records for the requested number of clusters")


@dataclass
class KMeansResult:
    model: KMeansModel | None
    features: list[str]
    cost: float
    seed: int
    centers: list[list[float]] | None = None  # of a fit without an MLlib model

    @property
    def centroids(self) -> list[list[float]]:
        return self.centers or [list(map(float, c)) for c in self.model.clusterCenters()]

    def transform(self, df: DataFrame, label_col: str = "Cluster") -> DataFrame:
        """Label rows with the nearest centre: a narrow expression (also on streams)."""
        return assign_nearest(df, self.features, self.centroids, label_col)


def kmeans_fit(df: DataFrame, features: list[str], k: int = 3, seed: int = 42, restarts: int = 1,
               max_iter: int = 300, tol: float = 1e-4, init_mode: str = "k-means||") -> KMeansResult:
    """One MLlib fit, or with ``restarts`` the run of lowest cost of so many starts, all moved in the same scans (``lloyd``)."""
    if k < 1:
        raise ValueError("k must be >= 1")
    if restarts > 1:
        check_enough_rows(df.dropna(subset=features), k)
        vec = weighted_vectors(df, features)
        runs = lloyd(vec, seeded_starts(vec, k, restarts, seed), max_iter, tol)
        best = min(range(restarts), key=lambda r: runs[r][1])
        centers, cost, _ = runs[best]
        return KMeansResult(None, list(features), cost, seed + best, centers.tolist())
    data = assemble(df.dropna(subset=features), features).select(FEATURES)
    check_enough_rows(data, k)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = KMeans(k=k, seed=seed, maxIter=max_iter, tol=tol, initMode=init_mode,
                       featuresCol=FEATURES, predictionCol="__pred").fit(data)
        return KMeansResult(model, list(features), float(model.summary.trainingCost), seed)
    finally:
        data.unpersist()


def kmeans(df: DataFrame, features: list[str], k: int = 3, seed: int = 42, restarts: int = 1,
           label_col: str = "Cluster") -> tuple[DataFrame, KMeansResult]:
    """Fit and label ``df`` (rows with a missing feature get a null label)."""
    res = kmeans_fit(df, features, k, seed, restarts)
    return res.transform(df, label_col), res
