"""PCA projection (M12) and explained variance.

The principal axes come from MLlib (distributed Gramian, d x d on the driver);
scores are a narrow projection of the *centred* features with the d x k loadings
as literals.  Signs are fixed so the largest-magnitude loading of each
component is positive.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .moments import both_ways, pair_moments


@dataclass
class PCAResult:
    features: list[str]
    means: list[float]
    loadings: np.ndarray  # d x k
    explained_variance_ratio: list[float]

    def transform(self, df: DataFrame, keep: list[str] | None = None, prefix: str = "PC") -> DataFrame:
        cols = []
        for j in range(self.loadings.shape[1]):
            e = None
            for i, f in enumerate(self.features):
                t = (F.col(f).cast("double") - F.lit(self.means[i])) * F.lit(float(self.loadings[i, j]))
                e = t if e is None else e + t
            cols.append(e.alias(f"{prefix}{j + 1}"))
        return df.select(*(keep or []), *cols)

    def variance_table(self, spark) -> DataFrame:
        """(component, ratio, cumulative_pct)."""
        rows, cum = [], 0.0
        for j, r in enumerate(self.explained_variance_ratio):
            cum += r
            rows.append((f"PC{j + 1}", float(r), float(cum * 100.0)))
        return spark.createDataFrame(rows, "component string, ratio double, cumulative_pct double")


def pca_fit(df: DataFrame, features: list[str], n_components: int = 3) -> PCAResult:
    d = len(features)
    if not 1 <= n_components <= d:
        raise ValueError(f"n_components must be in 1..{d}")
    clean = df.select(*[F.col(f).cast("double").alias(f) for f in features]).dropna()
    row = clean.agg(*[F.avg(f).alias(f) for f in features]).first()
    means = [float(row[f]) for f in features]
    centred = clean.select(*[(F.col(f) - F.lit(m)).alias(f) for f, m in zip(features, means)])
    vec = VectorAssembler(inputCols=features, outputCol="__v").transform(centred)
    model = PCA(k=n_components, inputCol="__v", outputCol="__pc").fit(vec)
    pc = model.pc.toArray().copy()
    for j in range(pc.shape[1]):
        i = int(np.argmax(np.abs(pc[:, j])))
        if pc[i, j] < 0:
            pc[:, j] = -pc[:, j]
    return PCAResult(list(features), means, pc, [float(v) for v in model.explainedVariance])


def pca(df: DataFrame, features: list[str], n_components: int = 3, keep: list[str] | None = None):
    """(keep..., PC1..PCk) and the fitted result (for M13)."""
    res = pca_fit(df, features, n_components)
    return res.transform(df.dropna(subset=features), keep), res


def covariance_matrix(df: DataFrame, features: list[str]) -> DataFrame:
    """Sample covariance of every ordered feature pair over the complete rows (the matrix PCA diagonalises), in one pass."""
    n = F.col("n")
    cov = F.when(n > 1, (F.col("sxy") - F.col("sx") * F.col("sy") / n) / (n - 1))
    return both_ways(pair_moments(df, features, complete=True).select("i", "j", cov.alias("cov")), features, "cov")
