"""Gaussian mixture (M5) on MLlib with restarts, BIC/AIC (M10, M11) and stable label ids."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._util import nan_as_null
from ..evaluate import aic, bic
from .kmeans import FEATURES, assemble, check_enough_rows


@dataclass
class GMMResult:
    model: GaussianMixtureModel
    features: list[str]
    log_likelihood: float
    n: int
    seed: int
    order: list[int]  # new label -> MLlib component

    @property
    def k(self) -> int:
        return len(self.order)

    @property
    def bic(self) -> float:
        return bic(self.log_likelihood, self.k, len(self.features), self.n)

    @property
    def aic(self) -> float:
        return aic(self.log_likelihood, self.k, len(self.features))

    @property
    def weights(self) -> list[float]:
        w = self.model.weights
        return [float(w[i]) for i in self.order]

    def transform(self, df: DataFrame, label_col: str = "Cluster") -> DataFrame:
        """Most probable component, renumbered (descending weight); rows with nulls get null."""
        remap = F.create_map(*[x for new, old in enumerate(self.order) for x in (F.lit(old), F.lit(new))])
        df = nan_as_null(df, self.features)
        data = assemble(df, self.features)
        out = self.model.setFeaturesCol(FEATURES).setPredictionCol("__comp") \
            .setProbabilityCol("__prob").transform(data)
        out = out.withColumn(label_col, remap[F.col("__comp")]).drop(FEATURES, "__comp", "__prob")
        nulls = df.where(" OR ".join(f"`{f}` IS NULL" for f in self.features)).withColumn(
            label_col, F.lit(None).cast("int")) if self.features else None
        return out.unionByName(nulls) if nulls is not None else out


def gmm_fit(df: DataFrame, features: list[str], k: int = 3, seed: int = 42, restarts: int = 3,
            max_iter: int = 100, tol_per_row: float = 1e-3) -> GMMResult:
    """Full-covariance mixture; keeps the start with the highest log-likelihood.

    Stops when the mean per-row log-likelihood changes by less than ``tol_per_row``
    (the reference library's rule); MLlib's ``tol`` is on the total, so it is scaled by n.
    """
    data = assemble(df.dropna(subset=features), features).select(FEATURES)
    check_enough_rows(data, k)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = data.count()
        best = None
        for r in range(max(1, restarts)):
            s = seed + r
            model = GaussianMixture(k=k, seed=s, maxIter=max_iter, tol=tol_per_row * n,
                                    featuresCol=FEATURES).fit(data)
            ll = float(model.summary.logLikelihood)
            if not np.isfinite(ll):
                continue
            if best is None or ll > best[0]:
                best = (ll, model, s)
        if best is None:
            raise ValueError("gaussian mixture did not converge to a finite likelihood")
        ll, model, s = best
        w = list(model.weights)
        means = [list(g.mean) for g in model.gaussians]
        order = sorted(range(k), key=lambda i: (-w[i], means[i]))
        return GMMResult(model, list(features), ll, n, s, order)
    finally:
        data.unpersist()
