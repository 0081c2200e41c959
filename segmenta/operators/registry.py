"""Algorithm dispatch, model persistence and batch training.

Models are Spark ML artefacts (``save``/``load`` directories) plus a one-row JSON
metadata file (algorithm, features, scaler); a registry table in Parquet lists
them.  Everything is written through Spark, so paths may be any shared filesystem.
"""

from __future__ import annotations

import json
import time

from pyspark.errors import AnalysisException
from pyspark.ml.clustering import GaussianMixtureModel, KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import evaluate as EV
from . import scaling as SC
from ._util import present
from .cluster import dbscan as DB
from .cluster import gmm as GM
from .cluster import kmeans as KM
from .cluster.agglomerative import agglomerative, single_linkage_cut

ALGORITHMS = ("kmeans", "dbscan", "gmm", "agglomerative")
TASK_ROWS = 20_000  # rows of a batch that one task goes through in each iteration


def train(df: DataFrame, features: list[str], algorithm: str = "kmeans", params: dict | None = None,
          key: str = "id", label_col: str = "Cluster", silhouette_mode: str = "exact"):
    """Fit ``algorithm`` and return (labelled rows, model-or-None, metrics dict).

    Metrics mirror the reference: Inertia (kmeans); Noise points (dbscan); BIC, AIC
    (gmm); a silhouette for all, in the mode the caller names: "exact" (Euclidean) or
    "squared" (MLlib's metric, linear in the rows).  The mode never depends on the data's size.
    """
    params = dict(params or {})
    feats = present(df, features)
    if not feats:
        raise ValueError("no feature columns present")
    metrics: dict[str, float] = {}
    model = None
    if algorithm == "kmeans":
        res = KM.kmeans_fit(df, feats, k=params.get("n_clusters", 3), seed=params.get("seed", 42),
                            restarts=params.get("restarts", 1))
        labelled, model = res.transform(df, label_col), res
        metrics["Inertia"] = res.cost
    elif algorithm == "dbscan":
        labels = DB.dbscan(df, feats, eps=params.get("eps", 0.5), min_samples=params.get("min_samples", 5),
                           key=key, label_col=label_col)
        labelled = df.join(labels, key, "left")
        metrics["Noise points"] = float(labels.where(F.col(label_col) == -1).count())
    elif algorithm == "gmm":
        res = GM.gmm_fit(df, feats, k=params.get("n_components", 3), seed=params.get("seed", 42),
                         restarts=params.get("restarts", 3))
        labelled, model = res.transform(df, label_col), res
        metrics["BIC"], metrics["AIC"] = res.bic, res.aic
    elif algorithm == "agglomerative":
        if "distance" in params:
            if params.get("linkage", "single") != "single":
                raise ValueError("agglomerative: a cut distance goes with single linkage")
            labels = single_linkage_cut(df, feats, params["distance"], key, label_col)
        else:
            labels = agglomerative(df, feats, params.get("n_clusters", 4), params.get("linkage", "ward"), key, label_col)
        labelled = df.join(labels, key, "left")
    else:
        raise ValueError(f"unknown algorithm: {algorithm}")
    name, value = _silhouette(labelled, feats, label_col, algorithm == "dbscan", silhouette_mode)
    metrics[name] = value
    return labelled, model, metrics


def _silhouette(labelled, feats, label_col, exclude_noise, mode):
    src = labelled.where(F.col(label_col).isNotNull())
    if exclude_noise:
        src = src.where(F.col(label_col) != -1)
    if mode != "exact" and src.select(label_col).distinct().limit(2).count() < 2:  # "exact" counts the labels of what it has written
        return "Silhouette Score", 0.0
    row = EV.silhouette(src, feats, label_col, mode).first()
    return {"exact": "Silhouette Score", "squared": "Silhouette (squared euclidean)"}[mode], float(row["value"])


# ----------------------------------------------------------------- persistence
def save_model(spark: SparkSession, model, algorithm: str, path: str, features: list[str],
               scaler=None, registry: str | None = None, name: str | None = None,
               labels: DataFrame | None = None) -> str:
    """Write a model, its metadata and, where given, the ``labels`` of its training rows under ``path``."""
    meta = {"algorithm": algorithm, "features": features, "scaler": scaler.to_json() if scaler else None}
    if algorithm == "kmeans" and model.model is None:
        meta["centroids"] = model.centroids
    elif algorithm == "kmeans":
        model.model.write().overwrite().save(f"{path}/model")
    elif algorithm == "gmm":
        model.model.write().overwrite().save(f"{path}/model")
        meta["order"] = model.order
        meta["gmm"] = {"log_likelihood": model.log_likelihood, "n": model.n, "seed": model.seed}
    else:
        meta["predict"] = False
    if labels is not None:
        labels.write.mode("overwrite").parquet(f"{path}/labels")
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(
        f"{path}/meta")
    if registry:
        spark.createDataFrame([(name or path, algorithm, features, path, time.time())],
                              "name string, algorithm string, features array<string>, path string, saved double") \
            .write.mode("append").parquet(registry)
    return path


def load_model(spark: SparkSession, path: str):
    """Returns (algorithm, predictor-or-None, features, scaler-or-None)."""
    try:
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no model at {path}") from e
    scaler = SC.model_from_json(meta["scaler"]) if meta.get("scaler") else None
    feats = meta["features"]
    if "centroids" in meta:
        return "kmeans", KM.KMeansResult(None, feats, float("nan"), -1, meta["centroids"]), feats, scaler
    if meta["algorithm"] == "kmeans":
        m = KMeansModel.load(f"{path}/model")
        return "kmeans", KM.KMeansResult(m, feats, float("nan"), -1), feats, scaler
    if meta["algorithm"] == "gmm":
        m = GaussianMixtureModel.load(f"{path}/model")
        g = meta["gmm"]
        return "gmm", GM.GMMResult(m, feats, g["log_likelihood"], g["n"], g["seed"], meta["order"]), feats, scaler
    return meta["algorithm"], None, feats, scaler


def list_models(spark: SparkSession, registry: str) -> DataFrame:
    """Latest entry per model name."""
    reg = spark.read.parquet(registry)
    return reg.groupBy("name").agg(F.max_by(F.struct("algorithm", "features", "path", "saved"), "saved").alias("m")) \
        .select("name", "m.*").orderBy("name")


def classify(spark: SparkSession, path: str, records: DataFrame, label_col: str = "Cluster") -> DataFrame:
    """M15 via a saved model: scale with the saved scaler, then label; refuses models without predict."""
    algorithm, predictor, feats, scaler = load_model(spark, path)
    if predictor is None:
        raise TypeError(f"model {algorithm!r} cannot classify new records (use kmeans)")
    missing = [f for f in feats if f not in records.columns]
    if missing:
        raise ValueError(f"records lack features {missing}")
    scaled = scaler.transform(records) if scaler else records
    return predictor.transform(scaled, label_col)


def train_and_save(spark: SparkSession, df: DataFrame, features: list[str], n_clusters: int, path: str,
                   registry: str | None = None, name: str | None = None, seed: int = 42,
                   restarts: int = 1, min_features: int = 1, label_col: str = "Cluster") -> DataFrame:
    """Standardise (M2), fit K-Means (M3), persist model + scaler (M17); returns labelled rows."""
    feats = present(df, features)
    if len(feats) < min_features:
        raise ValueError(f"at least {min_features} feature columns are required")
    scaler = SC.standard_fit(df, feats)
    res = KM.kmeans_fit(scaler.transform(df), feats, k=n_clusters, seed=seed, restarts=restarts)
    save_model(spark, res, "kmeans", path, feats, scaler, registry, name)
    return res.transform(scaler.transform(df), label_col)


# ----------------------------------------------------------------- batch
def _dealt(rows: DataFrame, task_rows: int) -> DataFrame:
    """``rows`` dealt evenly over tasks of about ``task_rows`` where they lie in fewer (one file may be one task), in an order of their own: seeded starts depend on it."""
    parts = -(-rows.count() // task_rows)
    return rows if rows.rdd.getNumPartitions() >= parts else rows.repartition(parts).sortWithinPartitions(*rows.columns)


def train_batch(df: DataFrame, features: list[str], key: str = "id", jobs: list | None = None,
                folder: str | None = None) -> DataFrame:
    """Min-max the features once (persisted, dealt over tasks of at most about ``TASK_ROWS`` rows), then train each job in isolation.

    With ``folder``, every trained model is saved there as ``{job number}-{algorithm}`` with its labels (key, Cluster)
    and listed in ``{folder}/registry``.  Result rows: (algorithm, metric, value, status)."""
    spark = df.sparkSession
    feats = present(df, features)
    jobs = jobs or [("kmeans", {"n_clusters": 4}), ("gmm", {"n_components": 4}),
                    ("dbscan", {"eps": 1.5, "min_samples": 5})]
    scaler = SC.minmax_fit(df.select(key, *feats), feats)
    norm = _dealt(scaler.transform(df.select(key, *feats)), TASK_ROWS).persist()
    rows = []
    try:
        for number, (algorithm, params) in enumerate(jobs):
            try:
                labelled, model, metrics = train(norm, feats, algorithm, params, key=key)
                if folder:
                    name = f"{number}-{algorithm}"
                    save_model(spark, model, algorithm, f"{folder}/{name}", feats, scaler, f"{folder}/registry", name,
                               labelled.select(key, "Cluster"))
                rows += [(algorithm, k, float(v), "ok") for k, v in metrics.items()]
            except Exception as e:  # each job isolated, as the reference batch script
                rows.append((algorithm, "error", None, f"{type(e).__name__}: {e}"))
    finally:
        norm.unpersist()
    return spark.createDataFrame(rows, "algorithm string, metric string, value double, status string")
