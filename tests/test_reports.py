"""Report tables (R1/R2), train-and-save (M3b) and batch training isolation."""

import pytest
from pyspark.sql import functions as F

from segmenta.operators import registry as RG
from segmenta.operators import reports as RP


def test_executive_summary(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate([0, 0, 0, 1, 1, 2])], "id long, Cluster int")
    rows = {(r["section"], r["item"]): r["value"] for r in
            RP.executive_summary(df, "kmeans", {"Silhouette Score": 0.3, "Inertia": 12.0}).collect()}
    assert rows[("algorithm", "name")] == "KMEANS"
    assert rows[("metric", "Silhouette Score")] == "0.3000"
    assert rows[("quality", "Silhouette Score")] == "acceptable"
    assert rows[("size", "0")] == "3" and rows[("share", "0")] == "50.0"
    assert rows[("dominant", "0")] == "50.0" and rows[("minority", "2")] == "16.7"


def test_chart_tables(spark):
    df = spark.createDataFrame([(1, 0, "Leo", 1.0), (2, 0, "Leo", 2.0), (3, 1, None, 3.0)],
                               "id long, Cluster int, signo string, p1 double")
    t = RP.chart_tables(df, ["p1"])
    assert [tuple(r) for r in t["sign_by_cluster"].collect()] == [(0, "Leo", 2)]
    assert {r["cluster"]: r["mean"] for r in t["cluster_profile"].collect()} == {0: 1.5, 1: 3.0}


def test_train_and_save_and_batch(spark, scratch):
    rows = [(i + 1, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (0, 1), (1, 0), (9, 9), (9, 10), (10, 9)])]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    labelled = RG.train_and_save(spark, df, ["x", "y"], 2, f"{scratch}/m", registry=f"{scratch}/reg", name="m")
    labs = [r["Cluster"] for r in labelled.orderBy("id").collect()]
    assert labs[0] == labs[1] == labs[2] != labs[3] == labs[4] == labs[5]
    assert [r["Cluster"] for r in RG.classify(spark, f"{scratch}/m", df).orderBy("id").collect()] == labs
    with pytest.raises(ValueError):
        RG.train_and_save(spark, df, ["x"], 2, f"{scratch}/m2", min_features=2)
    out = RG.train_batch(df, ["x", "y"], key="id",
                         jobs=[("kmeans", {"n_clusters": 2}), ("kmeans", {"n_clusters": 50}),
                               ("dbscan", {"eps": 1.5, "min_samples": 2})])
    res = out.collect()
    assert any(r["algorithm"] == "kmeans" and r["status"] == "ok" and r["metric"] == "Inertia" for r in res)
    assert any(r["status"].startswith("ValueError") for r in res)          # k > n isolated, batch continues
    assert any(r["algorithm"] == "dbscan" and r["metric"] == "Noise points" and r["value"] == 0.0 for r in res)


def test_batch_deals_its_rows_over_tasks(spark, monkeypatch):
    """Rows of one file lay in one task, which each iteration of each fit went through alone."""
    df = spark.createDataFrame([(i, float(i % 7), float(i // 50)) for i in range(100)], "id long, x double, y double").coalesce(1)
    seen = []

    def train(rows, *args, **kwargs):
        sizes = rows.groupBy(F.spark_partition_id()).count().collect()
        seen.append(([r["count"] for r in sizes], sorted(tuple(r) for r in rows.collect())))
        return rows, None, {"n": 1.0}

    monkeypatch.setattr(RG, "train", train)
    RG.train_batch(df, ["x", "y"], key="id", jobs=[("kmeans", {})])
    monkeypatch.setattr(RG, "TASK_ROWS", 10)
    RG.train_batch(df, ["x", "y"], key="id", jobs=[("kmeans", {})])
    assert seen[0][0] == [100] and sorted(seen[1][0]) == [10] * 10 and seen[0][1] == seen[1][1]


def test_silhouette_of_one_cluster_meets_no_pairs(spark, monkeypatch):
    from segmenta.operators import evaluate as EV

    monkeypatch.setattr(EV.B, "over_pairs", lambda *a: pytest.fail("pairs of blocks meet"))
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (None, 3.0)], "Cluster int, x double")
    assert [tuple(r) for r in EV.silhouette(df, ["x"]).collect()] == [("silhouette_exact", 0.0)]
    assert [tuple(r) for r in EV.silhouette(df.limit(0), ["x"]).collect()] == [("silhouette_exact", 0.0)]
