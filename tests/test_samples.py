"""Sampled silhouette, seeded caps, deep pages, bracketed quantiles and pair moments."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmenta.operators import crosstabs as X
from segmenta.operators import evaluate as EV
from segmenta.operators import filters as P
from segmenta.operators import pages as PI
from segmenta.operators import pca as PC
from segmenta.operators import quantiles as Q


def test_sampled_silhouette(spark):
    rng = np.random.default_rng(1)
    x, lab = np.round(rng.normal(0, 1, (600, 2)), 1), rng.integers(0, 3, 600)
    x[:, 0] += 3 * lab
    df = spark.createDataFrame([(i, *map(float, p), int(c)) for i, (p, c) in enumerate(zip(x, lab))], "id long, x double, y double, Cluster int")
    exact = EV.silhouette(df, ["x", "y"]).first()["value"]
    whole = EV.silhouette_sampled(df, ["x", "y"], fraction=1.0, block=100).first()
    assert whole["value"] == pytest.approx(exact) and whole["standard_error"] == 0 and whole["rows"] == 600
    parts = [EV.silhouette_sampled(df.repartition(n), ["x", "y"], fraction=0.3, seed=5).first() for n in (1, 6)]
    assert parts[0] == parts[1] or parts[0]["value"] == pytest.approx(parts[1]["value"])
    assert 100 < parts[0]["rows"] < 260 and abs(parts[0]["value"] - exact) < 4 * parts[0]["standard_error"]
    one = EV.silhouette_sampled(df.withColumn("Cluster", F.lit(0)), ["x", "y"]).first()
    assert one["value"] == 0.0


def test_cap_per_group(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 900, 0).when(F.col("id") < 995, 1).otherwise(F.lit(None)).alias("c"))
    got = [P.cap_per_group(df.repartition(n), "c", "id", 7, seed=3).collect() for n in (1, 9)]
    assert sorted(r["id"] for r in got[0]) == sorted(r["id"] for r in got[1])
    assert sorted([r["c"] for r in got[0]], key=str) == [0] * 7 + [1] * 7 + [None] * 5
    assert "WindowGroupLimit" in P.cap_per_group(df, "c", "id", 7)._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        P.scatter_series(df, ["id"], "c", cap=3)


def test_deep_pages(spark, scratch):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("x")).repartition(5)
    path = PI.build_page_index(df, ["x", "k"], f"{scratch}/index", part_rows=400)
    want = [(r["k"], r["x"]) for r in df.orderBy("x", "k").collect()]
    for number, size in ((1, 10), (37, 100), (50, 100), (7, 700), (51, 100), (10 ** 6, 100)):
        page = PI.page_of_index(spark, path, ["x", "k"], number, size)
        assert [(r["k"], r["x"]) for r in page.collect()] == want[(number - 1) * size:number * size]
    page = PI.page_of_index(spark, path, ["x", "k"], 400, 10)
    filters = page._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "part#" in filters and filters.count(" = ") == 1, filters  # one part is read


def _quantile(values, p):
    values = np.sort(np.array(values, float))  # NaN last
    at = p * (len(values) - 1)
    lo = int(at)
    return values[lo] + (at - lo) * (values[min(lo + 1, len(values) - 1)] - values[lo])


def test_bracketed_quantiles(spark, monkeypatch):
    monkeypatch.setattr(Q, "FEW", 50)
    rng = np.random.default_rng(2)
    n = 20_000
    data = {"wide": rng.normal(1e6, 1, n), "few": rng.integers(0, 4, n).astype(float), "one": np.full(n, 3.0), "skew": np.exp(rng.normal(0, 4, n)),
            "odd": np.where(rng.random(n) < 0.4, np.nan, rng.random(n))}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*data.values())], ", ".join(f"{c} double" for c in data)).repartition(4)
    df = df.withColumn("text", F.when(F.rand(3) < 0.5, F.col("few").cast("string")).otherwise("x")).withColumn("none", F.lit(None).cast("double"))
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = {(r["column"], r["p"]): r["value"] for r in Q.bracketed_quantiles(df, [*data, "none"], probs).collect()}
    want = {(c, p): _quantile(v, p) for c, v in data.items() for p in probs}
    assert got.keys() == want.keys() and got == pytest.approx(want, nan_ok=True)


def test_bracketed_quantiles_move_few_values(spark):
    df = spark.range(300_000).select(F.rand(5).alias("x"))
    seen = []
    original = Q._read_off

    def spy(num, spots):
        seen.extend(s["inside"] for s in spots)
        return original(num, spots)

    Q._read_off = spy
    try:
        got = Q.bracketed_quantiles(df, ["x"], (0.5,)).first()["value"]
    finally:
        Q._read_off = original
    assert got == pytest.approx(Q.quantiles_long(df, ["x"], (0.5,)).first()["value"]) and seen[0] < 3000


def test_pair_moments(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (500, 4)) @ rng.normal(0, 1, (4, 4)) + 1e7
    x[rng.random((500, 4)) < 0.2] = np.nan
    x = np.hstack([x, np.full((500, 1), 0.1), np.full((500, 1), np.nan)])
    cols = [f"k{i}" for i in range(6)]
    df = spark.createDataFrame([tuple(None if i % 2 and np.isnan(v) else float(v) for i, v in enumerate(r)) for r in x], ", ".join(f"{c} double" for c in cols)).repartition(5)
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in X.correlation_matrix(df, cols).collect()}
    assert len(got) == 36
    for i in range(6):
        for j in range(6):
            ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            constant = not ok.any() or np.ptp(x[ok, i]) == 0 or np.ptp(x[ok, j]) == 0
            want = None if constant else 1.0 if i == j else pytest.approx(np.corrcoef(x[ok, i], x[ok, j])[0, 1], abs=1e-9)
            assert got[cols[i], cols[j]] == want
    cov = {(r["col_a"], r["col_b"]): r["cov"] for r in PC.covariance_matrix(df, cols[:4]).collect()}
    full = x[~np.isnan(x[:, :4]).any(axis=1), :4]
    assert cov == pytest.approx({(cols[i], cols[j]): c for i, r in enumerate(np.cov(full.T)) for j, c in enumerate(r)}, rel=1e-9)
    assert "Generate" not in X.correlation_matrix(df, cols)._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[1]
