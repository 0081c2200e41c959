"""Property and hand-made tests for the clustering operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmenta.operators import evaluate as EV
from segmenta.operators import pca as PC
from segmenta.operators import registry as RG
from segmenta.operators import scaling as SC
from segmenta.operators.cluster import agglomerative as AG
from segmenta.operators.cluster import blocks as BL
from segmenta.operators.cluster import dbscan as DB
from segmenta.operators.cluster import gmm as GM
from segmenta.operators.cluster import kmeans as KM
from segmenta.operators.cluster.assign import assign_nearest, inertia


def _pts(spark, rows):
    return spark.createDataFrame([(i + 1, float(x), float(y)) for i, (x, y) in enumerate(rows)],
                                 "id long, x double, y double")


def _brute_dbscan(X, eps, min_samples):
    n = len(X)
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    nb = D <= eps
    core = nb.sum(1) >= min_samples
    comp = -np.ones(n, dtype=int)
    for i in range(n):
        if core[i] and comp[i] < 0:
            stack, comp[i] = [i], i
            while stack:
                u = stack.pop()
                for v in np.where(nb[u] & core)[0]:
                    if comp[v] < 0:
                        comp[v] = i
                        stack.append(v)
    roots = sorted({c for c in comp if c >= 0})
    num = {r: k for k, r in enumerate(roots)}
    lab = np.array([num[c] if c >= 0 else -1 for c in comp])
    for i in range(n):
        if not core[i]:
            cl = [lab[j] for j in np.where(nb[i] & core)[0]]
            lab[i] = min(cl) if cl else -1
    return lab


def test_dbscan_border_noise_duplicates(spark):
    rows = [(0, 0), (0, 0.5), (0.5, 0), (0.5, 0.5),          # cluster A
            (1.0, 0.25),                                    # within eps of A and B (core: 5 neighbours)
            (1.5, 0), (1.5, 0.5), (2.0, 0), (2.0, 0.5),     # cluster B
            (9, 9), (9, 9), (9, 9),                         # duplicates reaching min_samples=3
            (5, 5)]                                         # noise
    df = _pts(spark, rows)
    got = {r["id"]: r["Cluster"] for r in DB.dbscan(df, ["x", "y"], eps=0.6, min_samples=3).collect()}
    want = _brute_dbscan(np.array(rows, dtype=float), 0.6, 3)
    assert [got[i + 1] for i in range(len(rows))] == list(want)
    assert got[13] == -1 and got[10] == got[11] == got[12] != -1


def test_dbscan_all_noise(spark):
    df = _pts(spark, [(0, 0), (5, 5), (10, 10)])
    assert {r["Cluster"] for r in DB.dbscan(df, ["x", "y"], eps=0.5, min_samples=2).collect()} == {-1}


def test_dbscan_matches_brute_force_and_is_partition_invariant(spark):
    rng = np.random.default_rng(7)
    X = np.round(np.vstack([rng.normal(0, 0.3, (60, 3)), rng.normal(2, 0.3, (60, 3))]), 2)
    df = spark.createDataFrame([(i + 1, *map(float, r)) for i, r in enumerate(X)], "id long, a double, b double, c double")
    want = _brute_dbscan(X, 0.35, 4)
    for parts in (1, 7):
        got = {r["id"]: r["Cluster"] for r in DB.dbscan(df.repartition(parts), ["a", "b", "c"], 0.35, 4).collect()}
        assert [got[i + 1] for i in range(len(X))] == list(want)


def test_kmeans_assignment_and_inertia(spark):
    rng = np.random.default_rng(1)
    X = np.vstack([rng.normal(0, 0.2, (40, 2)), rng.normal(3, 0.2, (40, 2))])
    df = _pts(spark, X.tolist())
    labelled, res = KM.kmeans(df, ["x", "y"], k=2, seed=42, restarts=2)
    C = np.array(res.centroids)
    d2 = ((X[:, None] - C[None]) ** 2).sum(-1)
    got = np.array([r["Cluster"] for r in labelled.orderBy("id").collect()])
    assert (got == d2.argmin(1)).all()
    assert inertia(df, ["x", "y"], res.centroids).first()[0] == pytest.approx(res.cost, rel=1e-6)


def test_not_enough_rows(spark):
    with pytest.raises(ValueError):
        KM.kmeans_fit(_pts(spark, [(0, 0), (1, 1)]), ["x", "y"], k=3)


def test_gmm_bic_aic(spark):
    rng = np.random.default_rng(3)
    X = np.vstack([rng.normal(0, 0.3, (30, 2)), rng.normal(4, 0.3, (30, 2))])
    res = GM.gmm_fit(_pts(spark, X.tolist()), ["x", "y"], k=2, seed=42, restarts=3)
    p = 2 * 3 + 2 * 2 + 1
    assert res.bic == pytest.approx(-2 * res.log_likelihood + p * np.log(60))
    assert res.aic == pytest.approx(-2 * res.log_likelihood + 2 * p)
    assert sorted(round(w, 1) for w in res.weights) == [0.5, 0.5]


def test_pca_centred_scores(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(0, 1, (50, 3)) @ np.array([[2, 0, 0], [0.5, 1, 0], [0, 0, 0.2]])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(X)], "id long, a double, b double, c double")
    scores, res = PC.pca(df, ["a", "b", "c"], n_components=2)
    S = np.array([[r["PC1"], r["PC2"]] for r in scores.collect()])
    assert np.allclose(S.mean(0), 0, atol=1e-9)
    ev = np.linalg.eigvalsh(np.cov(X.T))[::-1]
    assert np.allclose(S.var(0, ddof=1), ev[:2], rtol=1e-6)
    assert np.allclose(res.explained_variance_ratio, ev[:2] / ev.sum(), rtol=1e-6)
    with pytest.raises(ValueError):
        PC.pca_fit(df, ["a", "b", "c"], n_components=4)


def _brute_silhouette(X, lab):
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    s = []
    for i in range(len(X)):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


def test_silhouette_exact_with_duplicates_and_singleton(spark):
    rows = [(0, 0), (0, 0), (0, 1), (1, 0), (5, 5), (5, 6), (6, 5), (6, 6), (20, 20)]
    lab = np.array([0, 0, 0, 0, 1, 1, 1, 1, 2])
    df = spark.createDataFrame([(float(x), float(y), int(l)) for (x, y), l in zip(rows, lab)],
                               "x double, y double, Cluster int")
    got = EV.silhouette(df, ["x", "y"], "Cluster").first()["value"]
    assert got == pytest.approx(_brute_silhouette(np.array(rows, float), lab))
    one = df.withColumn("Cluster", F.lit(0))
    assert EV.silhouette(one, ["x", "y"], "Cluster").first()["value"] == 0.0


def test_silhouette_exact_over_several_blocks(spark):
    rng = np.random.default_rng(4)
    X, lab = rng.normal(0, 1, (4500, 2)), rng.integers(0, 3, 4500)
    df = spark.createDataFrame([(*map(float, x), int(l)) for x, l in zip(X, lab)], "x double, y double, Cluster int")
    got = EV.silhouette(df, ["x", "y"], "Cluster").first()["value"]
    assert got == pytest.approx(_brute_silhouette(X, lab))


def test_single_linkage_cut(spark):
    df = _pts(spark, [(0, 0), (0, 1), (0, 2), (5, 0), (5, 0.5), (9, 9)])
    got = [r["Cluster"] for r in AG.single_linkage_cut(df, ["x", "y"], 1.0).orderBy("id").collect()]
    assert got == [0, 0, 0, 1, 1, 2]


def _brute_merges(X):
    """Single linkage step by step: (distance, left, right, size) with clusters named by their smallest row."""
    groups = {i: [i] for i in range(len(X))}
    out = []
    while len(groups) > 1:
        d, a, b = min((np.sqrt(((X[groups[a]][:, None] - X[groups[b]][None]) ** 2).sum(-1)).min(), a, b)
                      for a in groups for b in groups if a < b)
        groups[a] += groups.pop(b)
        out.append((d, a, b, len(groups[a])))
    return out


def test_single_linkage_matches_brute_force(spark):
    rng = np.random.default_rng(8)
    X = rng.normal(0, 1, (24, 2))
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(X)], "id long, x double, y double")
    want = _brute_merges(X)
    got = AG.merge_table(df, ["x", "y"], last=15).orderBy("step").collect()
    assert [(r["step"], r["left"], r["right"], r["size"]) for r in got] == [
        (n, *w[1:]) for n, w in enumerate(want)][-15:]
    assert [r["distance"] for r in got] == pytest.approx([w[0] for w in want[-15:]])
    home = list(range(24))
    for _, a, b, _ in want[:20]:
        home = [a if h == b else h for h in home]
    number = {h: n for n, h in enumerate(sorted(set(home)))}
    lab = {r["id"]: r["Cluster"] for r in AG.single_linkage(df, ["x", "y"], 4).collect()}
    assert lab == {i: number[h] for i, h in enumerate(home)}
    with pytest.raises(ValueError):
        AG.single_linkage(df, ["x", "y"], 25)


def test_blocks_give_linear_rows_and_no_rows_are_fine(spark):
    df = spark.createDataFrame([(i, i % 60 / 60, i // 60 / 60) for i in range(3600)], "id long, x double, y double")
    vec = BL.distinct_vectors(BL.complete_rows(df, ["x", "y"], "id"), "id")
    blocked, pairs = BL.tiles(vec, 2, 5.0)  # eps beyond the span: everything is near everything
    edges = BL.over_pairs(blocked, pairs, BL.star_edges(5.0), "src long, dst long").count()
    assert edges <= 3600 * pairs.count()
    assert {r["Cluster"] for r in DB.dbscan(df, ["x", "y"], 5.0, 4).collect()} == {0}
    none = df.where("false")
    assert DB.dbscan(none, ["x", "y"], 0.5, 4).count() == 0
    assert AG.single_linkage_cut(none, ["x", "y"], 0.5).count() == 0


def test_batch_saves_models_and_labels(spark, scratch):
    df = _pts(spark, [(0, 0), (0, 1), (1, 0), (10, 10), (10, 11), (11, 10)])
    folder = f"{scratch}/batch"
    RG.train_batch(df, ["x", "y"], key="id", folder=folder,
                   jobs=[("kmeans", {"n_clusters": 2}), ("dbscan", {"eps": 0.3, "min_samples": 2}),
                         ("agglomerative", {"n_clusters": 2})])
    assert [r["name"] for r in RG.list_models(spark, f"{folder}/registry").collect()] == [
        "0-kmeans", "1-dbscan", "2-agglomerative"]
    for name in ("1-dbscan", "2-agglomerative"):
        assert [r["Cluster"] for r in spark.read.parquet(f"{folder}/{name}/labels").orderBy("id").collect()] == [
            0, 0, 0, 1, 1, 1]


def test_save_load_classify_roundtrip(spark, scratch):
    df = _pts(spark, [(0, 0), (0, 1), (1, 0), (10, 10), (10, 11), (11, 10)])
    scaler = SC.standard_fit(df, ["x", "y"])
    res = KM.kmeans_fit(scaler.transform(df), ["x", "y"], k=2, seed=1)
    path = f"{scratch}/m1"
    RG.save_model(spark, res, "kmeans", path, ["x", "y"], scaler, registry=f"{scratch}/registry", name="m1")
    a = [r["Cluster"] for r in res.transform(scaler.transform(df)).orderBy("id").collect()]
    b = [r["Cluster"] for r in RG.classify(spark, path, df).orderBy("id").collect()]
    assert a == b
    assert [r["name"] for r in RG.list_models(spark, f"{scratch}/registry").collect()] == ["m1"]
    with pytest.raises(FileNotFoundError):
        RG.load_model(spark, f"{scratch}/missing")
    RG.save_model(spark, None, "dbscan", f"{scratch}/m2", ["x", "y"])
    with pytest.raises(TypeError):
        RG.classify(spark, f"{scratch}/m2", df)


def test_dispatch_unknown_algorithm(spark):
    with pytest.raises(ValueError):
        RG.train(_pts(spark, [(0, 0)]), ["x", "y"], "spectral")


@pytest.mark.parametrize("eps,min_samples", [(0.35, 4), (0.9, 30), (3.0, 4)])
def test_dbscan_with_crowded_cells(spark, eps, min_samples):
    """Cells of a few vectors already count as crowded, and blocks are small: labels stay those of brute force."""
    rng = np.random.default_rng(11)
    X = np.round(np.vstack([rng.normal(0, 0.15, (120, 2)), rng.normal(1.2, 0.1, (60, 2)), rng.uniform(-3, 4, (60, 2)), [[0.0, 0.0]] * 40]), 2)
    df = _pts(spark, X.tolist())
    got = {r["id"]: r["Cluster"] for r in DB.dbscan(df, ["x", "y"], eps, min_samples, block=16, crowd=6).collect()}
    assert [got[i + 1] for i in range(len(X))] == list(_brute_dbscan(X, eps, min_samples))


def test_crowded_cells_apart_are_compared_whole(spark):
    """Two crowded cells whose only near pair lies outside the blocks tried first."""
    rng = np.random.default_rng(12)
    a, b = rng.uniform(0, 0.5, (80, 1)), rng.uniform(1.55, 1.95, (80, 1))
    X = np.hstack([np.vstack([a, b, [[0.69]], [[1.68]]]), np.zeros((162, 1))])
    for eps in (1.0, 0.9):
        got = {r["id"]: r["Cluster"] for r in DB.dbscan(_pts(spark, X.tolist()), ["x", "y"], eps, 5, block=8, crowd=6).collect()}
        assert [got[i + 1] for i in range(len(X))] == list(_brute_dbscan(X, eps, 5))


def test_a_crowd_is_linear(spark):
    """90 % of the rows in one cell: block pairs grow with the rows, not with their square."""
    from segmenta.operators.cluster.crowds import crowded_tiles

    sizes = []
    for n in (4000, 16000):
        df = spark.range(n).select("id", F.when(F.col("id") % 10 > 0, F.rand(1) * 0.1).otherwise(5 + F.rand(2) * 100).alias("x"),
                                   F.when(F.col("id") % 10 > 0, F.rand(3) * 0.1).otherwise(5 + F.rand(4) * 100).alias("y"))
        vec = BL.distinct_vectors(BL.complete_rows(df, ["x", "y"], "id"), "id")
        blocked, pairs, crowds = crowded_tiles(vec, 2, 1.0, 5, block=128)
        assert blocked.where("crowded").count() == n * 9 // 10 and crowds.count() == 0
        sizes.append(pairs.count())
    assert sizes[1] <= 5 * sizes[0]


def test_spanning_tree_meets_few_pairs_of_blocks(spark):
    """Boxes far apart are skipped: the merges are those of one task, from under a tenth of the pairs."""
    rng = np.random.default_rng(13)
    X = np.vstack([rng.uniform(0, 10, (700, 2)), rng.normal(30, 0.5, (80, 2)), np.round(rng.uniform(0, 10, (60, 2)))])
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(X)], "id long, x double, y double")
    vec = BL.distinct_vectors(BL.complete_rows(df, ["x", "y"], "id"), "id")
    report = []
    rounds = AG.spanning_tree(vec, block=8, local=10, report=report)
    whole = AG.spanning_tree(vec, local=5000)
    edges = [sorted((r["distance"], r["lo"], r["hi"]) for r in t.collect()) for t in (rounds, whole)]
    assert edges[0] == edges[1] and len(edges[0]) == vec.count() - 1
    assert all(r["met"] * 10 < r["all"] for r in report), report
