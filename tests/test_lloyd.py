"""Many starts in the same scans: each run is the one that it would be alone, and more runs need no more scans."""

import numpy as np
import pytest

from segmenta.operators import registry as RG
from segmenta.operators.cluster import kmeans as KM
from segmenta.operators.cluster import lloyd as LL


def frame(spark, x):
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)] + [(10_000, None, 1.0)], "id long, x double, y double").repartition(4)


def plain(x, centers, rounds=300):
    centers = np.array(centers, float)
    for _ in range(rounds):
        near = ((x[:, None] - centers) ** 2).sum(-1).argmin(1)
        new = np.array([x[near == k].mean(0) if (near == k).any() else c for k, c in enumerate(centers)])
        moved = np.sqrt(((new - centers) ** 2).sum(1)).max()
        centers = new
        if moved <= 1e-4:
            break
    return centers, ((x[:, None] - centers) ** 2).sum(-1).min(1).sum()


def test_runs_together_and_alone(spark):
    rng = np.random.default_rng(1)
    x = np.round(np.vstack([rng.normal(c, 1, (60, 2)) for c in ((0, 0), (6, 0), (0, 7), (5, 6))]), 1)
    vec = LL.weighted_vectors(frame(spark, np.vstack([x, x[:50]])), ["x", "y"])
    passes = {n: [] for n in (1, 6)}
    starts = {n: LL.seeded_starts(vec, 4, n, 42, passes[n]) for n in (1, 6)}
    assert np.array_equal(starts[1][0], starts[6][0]) and len(passes[1]) == len(passes[6]) == 4
    assert all(len({tuple(c) for c in s}) == 4 for s in starts[6]) and len({tuple(s[0]) for s in starts[6]}) > 1
    seen = []
    runs = LL.lloyd(vec, starts[6], passes=seen)
    data = np.vstack([x, x[:50]])
    rounds = []
    for start, (centers, cost, n) in zip(starts[6], runs):
        want = plain(data, start)
        assert centers == pytest.approx(want[0]) and cost == pytest.approx(want[1]) and n.sum() == len(data)
        alone = []
        LL.lloyd(vec, [start], passes=alone)
        rounds.append(len(alone))
    assert len(seen) == max(rounds)
    res = KM.kmeans_fit(frame(spark, data), ["x", "y"], 4, seed=42, restarts=6)
    assert res.cost == pytest.approx(min(r[1] for r in runs))


def test_awkward_starts(spark):
    vec = LL.weighted_vectors(frame(spark, [(0, 0), (0, 0), (1, 1)]), ["x", "y"])
    with pytest.raises(ValueError):
        LL.seeded_starts(vec, 3, 2)
    (centers, cost, n), = LL.lloyd(vec, [[(0, 0), (50, 50)]])
    assert centers.tolist() == [[pytest.approx(1 / 3)] * 2, [50, 50]] and n.tolist() == [3, 0]


def test_saved_without_a_fitted_estimator(spark, scratch):
    df = frame(spark, [(0, 0), (0, 1), (9, 9), (9, 8)]).dropna()
    res = KM.kmeans_fit(df, ["x", "y"], 2, restarts=3)
    RG.save_model(spark, res, "kmeans", f"{scratch}/m", ["x", "y"])
    got = {r["id"]: r["Cluster"] for r in RG.classify(spark, f"{scratch}/m", df).collect()}
    assert got[0] == got[1] != got[2] == got[3]
