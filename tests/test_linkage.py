"""Ward, average and complete linkage against merging the nearest pair over and over."""

import tracemalloc

import numpy as np
import pandas as pd
import pytest

from segmenta.operators import registry as RG
from segmenta.operators.cluster import agglomerative as AG
from segmenta.operators.cluster import blocks as B
from segmenta.operators.cluster import linkage as LK


def digits(x):
    return float(f"{x:.11e}")


def brute(points, linkage):
    """(distance, left, right, size) of every merge of distinct points; all rows count, clusters are named by their first row."""
    rows = np.asarray(points, float)
    first = {}
    home = np.array([first.setdefault(tuple(p), i) for i, p in enumerate(rows)])
    gaps = np.sqrt(((rows[:, None] - rows[None]) ** 2).sum(-1))
    out = []
    while len(names := sorted(set(home.tolist()))) > 1:
        member = (home[:, None] == np.array(names)[None]).astype(float)
        n = member.sum(axis=0)
        if linkage == "ward":
            mean = member.T @ rows / n[:, None]
            d = np.sqrt(2 * np.outer(n, n) / (n[:, None] + n) * ((mean[:, None] - mean[None]) ** 2).sum(-1))
        elif linkage == "average":
            d = member.T @ gaps @ member / np.outer(n, n)
        else:
            d = np.array([[gaps[np.ix_(home == a, home == b)].max() for b in names] for a in names])
        best = min((digits(d[i, j]), names[i], names[j]) for i in range(len(names)) for j in range(i + 1, len(names)))
        home[home == best[2]] = best[1]
        out.append((*best, int((home == best[1]).sum())))
    return out


def by_place(merges):
    return sorted((round(d, 7), a, b, n) for d, a, b, n in merges)


def frame(spark, points):
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)] + [(10_000, None, 1.0)], "id long, x double, y double").repartition(4)


def grid(seed, n, side):
    return np.random.default_rng(seed).integers(0, side, (n, 2))


@pytest.mark.parametrize("linkage", ["ward", "average", "complete"])
def test_tree_with_ties_and_repeats(spark, linkage):
    points = grid(1, 200, 22)
    want = brute(points, linkage)
    got = AG.merge_table(frame(spark, points), ["x", "y"], last=500, linkage=linkage).collect()
    assert by_place((r.distance, r.left, r.right, r["size"]) for r in got) == by_place(want)
    assert [r.step for r in got] == list(range(len(want)))
    top = AG.merge_table(frame(spark, points), ["x", "y"], last=19, linkage=linkage).collect()
    assert top == got[-19:]
    # every cluster is there before it merges
    born, gone = {}, set()
    for r in got:
        assert r.left not in gone and r.right not in gone and r["size"] > max(born.get(r.left, 0), born.get(r.right, 0))
        born[r.left], gone = r["size"], gone | {r.right}


@pytest.mark.parametrize("linkage", ["ward", "average", "complete"])
def test_rounds_give_the_same_tree(spark, linkage):
    """Small blocks: clusters are spread over several of them, and few merges are left to the last task."""
    points = np.concatenate([grid(2, 60, 12), np.random.default_rng(3).normal(40, 2, (30, 2))])
    got = AG.merge_table(frame(spark, points), ["x", "y"], last=500, linkage=linkage, block=16, local=24).collect()
    assert by_place((r.distance, r.left, r.right, r["size"]) for r in got) == by_place(brute(points, linkage))


@pytest.mark.parametrize("linkage", ["ward", "average", "complete", "single"])
def test_labels(spark, linkage):
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(c, 0.6, (20, 2)) for c in (0, 5, 11)] + [[[0.0, 0.0]] * 3])
    got = {r["id"]: r["Cluster"] for r in AG.agglomerative(frame(spark, points), ["x", "y"], 3, linkage).collect()}
    assert got == {i: min(i // 20, 3) % 3 for i in range(63)}
    with pytest.raises(ValueError):
        AG.agglomerative(frame(spark, points[:2]), ["x", "y"], 3, linkage)


def test_dispatch(spark):
    points = grid(5, 40, 30)
    labelled, model, metrics = RG.train(frame(spark, points), ["x", "y"], "agglomerative", {"n_clusters": 3, "linkage": "complete"})
    assert model is None and -1 <= metrics["Silhouette Score"] <= 1
    assert {r["Cluster"] for r in labelled.collect()} == {0, 1, 2, None}
    with pytest.raises(ValueError):
        RG.train(frame(spark, points), ["x", "y"], "agglomerative", {"linkage": "median"})
    with pytest.raises(ValueError):
        RG.train(frame(spark, points), ["x", "y"], "agglomerative", {"linkage": "ward", "distance": 1.0})


def test_ward_cells_hold_a_strip_of_distances_at_once():
    """A cell of two blocks held some ten matrices of all its distances."""
    rng = np.random.default_rng(3)
    rows = pd.DataFrame({"cid": np.arange(1500), "n": 1, "v": list(rng.random((1500, 2)))})
    tracemalloc.start()
    got = LK._ward_cell(rows, rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * 1500 * 1500
    x = B.matrix(rows)
    one = np.ones(len(rows))
    want = LK.nearest_of(rows["cid"].to_numpy(), rows["cid"].to_numpy(), LK.ward_gaps(x, one, x, one))
    assert got[["cid", "gap", "other"]].reset_index(drop=True).equals(want.reset_index(drop=True))


@pytest.mark.parametrize("linkage", ["ward", "average", "complete"])
def test_boxes_spare_the_rounds_over_all_pairs(spark, linkage, monkeypatch):
    """Points in the plane: every merge but the last few is made inside boxes; the tree is that of one task."""
    rng = np.random.default_rng(6)
    points = np.concatenate([rng.random((500, 2)), rng.integers(0, 9, (150, 2)) / 8, rng.normal(0.5, 0.01, (150, 2))])
    whole = AG.merge_table(frame(spark, points), ["x", "y"], last=900, linkage=linkage).collect()

    def rounds(*args):
        raise AssertionError("all pairs of blocks meet")

    monkeypatch.setattr(LK, "nearest_clusters", rounds)
    got = AG.merge_table(frame(spark, points), ["x", "y"], last=900, linkage=linkage, block=96, local=120).collect()
    assert by_place((r.distance, r.left, r.right, r["size"]) for r in got) == by_place((r.distance, r.left, r.right, r["size"]) for r in whole)


@pytest.mark.parametrize("linkage", ["ward", "average", "complete"])
def test_no_merge_across_a_border(linkage):
    """Two near points merge unless something as near may lie beyond the border."""
    rows = pd.DataFrame({"cid": [1, 2, 3, 4], "vid": [1, 2, 3, 4], "n": 1, "w": 1, "height": 0.0, "level": -1,
                         "s": [[0.5, 0.5], [0.6, 0.5], [0.95, 0.5], [0.97, 0.9]]}).assign(v=lambda f: f["s"])
    done, left, homes = LK.box_merges(linkage, rows, rows, np.array([0.0, -np.inf]), np.array([1.0, np.inf]))
    assert [(r.lo, r.hi) for r in done.itertuples()] == [(1, 2)] and left["n"].tolist() == [2, 1, 1]
    assert homes["home"].tolist() == [1, 1, 3, 4]
    done, left, _ = LK.box_merges(linkage, rows, rows, np.full(2, -np.inf), np.full(2, np.inf))
    assert len(done) == 3 and left["n"].tolist() == [4]


@pytest.mark.parametrize("points", [grid(7, 300, 12), np.random.default_rng(8).normal(0, 1, (300, 2)), np.stack([np.arange(40), 2 * np.arange(40)], 1),
                                    np.random.default_rng(9).random((50, 1)), np.random.default_rng(9).random((50, 3))])
def test_corners_hold_the_farthest(points):
    x = np.asarray(points, float)
    places = np.random.default_rng(10).normal(0, 30, (200, x.shape[1]))
    kept = x[LK.corners(x)]
    assert np.array_equal(B.distances(places, kept).max(axis=1), B.distances(places, x).max(axis=1))
    assert x.shape[1] > 2 or len(kept) < len(x)
