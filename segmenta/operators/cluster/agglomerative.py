"""Agglomerative clustering (M6) and its merge table (M7), exact and distributed.

* ``single_linkage_cut``: the clusters at distance t are the connected components of the graph of vectors within t.
* ``single_linkage``: ``n_clusters`` clusters, by cutting the heaviest edges of the minimum spanning tree.
* ``merge_table``: the last merges; under single linkage, the heaviest edges of that tree.
* ``agglomerative``: ``n_clusters`` clusters under Ward, average, complete (``linkage``) or single linkage.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...session import materialize
from . import blocks as B
from . import linkage as LK
from .components import connected_components, dense_numbering


TREE_BLOCK = 512  # smaller boxes, fewer pairs that are near enough


def _labelled(rows: DataFrame, vec: DataFrame, edges: DataFrame, key: str, label_col: str) -> DataFrame:
    comps = connected_components(vec.select(F.col("vid").alias("id")), edges)
    numbers = dense_numbering(comps, "comp", "cl")
    lab = comps.join(numbers, "comp").select(F.col("id").alias("vid"), F.col("cl").alias(label_col))
    return rows.join(vec.join(lab, "vid").select("v", label_col), "v").select(key, label_col)


def single_linkage_cut(df: DataFrame, features: list[str], distance: float, key: str = "id",
                       label_col: str = "Cluster") -> DataFrame:
    """Exact single-linkage labels at cut ``distance``: (key, label bigint), numbered by smallest key."""
    rows = B.complete_rows(df, features, key)
    vec = B.distinct_vectors(rows, key)
    kind = vec.schema["vid"].dataType.simpleString()
    blocked, pairs = B.tiles(vec, len(features), distance)
    edges = B.over_pairs(blocked, pairs, B.star_edges(distance), f"src {kind}, dst {kind}")
    return _labelled(rows, vec, edges, key, label_col)


def _lightest(points: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
    """Of each component of ``points`` its lightest edge (distance, lo, hi) to another component in ``others``."""
    others = others.sort_values("vid")
    gap = B.distances(B.matrix(points), B.matrix(others))
    gap[points["comp"].to_numpy()[:, None] == others["comp"].to_numpy()[None, :]] = np.inf
    best = gap.argmin(axis=1)  # of equals the smallest vid
    i, j = points["vid"].to_numpy(), others["vid"].to_numpy()[best]
    out = pd.DataFrame({"comp": points["comp"].to_numpy(), "distance": gap[np.arange(len(points)), best], "lo": np.minimum(i, j), "hi": np.maximum(i, j),
                        "other": others["comp"].to_numpy()[best]})
    return out[np.isfinite(out["distance"])].sort_values(["comp", "distance", "lo", "hi"]).drop_duplicates("comp")


def _edges_between(left: pd.DataFrame, right: pd.DataFrame | None) -> pd.DataFrame:
    if not len(left) or right is not None and not len(right):
        none = left["vid"].iloc[:0]
        return pd.DataFrame({"comp": none, "distance": none.astype(float), "lo": none, "hi": none, "other": none})
    return _lightest(left, left) if right is None else pd.concat([_lightest(left, right), _lightest(right, left)])


def _spanning_tree_of(vec: pd.DataFrame) -> pd.DataFrame:
    """The whole tree of the vectors of one block, one vertex after the other; edges are ordered by (distance, lo, hi)."""
    vec = vec.sort_values("vid")
    x, vid = B.matrix(vec), vec["vid"].to_numpy()
    n = len(vid)
    outside = np.arange(1, n)
    gap = B.distances(x[:1], x[1:])[0]
    at = np.zeros(n - 1, int)
    out = []
    while len(outside):
        lo, hi = np.minimum(at, outside), np.maximum(at, outside)
        k = np.lexsort((hi, lo, gap))[0]
        new = outside[k]
        out.append((gap[k], vid[lo[k]], vid[hi[k]]))
        outside, gap, at = (np.delete(z, k) for z in (outside, gap, at))
        step = B.distances(x[[new]], x[outside])[0]
        a_lo, a_hi = np.minimum(at, outside), np.maximum(at, outside)
        b_lo, b_hi = np.minimum(new, outside), np.maximum(new, outside)
        better = (step < gap) | (step == gap) & ((b_lo < a_lo) | (b_lo == a_lo) & (b_hi < a_hi))
        gap, at = np.where(better, step, gap), np.where(better, new, at)
    return pd.DataFrame(out, columns=["distance", "lo", "hi"])


def _promising(state: DataFrame, inner: DataFrame, boxes: DataFrame, n_blocks: int) -> DataFrame:
    """Pairs (a, b) of blocks that may hold a lighter edge of some component than those found inside blocks.

    A component's lightest edge is no longer than the best one found inside a block (``inner``), nor than the farthest corners of
    one of its blocks and a block of others.  A pair farther apart than the bounds of all components in either block is skipped,
    and so is one that holds a single component.
    """
    infinite = F.lit(float("inf"))
    bound = inner.groupBy("comp").agg(F.min("distance").alias("bound"))
    held = state.select("block", "comp").distinct()
    single = held.groupBy("block").agg(F.when(F.count(F.lit(1)) == 1, F.min("comp")).alias("single"))
    known = boxes.join(single, "block")
    b = known.select(*[F.col(c).alias(f"b_{c}") for c in known.columns])
    a = known.select(*[F.col(c).alias(f"a_{c}") for c in known.columns], F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("b_block"))

    def square(x):
        return F.aggregate(x, F.lit(0.0), lambda acc, y: acc + y * y)

    between = F.zip_with(F.zip_with("a_lo", "b_hi", lambda x, y: x - y), F.zip_with("b_lo", "a_hi", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    across = F.zip_with(F.zip_with("a_hi", "b_lo", lambda x, y: x - y), F.zip_with("b_hi", "a_lo", lambda x, y: x - y), lambda x, y: F.greatest(x, y))
    pairs = (a.join(b, "b_block").where((F.col("a_block") != F.col("b_block")) & (F.col("a_single").isNull() | ~F.col("a_single").eqNullSafe(F.col("b_single"))))
             .select("a_block", "b_block", "a_single", F.sqrt(square(between)).alias("least"), F.sqrt(square(across)).alias("most")))
    pairs = materialize(pairs, "block-distances")
    corner = pairs.where(F.col("a_single").isNotNull()).groupBy(F.col("a_single").alias("comp")).agg(F.min("most").alias("corner"))
    limits = (held.join(bound, "comp", "left").join(corner, "comp", "left")
              .groupBy("block").agg(F.max(F.least(F.coalesce("bound", infinite), F.coalesce("corner", infinite))).alias("limit")))
    # a hair wider, for rounding
    near = pairs.join(limits, F.col("a_block") == F.col("block")).where(F.col("least") <= F.col("limit") * (1 + 1e-9))
    return near.select(F.least("a_block", "b_block").alias("a"), F.greatest("a_block", "b_block").alias("b")).distinct()


def spanning_tree(vec: DataFrame, block: int = TREE_BLOCK, local: int = B.BLOCK, report: list | None = None) -> DataFrame:
    """Minimum spanning tree (distance, lo, hi) of the distinct vectors, by Borůvka's rounds.

    In every round each component takes its lightest outgoing edge in the order (distance, lo, hi); at least half of the
    components go.  Blocks are boxes of neighbouring vectors; a round looks inside each block and then only at pairs of blocks whose
    boxes are near enough to matter.  A round gives at most one row per component and pair of blocks.  At most ``local`` vectors
    are one block, whose tree one task makes.  ``report`` gets the pairs met and all pairs of each round.
    """
    kind = vec.schema["vid"].dataType.simpleString()
    tree = vec.select(F.lit(0.0).alias("distance"), F.col("vid").alias("lo"), F.col("vid").alias("hi")).limit(0)
    if vec.limit(local + 1).count() <= local:
        whole = vec.select("vid", "v").withColumn("together", F.lit(0)).groupBy("together")
        return materialize(whole.applyInPandas(_spanning_tree_of, f"distance double, lo {kind}, hi {kind}"), "tree")
    blocked, boxes, n_blocks = B.boxes(vec, block)
    comps = vec.select("vid", F.col("vid").alias("comp"))
    schema = f"comp {kind}, distance double, lo {kind}, hi {kind}, other {kind}"
    while True:
        state = materialize(blocked.join(comps, "vid"), "tree-state")
        inner = materialize(state.groupBy("block").applyInPandas(lambda points: _edges_between(points, None), schema), "tree-inner")
        pairs, met = materialize(_promising(state, inner, boxes, n_blocks), "tree-pairs", [F.count(F.lit(1)).alias("n")])
        if report is not None:
            report.append({"met": met["n"], "all": n_blocks * (n_blocks - 1) // 2})
        found = inner.unionByName(B.over_pairs(state, pairs, _edges_between, schema))
        edge = F.struct("distance", "lo", "hi", "other")
        lightest, seen = materialize(found.groupBy("comp").agg(F.min(edge).alias("e")).select("comp", "e.*"),
                                     "tree-round", [F.count(F.lit(1)).alias("n")])
        if not seen["n"]:
            return tree
        tree = tree.unionByName(lightest.select("distance", "lo", "hi").distinct())
        joined = connected_components(lightest.select(F.col("comp").alias("id")), lightest.select(
            F.col("comp").alias("src"), F.col("other").alias("dst")))
        comps = materialize(comps.withColumnRenamed("comp", "id").join(joined, "id").select("vid", "comp"),
                            "tree-components")


def _heaviest(tree: DataFrame, n: int) -> DataFrame:
    return tree.orderBy(F.desc("distance"), F.desc("lo"), F.desc("hi")).limit(n)


def single_linkage(df: DataFrame, features: list[str], n_clusters: int = 4, key: str = "id",
                   label_col: str = "Cluster") -> DataFrame:
    """Exact single-linkage labels of ``n_clusters`` clusters: (key, label bigint), numbered by smallest key."""
    rows = B.complete_rows(df, features, key)
    vec = B.distinct_vectors(rows, key)
    if vec.limit(n_clusters).count() < n_clusters:
        raise ValueError("not enough distinct records for the requested number of clusters")
    tree = spanning_tree(vec)
    kept = tree.join(_heaviest(tree, n_clusters - 1), ["distance", "lo", "hi"], "left_anti")
    return _labelled(rows, vec, kept.select(F.col("lo").alias("src"), F.col("hi").alias("dst")), key, label_col)


def agglomerative(df: DataFrame, features: list[str], n_clusters: int = 4, linkage: str = "ward", key: str = "id",
                  label_col: str = "Cluster", block: int = LK.BLOCK, local: int = LK.LOCAL) -> DataFrame:
    """M6: (key, label bigint) of ``n_clusters`` clusters, numbered by smallest key.

    Rows without a complete vector have no label; equal vectors share one.  Fewer distinct vectors than clusters is an error.
    """
    if linkage == "single":
        return single_linkage(df, features, n_clusters, key, label_col)
    rows = B.complete_rows(df, features, key)
    vec = B.distinct_vectors(rows, key)
    if vec.limit(n_clusters).count() < n_clusters:
        raise ValueError("not enough distinct records for the requested number of clusters")
    tree = LK.merges(vec, linkage, block, local)
    top = _last(tree, n_clusters - 1)
    kept = tree.join(top, ["distance", "level", "lo", "hi"], "left_anti")
    return _labelled(rows, vec, kept.select(F.col("lo").alias("src"), F.col("hi").alias("dst")), key, label_col)


def _last(tree: DataFrame, n: int) -> DataFrame:
    return tree.orderBy(F.desc("distance"), F.desc("level"), F.desc("lo"), F.desc("hi")).limit(n)


def merge_table(df: DataFrame, features: list[str], last: int = 19, key: str = "id", linkage: str = "single",
                block: int = LK.BLOCK, local: int = LK.LOCAL) -> DataFrame:
    """M7: the ``last`` merges of distinct vectors: (step from 0, left, right, distance, size).

    ``left`` < ``right`` are the smallest keys of the merged clusters, ``size`` the rows of the new one.  Of merges at one
    distance, those that build on others come after them.  Only these ``last`` rows reach the driver.
    """
    if linkage == "single":
        return single_linkage_merges(df, features, last, key)
    vec = B.distinct_vectors(B.complete_rows(df, features, key), key)
    tree = LK.merges(vec, linkage, block, local)
    n = tree.count()
    top = sorted(_last(tree, last).collect(), key=lambda r: (r["distance"], r["level"], r["lo"], r["hi"]))
    kind = vec.schema["vid"].dataType.simpleString()
    return df.sparkSession.createDataFrame(
        [(n - len(top) + k, r["lo"], r["hi"], r["distance"], r["size"]) for k, r in enumerate(top)],
        f"step int, left {kind}, right {kind}, distance double, size long")


def single_linkage_merges(df: DataFrame, features: list[str], last: int = 19, key: str = "id") -> DataFrame:
    """M7 under single linkage: the ``last`` merges of distinct vectors: (step from 0, left, right, distance, size).

    ``left`` < ``right`` are the smallest keys of the merged clusters, ``size`` the rows of the new one.  Only the
    ``last`` heaviest edges and the sizes of the ``last`` + 1 clusters that they join reach the driver.
    """
    vec = B.distinct_vectors(B.complete_rows(df, features, key), key)
    tree = spanning_tree(vec)
    n = tree.count()
    top = _heaviest(tree, last)
    rest = tree.join(top, ["distance", "lo", "hi"], "left_anti")
    comps = materialize(connected_components(vec.select(F.col("vid").alias("id")), rest.select(
        F.col("lo").alias("src"), F.col("hi").alias("dst"))), "merge-components")
    size = {r["comp"]: r["w"] for r in comps.join(vec, comps["id"] == vec["vid"])
            .groupBy("comp").agg(F.sum("w").alias("w")).collect()}
    ends = (top.join(comps.select(F.col("id").alias("lo"), F.col("comp").alias("a")), "lo")
            .join(comps.select(F.col("id").alias("hi"), F.col("comp").alias("b")), "hi"))
    home = {c: c for c in size}
    out = []
    for r in sorted(ends.collect(), key=lambda r: (r["distance"], r["lo"], r["hi"])):
        a, b = r["a"], r["b"]
        while home[a] != a:
            a = home[a]
        while home[b] != b:
            b = home[b]
        a, b = min(a, b), max(a, b)
        home[b] = a
        size[a] += size[b]
        out.append((n - min(last, n) + len(out), a, b, r["distance"], size[a]))
    kind = vec.schema["vid"].dataType.simpleString()
    return df.sparkSession.createDataFrame(out, f"step int, left {kind}, right {kind}, distance double, size long")
