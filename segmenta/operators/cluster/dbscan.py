"""DBSCAN (M4) as DataFrame operations.

Definition matched: a point is core when its closed eps-ball (itself counted)
holds >= ``min_samples`` points; clusters are the connected components of core
points, numbered 0.. by their smallest core row key; a border point takes the
lowest-numbered cluster among its core neighbours; every other point is -1.

Plan: identical vectors become one weighted row, and three passes over pairs of
neighbouring blocks (``blocks``) give at most a few rows per vector and partner block, never a row per
pair of vectors: neighbour counts, star edges between core vectors, and the lowest cluster next to a border vector.
Crowded cells (``crowds``) take part as one vertex each; their members are neither counted nor compared with each other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...session import materialize
from . import blocks as B
from .components import connected_components, dense_numbering
from .crowds import CROWD, crowd_links, crowded_tiles

_NONE = np.iinfo(np.int64).max


def _count_work(eps: float):
    def counted(points: pd.DataFrame, near: np.ndarray, others: pd.DataFrame) -> pd.DataFrame:
        rows = ~points["crowded"].to_numpy(bool)
        return pd.DataFrame({"vid": points["vid"][rows], "nw": near[rows] @ others["w"].to_numpy(np.int64)})

    def work(left: pd.DataFrame, right: pd.DataFrame | None) -> pd.DataFrame:
        same = right is None
        left, right, near = B.close(left, right, eps)
        if not len(left):
            return pd.DataFrame({"vid": left["vid"], "nw": left["w"]})
        found = counted(left, near, right)
        return found if same else pd.concat([found, counted(right, near.T, left)])

    return work


def _edge_work(eps: float):
    """Star edges among core vectors that are not crowded, and one from each of them to the hub of a crowded cell it is near to."""
    stars = B.star_edges(eps)

    def work(left: pd.DataFrame, right: pd.DataFrame | None) -> pd.DataFrame:
        if right is None or not len(left) or not len(right) or not (left["crowded"].iat[0] or right["crowded"].iat[0]):
            return stars(left, right)
        points, members = (right, left) if left["crowded"].iat[0] else (left, right)
        points, members, near = B.close(points, members, eps)
        if not len(points):
            return pd.DataFrame({"src": points["vid"], "dst": points["vid"]})
        met = points["vid"][near.any(axis=1)]
        return pd.DataFrame({"src": met, "dst": np.full(len(met), members["hub"].iat[0])})

    return work


def _border_work(eps: float):
    def lowest(near: np.ndarray, points: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        rows, cols = (points["cl"] < 0).to_numpy(), (others["cl"] >= 0).to_numpy()
        near, labels = near[np.ix_(rows, cols)], others["cl"].to_numpy(np.int64)[cols]
        best = np.where(near, labels[None, :], _NONE).min(axis=1, initial=_NONE)
        return pd.DataFrame({"vid": points["vid"][rows], "cl": best})[best < _NONE]

    def work(left: pd.DataFrame, right: pd.DataFrame | None) -> pd.DataFrame:
        same = right is None
        left, right, near = B.close(left, right, eps)
        if not len(left):
            return pd.DataFrame({"vid": left["vid"], "cl": left["cl"]})
        found = lowest(near, left, right)
        return found if same else pd.concat([found, lowest(near.T, right, left)])

    return work


def dbscan(df: DataFrame, features: list[str], eps: float = 0.5, min_samples: int = 5, key: str = "id",
           label_col: str = "Cluster", block: int = B.BLOCK, crowd: int = CROWD) -> DataFrame:
    """Label every row with a complete feature vector: (key, label_col bigint). No rows give no rows."""
    if eps <= 0 or min_samples < 1:
        raise ValueError("dbscan: eps must be > 0 and min_samples >= 1")
    rows = B.complete_rows(df, features, key)
    vec = B.distinct_vectors(rows, key)
    kind = vec.schema["vid"].dataType.simpleString()
    blocked, pairs, crowds = crowded_tiles(vec, len(features), eps, min_samples, block, crowd)
    counts = B.over_pairs(blocked, pairs, _count_work(eps), f"vid {kind}, nw long")
    core = materialize(counts.groupBy("vid").agg(F.sum("nw").alias("nw")).where(F.col("nw") >= min_samples)
                       .select("vid"), "core")
    members = blocked.where("crowded")
    edges = B.over_pairs(blocked.where("not crowded").join(core, "vid").unionByName(members), pairs, _edge_work(eps), f"src {kind}, dst {kind}")
    hubs = members.select(F.col("hub").alias("id")).distinct()
    comps = connected_components(core.select(F.col("vid").alias("id")).unionByName(hubs), edges.unionByName(crowd_links(blocked, crowds, eps)))
    numbered = materialize(comps.join(dense_numbering(comps, "comp", "cl"), "comp").select("id", "cl"), "core-numbers")
    labels = materialize(blocked.join(core.withColumn("own", F.lit(True)), "vid", "left").where("crowded or own")
                         .join(numbered, F.col("hub") == F.col("id")).select("vid", "cl"), "core-labels")
    marked = blocked.join(labels, "vid", "left").withColumn("cl", F.coalesce("cl", F.lit(-1).cast("long")))
    border = (B.over_pairs(marked, pairs, _border_work(eps), f"vid {kind}, cl long")
              .groupBy("vid").agg(F.min("cl").alias("cl")))
    known = vec.join(labels.unionByName(border), "vid", "left")
    out = rows.join(known.select("v", "cl"), "v").select(
        key, F.coalesce("cl", F.lit(-1).cast("long")).alias(label_col))
    return materialize(out, "dbscan-labels")
