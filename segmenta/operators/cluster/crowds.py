"""Crowded places of a density clustering: cells whose members are all within eps of each other.

A cell is a cube of side eps / sqrt(dimensions) inside a tile.  One that holds at least ``crowd`` vectors, and at least
``min_samples`` rows, is *crowded*: its members are core without being counted and belong together without being
compared.  It gets blocks of its own, so that only what lies within eps of the cell is compared with its members.  Two
crowded cells are linked by a first pair within eps, searched in one block of each; only cells that all these links
leave apart are compared whole.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...session import materialize
from . import blocks as B
from .components import connected_components

CROWD = 256


def crowded_tiles(vec: DataFrame, n_dims: int, eps: float, min_samples: int, block: int = B.BLOCK, crowd: int = CROWD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``vec`` with ``block``, ``crowded`` and ``hub`` (a crowded cell's smallest vid, else the vector's own); pairs of
    blocks of which one at least is not crowded; pairs of blocks of different crowded cells with ``a_hub, b_hub, a_part, b_part``.
    """
    placed, names = B.grid(vec, n_dims, eps, block)
    # a hair narrower: rounding never puts two members more than eps apart
    fine = F.transform("v", lambda x: F.floor(x * F.lit(math.sqrt(n_dims) / eps * (1 + 1e-9))).cast("long"))
    placed = placed.withColumn("fine", fine)
    size = F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("long")
    cells = placed.groupBy(*names, "fine").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("rows"), F.min("vid").alias("hub"), size.alias("parts"))
    cells = materialize(cells.where((F.col("n") >= crowd) & (F.col("rows") >= min_samples)).drop("n", "rows"), "crowds")
    marked = placed.join(cells, [*names, "fine"], "left").drop("fine")
    rest = materialize(marked.where(F.col("hub").isNull()).groupBy(*names).agg(size.alias("rest_parts")), "tiles")
    own = F.concat_ws(",", *names, F.coalesce(F.col("hub").cast("string"), F.lit("-")), F.col("part"))
    parts = F.coalesce("parts", "rest_parts")
    blocked = (marked.join(rest, names, "left").withColumn("part", F.pmod(F.xxhash64("vid"), parts))
               .select(*vec.columns, own.alias("block"), F.col("hub").isNotNull().alias("crowded"), F.coalesce("hub", "vid").alias("hub")))
    all_parts = cells.select(*names, "hub", "parts").unionByName(rest.withColumnRenamed("rest_parts", "parts"), allowMissingColumns=True)
    blocks = all_parts.select(*names, "hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    pairs = materialize(B.neighbours(blocks, names, own, "hub", "part"), "block-pairs")
    both = F.col("a_hub").isNotNull() & F.col("b_hub").isNotNull()
    return materialize(blocked, "blocked"), pairs.where(~both).select("a", "b"), pairs.where(both & (F.col("a_hub") != F.col("b_hub")))


def _within(left: pd.DataFrame, right: pd.DataFrame, eps: float) -> bool:
    """Whether any two are within eps; those nearest to the other's box are tried first."""
    x, y = B.matrix(left), B.matrix(right)
    x, y = x[B.reach(x, y, eps)], y[B.reach(y, x, eps)]
    if not len(x) or not len(y):
        return False
    gap = np.maximum(np.maximum(y.min(axis=0) - x, x - y.max(axis=0)), 0.0)
    x = x[np.argsort((gap * gap).sum(axis=1), kind="stable")]
    return any((B.distances(x[i:i + 64], y) <= eps).any() for i in range(0, len(x), 64))


def _link(eps: float):
    def work(left: pd.DataFrame, right: pd.DataFrame | None) -> pd.DataFrame:
        hubs = (left["hub"], right["hub"])
        found = len(left) and len(right) and _within(left, right, eps)
        return pd.DataFrame({"src": hubs[0][:1 if found else 0].to_numpy(), "dst": hubs[1][:1 if found else 0].to_numpy()})

    return work


def crowd_links(blocked: DataFrame, pairs: DataFrame, eps: float) -> DataFrame:
    """``src, dst``: hubs of crowded cells; cells that hold two vectors within eps are connected through these links."""
    kind = blocked.schema["hub"].dataType.simpleString()
    schema = f"src {kind}, dst {kind}"
    members = blocked.where("crowded")
    first = materialize(B.over_pairs(members, pairs.where("a_part = 0 and b_part = 0").select("a", "b"), _link(eps), schema), "crowd-links")
    hubs = members.select(F.col("hub").alias("id")).distinct()
    comps = materialize(connected_components(hubs, first), "crowd-components")
    apart = (pairs.join(comps.select(F.col("id").alias("a_hub"), F.col("comp").alias("a_comp")), "a_hub")
             .join(comps.select(F.col("id").alias("b_hub"), F.col("comp").alias("b_comp")), "b_hub").where("a_comp <> b_comp").select("a", "b"))
    return first.unionByName(B.over_pairs(members, apart, _link(eps), schema))
