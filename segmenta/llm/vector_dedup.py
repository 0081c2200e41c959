"""Operator 7: near-duplicate vectors by an inverted multi-index.

Two codebooks, one per half of the (unit) vectors, span a grid of cells.  Every vector lies in one cell and visits the
nearest cells in the order of the multi-sequence algorithm (ascending sum of the halves' distances).  How many it visits
is set by a target recall: on a bounded sample, partners are drawn at exactly the threshold angle, and the smallest number
of visits that reaches the target share of them is taken.  Every meeting in a cell is verified by the exact cosine.

Equal vectors are one class throughout (their group may hold any share of the rows).  A large cell is dealt as a grid
of bounded blocks of members and visitors; what leaves a block is a link count per vector and a spanning forest, never
pairs.  A pair that meets twice (each visits the other's cell) is counted once: the member's visits travel with it.

Sample: at most ``SAMPLE`` vectors of a length, the first by a hash of their id.  All vectors are indexed: vectors link with
those of their own length, and every length has an index of its own, with cell numbers of its own.  Vectors that are null, of
length 0, zero, or hold null or non-finite components link with nothing and are their own component.  Repeated ids: rows are kept apart by their vectors, and count as
separate vectors; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cluster.components import connected_components
from ..session import materialize

SAMPLE = 16_384
OCCUPANCY = 128  # vectors a cell holds on average
BLOCK = 1024  # members or visitors met at once


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, rows by centres."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0.0)


def codebook(x: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    """k-means centres of a sample."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        at = nearest(x, centres).argmin(1)
        n = np.bincount(at, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


class MultiIndex:
    """Two codebooks and the number of cells a vector visits."""

    def __init__(self, left: np.ndarray, right: np.ndarray, visits: int = 1):
        self.left, self.right, self.visits = left, right, visits

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.left.shape[1]
        return nearest(x[:, :cut], self.left), nearest(x[:, cut:], self.right)

    def traverse(self, x: np.ndarray) -> np.ndarray:
        """The ``visits`` nearest cells of each row, nearest first.

        Cell (a, b) in the halves' ranks comes after (a+1)(b+1)-1 others, so only pairs with (a+1)(b+1) <= visits can be
        among the first ``visits``; sorting their sums gives what the multi-sequence queue would yield.
        """
        d1, d2 = self.halves(x)
        t = self.visits
        o1, o2 = np.argsort(d1, 1, kind="stable")[:, :t], np.argsort(d2, 1, kind="stable")[:, :t]
        a, b = np.array([(a, b) for a in range(o1.shape[1]) for b in range(o2.shape[1]) if (a + 1) * (b + 1) <= t]).T
        total = np.take_along_axis(d1, o1, 1)[:, a] + np.take_along_axis(d2, o2, 1)[:, b]
        first = np.argsort(total, 1, kind="stable")[:, :t]
        return (np.take_along_axis(o1[:, a], first, 1) * len(self.right) + np.take_along_axis(o2[:, b], first, 1)).astype(np.int64)

    def rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many cells x visits before it comes to y's cell."""
        d1, d2 = self.halves(x)
        e1, e2 = self.halves(y)
        rows = np.arange(len(x))
        limit = d1[rows, e1.argmin(1)] + d2[rows, e2.argmin(1)]
        d2 = np.sort(d2, 1)
        return np.array([np.searchsorted(d2[i], limit[i] - d1[i], side="left").sum() for i in rows])


def fit(sample: np.ndarray, n: int, threshold: float, recall: float, seed: int = 0) -> MultiIndex:
    """Codebooks for ``n`` vectors, and the visits that find ``recall`` of partners at exactly the threshold cosine."""
    k = int(np.clip(np.ceil(np.sqrt(n / OCCUPANCY)), 1, max(1, len(sample) // 4)))
    cut = max(1, sample.shape[1] // 2)
    index = MultiIndex(codebook(sample[:, :cut], k, seed), codebook(sample[:, cut:], k, seed + 1))
    rng = np.random.default_rng(seed + 2)
    x = sample[:512]
    side = rng.standard_normal(x.shape)
    side -= (side * x).sum(1, keepdims=True) * x
    side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-12)
    y = threshold * x + np.sqrt(1 - threshold ** 2) * side
    met = np.sort(np.minimum(index.rank(x, y), index.rank(y, x)))  # either side's visit suffices
    index.visits = int(min(k * k, met[min(len(met) - 1, int(np.ceil(recall * len(met))) - 1)] + 1))
    return index


def forest(linked: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> list[tuple[int, int]]:
    """Edges joining every vector of a block to the smallest id of its component in the bipartite link matrix."""
    low_r, low_c = rows.copy(), cols.copy()
    big = np.iinfo(np.int64).max
    while True:
        c = np.minimum(low_c, np.where(linked, low_r[:, None], big).min(0))
        r = np.minimum(low_r, np.where(linked, c[None, :], big).min(1))
        if (c == low_c).all() and (r == low_r).all():
            return [(int(a), int(b)) for a, b in zip(np.concatenate([rows, cols]), np.concatenate([r, c]), strict=True) if a != b]
        low_r, low_c = r, c


def links(classes: DataFrame, indexes: dict[int, tuple[int, MultiIndex | None]], threshold: float) -> DataFrame:
    """``a, b, n``: partial link counts (b null) and forest edges (n null) of ``classes(id, v, size)``.

    ``indexes``: per length of vectors the number of its first cell, and its index (None: they all lie in that cell).
    """
    def place(batches):
        for b in batches:
            if not b.num_rows:
                continue
            v = b.column("v").to_numpy(zero_copy_only=False)
            dims = np.array([len(one) for one in v])
            cells = [None] * len(v)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                first, index = indexes[dim]
                x = np.stack(v[at]).astype(np.float64)
                found = index.traverse(x / np.linalg.norm(x, axis=1, keepdims=True)) if index else np.zeros((len(at), 1), np.int64)
                for i, visited in zip(at.tolist(), found + first, strict=True):
                    cells[i] = visited
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells, pa.list_(pa.int64()))], names=[*b.schema.names, "cells"])

    placed = materialize(classes.mapInArrow(place, T.StructType([*classes.schema.fields, T.StructField("cells", T.ArrayType(T.LongType()))])), "cells")
    members = placed.withColumn("cell", F.col("cells")[0])
    visitors = placed.withColumn("home", F.col("cells")[0]).withColumn("cell", F.explode("cells")).drop("cells")
    n_members = members.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("m_blocks"))
    n_visitors = visitors.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("v_blocks"))
    grid = n_members.join(n_visitors, "cell")
    m = (members.join(grid, "cell").withColumn("mb", F.pmod(F.xxhash64("id"), "m_blocks"))
         .withColumn("vb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("v_blocks") - 1))).select("cell", "mb", "vb", "id", "v", "size", "cells"))
    v = (visitors.join(grid, "cell").withColumn("vb", F.pmod(F.xxhash64("id"), "v_blocks"))
         .withColumn("mb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m_blocks") - 1)))
         .select("cell", "mb", "vb", F.col("id").alias("v_id"), F.col("v").alias("v_v"), F.col("size").alias("v_size"), "home"))

    def meet(members, visitors):
        if not len(members) or not len(visitors):
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype("Int64")
        x, y = (np.stack(t.to_numpy()).astype(np.float64) for t in (visitors["v_v"], members["v"]))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y /= np.linalg.norm(y, axis=1, keepdims=True)
        ids_x, ids_y = visitors["v_id"].to_numpy(np.int64), members["id"].to_numpy(np.int64)
        linked = (x @ y.T >= threshold) & (ids_x[:, None] != ids_y[None, :])
        # the member counts the visitor here only if it does not visit the visitor's home itself
        home = visitors["home"].to_numpy(np.int64)
        cells = np.stack(members["cells"].to_numpy())
        visits_home = np.zeros(linked.shape, bool)
        hit_x, hit_y = np.nonzero(linked)
        visits_home[hit_x, hit_y] = (cells[hit_y] == home[hit_x][:, None]).any(1)
        n_x = linked @ members["size"].to_numpy(np.int64)
        n_y = (linked & ~visits_home).T @ visitors["v_size"].to_numpy(np.int64)
        counts = pd.DataFrame({"a": np.concatenate([ids_x[n_x > 0], ids_y[n_y > 0]]), "n": np.concatenate([n_x[n_x > 0], n_y[n_y > 0]])})
        edges = pd.DataFrame(forest(linked, ids_x, ids_y), columns=["a", "b"])
        return pd.concat([counts, edges])[["a", "b", "n"]].astype("Int64")

    keys = ["cell", "mb", "vb"]
    return m.groupBy(*keys).cogroup(v.groupBy(*keys)).applyInPandas(meet, "a long, b long, n long")


def build_indexes(classes: DataFrame, threshold: float, recall: float) -> dict[int, tuple[int, MultiIndex | None]]:
    """For ``links``: an index per length of vectors; so few that a cell holds them need none."""
    counts = classes.groupBy(F.size("v").alias("dim")).count().orderBy("dim").collect()
    out, first = {}, 0
    for dim, n in counts:
        index = None
        if n > OCCUPANCY:
            of_dim = classes.where(F.size("v") == dim)
            sample = np.array([r["v"] for r in of_dim.orderBy(F.xxhash64("id"), "id").select("v").limit(SAMPLE).collect()], np.float64)
            sample /= np.linalg.norm(sample, axis=1, keepdims=True)
            index = fit(sample, n, threshold, recall)
        out[dim] = first, index
        first += len(index.left) * len(index.right) if index else 1
    return out


def near_duplicates(df: DataFrame, threshold: float = 0.95, recall: float = 0.99, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    v = F.col(vector_col)
    fine = (v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.when(fine, v).alias("v"))
    rows = (rows.withColumn("h1", F.when(F.col("v").isNotNull(), F.xxhash64("v")))
            .withColumn("h2", F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(1), "v"))))
    usable = rows.where("v is not null")
    classes = materialize(usable.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("size"), F.first("v").alias("v")), "classes")
    indexes = build_indexes(classes, threshold, recall)
    if not indexes:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = materialize(links(classes.select("id", "size", "v"), indexes, threshold), "links")
    counts = found.where("n is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    component = connected_components(classes.select("id"), found.where("b is not null").select(F.col("a").alias("src"), F.col("b").alias("dst")))
    about = (classes.select("h1", "h2", F.col("id").alias("rep"), "size").join(counts, "rep", "left")
             .join(component.withColumnRenamed("id", "rep"), "rep"))
    return (rows.drop("v").join(about, ["h1", "h2"], "left")
            .select(F.col("id").alias(id_col),
                    F.coalesce(F.col("size") - 1 + F.coalesce("others", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("comp", "id").alias("component_id"))
            .withColumn("kept", F.col(id_col) == F.col("component_id")))
