"""Pairwise work between distinct vectors in blocks, without a row per pair.

Identical vectors are collapsed to one weighted row.  The rows are cut into blocks of about ``BLOCK`` vectors; every
unordered pair of blocks that may interact becomes one group (at most about 2 * ``BLOCK`` rows), and NumPy works on it
inside a task.  A group gives at most a few rows per vector, never a row per pair of vectors.  Compute is quadratic
inside a neighbourhood; memory per task is bounded by the block size, and a crowded place is split over many groups.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ...session import materialize

BLOCK = 2048


def complete_rows(df: DataFrame, features: list[str], *keep: str) -> DataFrame:
    """``keep`` columns and the vector ``v`` of the rows without a null or NaN feature."""
    num = df.select(*keep, *[F.col(f).cast("double").alias(f"__f{k}") for k, f in enumerate(features)])
    names = [f"__f{k}" for k in range(len(features))]
    return num.dropna(subset=names).select(*keep, F.array(*names).alias("v"))


def distinct_vectors(rows: DataFrame, key: str) -> DataFrame:
    """(vid = smallest key, w = rows, v) per distinct vector; written once, because every pass reads it."""
    return materialize(rows.groupBy("v").agg(F.min(key).alias("vid"), F.count(F.lit(1)).alias("w")), "vectors")


def grid(vec: DataFrame, n_dims: int, eps: float, block: int = BLOCK) -> tuple[DataFrame, list[str]]:
    """``vec`` with its tile's place in the columns that are named.

    Tiles lie on a grid over the (up to 3) widest dimensions.  Their side is at least eps, so that a partner lies in the
    same or a neighbouring tile (a distance in some dimensions never exceeds the whole one), and wide enough for about
    ``block`` vectors in evenly spread data.
    """
    row = vec.agg(F.count(F.lit(1)).alias("n"), *[F.min(F.col("v")[k]).alias(f"lo{k}") for k in range(n_dims)],
                  *[F.max(F.col("v")[k]).alias(f"hi{k}") for k in range(n_dims)]).first()
    span = [(row[f"hi{k}"] or 0.0) - (row[f"lo{k}"] or 0.0) for k in range(n_dims)]
    dims = sorted(range(n_dims), key=lambda k: -span[k])[:3]
    per_dim = max(1, int((row["n"] / block) ** (1 / len(dims))))
    # a hair wider than eps: rounding never puts a true pair two tiles apart
    side = [max(eps, span[k] / per_dim) * (1 + 1e-9) or 1.0 for k in dims]
    cells = [F.floor((F.col("v")[k] - F.lit(row[f"lo{k}"] or 0.0)) / F.lit(s)).alias(f"c{p}")
             for p, (k, s) in enumerate(zip(dims, side, strict=True))]
    return vec.select("*", *cells), [f"c{p}" for p in range(len(dims))]


def neighbours(blocks: DataFrame, names: list[str], name: Column, *more: str) -> DataFrame:
    """Pairs (a, b), a <= b, of blocks in the same or neighbouring tiles; ``more`` columns of both as a_..., b_...."""
    steps = F.array(*[F.array(*[F.lit(o) for o in step]) for step in itertools.product((-1, 0, 1), repeat=len(names))])
    left = blocks.select(name.alias("a"), *names, F.explode(steps).alias("step"), *[F.col(c).alias(f"a_{c}") for c in more])
    left = left.select("a", *[(F.col(c) + F.col("step")[p]).alias(c) for p, c in enumerate(names)], *[f"a_{c}" for c in more])
    right = blocks.select(name.alias("b"), *names, *[F.col(c).alias(f"b_{c}") for c in more])
    return left.join(right, names).where(F.col("a") <= F.col("b")).drop(*names)


def tiles(vec: DataFrame, n_dims: int, eps: float, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``vec`` with its ``block``, and the pairs (a, b), a <= b, of blocks that can hold vectors within ``eps``; a tile of more than ``block`` vectors is split by hash."""
    placed, names = grid(vec, n_dims, eps, block)
    held = placed.groupBy(*names).agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("long").alias("parts"))
    held = materialize(held, "tiles")
    own = F.concat_ws(",", *names, F.col("part"))
    placed = (placed.join(held, names).withColumn("part", F.pmod(F.xxhash64("vid"), F.col("parts")))
              .select(*vec.columns, own.alias("block")))
    blocks = held.select(*names, F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    return materialize(placed, "blocked"), materialize(neighbours(blocks, names, own), "block-pairs")


SAMPLE = 20_000  # vectors from which the boxes' borders are read


def splits(x: np.ndarray, leaves: int, share: float = 0.5) -> list:
    """A tree of halvings along the widest dimension, ``share`` of the rows to the left: [dimension, border, left, right], or [] for a leaf."""
    if leaves <= 1 or len(x) < 2:
        return []
    k = int(np.argmax(x.max(axis=0) - x.min(axis=0)))
    under = leaves // 2 if share == 0.5 else min(max(1, round(leaves * share)), leaves - 1)
    border = float(np.quantile(x[:, k], share))
    low = x[:, k] < border
    if low.all() or not low.any():
        return []
    border = float((x[low, k].max() + x[~low, k].min()) / 2)  # between two places, on none
    return [k, border, splits(x[low], under, share), splits(x[~low], leaves - under, share)]


def _leaf(x: np.ndarray, tree: list, at: np.ndarray, number: list, out: np.ndarray) -> None:
    if not tree:
        out[at] = number[0]
        number[0] += 1
        return
    low = x[at, tree[0]] < tree[1]
    _leaf(x, tree[2], at[low], number, out)
    _leaf(x, tree[3], at[~low], number, out)


def leaves(x: np.ndarray, tree: list) -> np.ndarray:
    """The number of each row's leaf."""
    out = np.zeros(len(x), np.int64)
    _leaf(x, tree, np.arange(len(x)), [0], out)
    return out


def boxes(vec: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame, int]:
    """``vec`` with its ``block`` (numbered from 0, about ``block`` neighbouring vectors each), the blocks' corners (block, lo, hi), and their number.

    The borders come from a fixed sample of at most ``SAMPLE`` vectors; a box that turns out to hold many more is dealt over several blocks.
    """
    n_leaves = max(1, math.ceil(vec.count() / block))
    sample = vec.select("v").orderBy(F.xxhash64("vid")).limit(SAMPLE).toPandas()
    tree = splits(matrix(sample), n_leaves)

    def place(frames):
        for f in frames:
            yield f.assign(leaf=leaves(matrix(f), tree))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vec.schema.fields)
    placed = materialize(vec.mapInPandas(place, f"{fields}, leaf long"), "boxed")
    parts = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(2 * block)).cast("long").alias("parts"))
    before = F.sum("parts").over(Window.orderBy("leaf")) - F.col("parts")  # one row per leaf
    parts = parts.select("leaf", "parts", before.alias("first"))
    blocked = (placed.join(parts, "leaf").withColumn("block", F.col("first") + F.pmod(F.xxhash64("vid"), F.col("parts"))).drop("leaf", "parts", "first"))
    blocked = materialize(blocked, "blocked")
    n_dims = len(sample["v"].iat[0]) if len(sample) else 0
    corners = [F.array(*[f(F.col("v")[k]) for k in range(n_dims)]).alias(c) for f, c in ((F.min, "lo"), (F.max, "hi"))]
    found, seen = materialize(blocked.groupBy("block").agg(*corners), "boxes", [F.max("block").alias("last")])
    return blocked, found, (seen["last"] if seen["last"] is not None else -1) + 1


def all_pairs(vec: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``vec`` with its ``block`` by hash, and every pair of blocks: for work in which each vector meets each other."""
    parts = max(1, math.ceil(vec.count() / block))
    ids = vec.sparkSession.range(parts).select(F.col("id").alias("a"))
    pairs = ids.select("a", F.explode(F.sequence(F.col("a"), F.lit(parts - 1).cast("long"))).alias("b"))
    return vec.withColumn("block", F.pmod(F.xxhash64("vid"), F.lit(parts).cast("long"))), pairs


def over_pairs(blocked: DataFrame, pairs: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work(left, right)`` for every pair of blocks, as frames; ``right`` is None where a block meets itself."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        left = group[group["side"] == 0]
        right = None if group["a"].iat[0] == group["b"].iat[0] else group[group["side"] == 1]
        return work(left.reset_index(drop=True), None if right is None else right.reset_index(drop=True))

    first = blocked.join(pairs, blocked["block"] == pairs["a"]).withColumn("side", F.lit(0))
    second = pairs.where(F.col("a") < F.col("b"))
    second = blocked.join(second, blocked["block"] == second["b"]).withColumn("side", F.lit(1))
    return first.unionByName(second).groupBy("a", "b").applyInPandas(run, schema)


def over_grid(asks: DataFrame, rows: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work(asks of a block, rows of a block)`` for every pair of their blocks (numbered from 0)."""
    last = [f.agg(F.max("block").alias("m")).first()["m"] for f in (asks, rows)]
    if None in last:
        return asks.sparkSession.createDataFrame([], schema)

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        left, right = cell[cell["side"] == 0], cell[cell["side"] == 1]
        if not len(left) or not len(right):
            return pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})
        return work(left.reset_index(drop=True), right.reset_index(drop=True))

    numbers = [F.sequence(F.lit(0).cast("long"), F.lit(m).cast("long")) for m in last]
    left = asks.withColumn("side", F.lit(0)).withColumnRenamed("block", "a").withColumn("b", F.explode(numbers[1]))
    right = rows.withColumn("side", F.lit(1)).withColumnRenamed("block", "b").withColumn("a", F.explode(numbers[0]))
    return left.unionByName(right).groupBy("a", "b").applyInPandas(run, schema)


def matrix(frame: pd.DataFrame) -> np.ndarray:
    return np.array(frame["v"].tolist(), dtype=np.float64).reshape(len(frame), -1)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances, added up dimension by dimension."""
    total = np.zeros((len(x), len(y)))
    for k in range(x.shape[1] if len(x) else 0):
        step = x[:, k, None] - y[None, :, k]
        total += step * step
    return np.sqrt(total)


def reach(x: np.ndarray, y: np.ndarray, eps: float) -> np.ndarray:
    """Which of ``x`` may lie within eps of the box around ``y``."""
    gap = np.maximum(np.maximum(y.min(axis=0) - x, x - y.max(axis=0)), 0.0)
    return np.sqrt((gap * gap).sum(axis=1)) <= eps * (1 + 1e-9)


def close(left: pd.DataFrame, right: pd.DataFrame | None, eps: float):
    """Rows of both frames that may have partners, and who lies within eps of whom."""
    if right is None:
        x = matrix(left)
        return left, left, distances(x, x) <= eps
    if len(left) and len(right):
        x, y = matrix(left), matrix(right)
        left, right = left[reach(x, y, eps)], right[reach(y, x, eps)]
    if not len(left) or not len(right):
        return left.iloc[:0], right.iloc[:0], np.zeros((0, 0), dtype=bool)
    return left, right, distances(matrix(left), matrix(right)) <= eps


def star_edges(eps: float) -> Callable:
    """Work that links each connected group of a pair of blocks to one of its vectors: fewer edges than vectors."""
    def work(left: pd.DataFrame, right: pd.DataFrame | None) -> pd.DataFrame:
        same = right is None
        left, right, near = close(left, right, eps)
        ids, others = left["vid"].to_numpy(), right["vid"].to_numpy()
        open_a, open_b = np.ones(len(ids), dtype=bool), np.ones(len(others), dtype=bool)
        src, dst = [], []
        for seed in range(len(ids)):
            if not open_a[seed]:
                continue
            open_a[seed] = False
            edge = np.array([seed])
            while len(edge):
                found = near[edge].any(axis=0) & open_b
                open_b &= ~found
                back = near[:, found].any(axis=1) & open_a
                open_a &= ~back
                edge = np.flatnonzero(back)
                for new in ([ids[edge]] if same else [others[found], ids[edge]]):
                    src.append(np.full(len(new), ids[seed], dtype=ids.dtype))
                    dst.append(new)
        empty = ids[:0]
        return pd.DataFrame({"src": np.concatenate([empty, *src]), "dst": np.concatenate([empty, *dst])})

    return work
