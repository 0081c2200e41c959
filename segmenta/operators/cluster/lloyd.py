"""K-Means from many starts at once (M3c): every scan of the data seeds or moves the centres of all runs.

Rows with one vector are one weighted row.  A task gives, per run and centre, the weight, the sum and the cost of the rows nearest
to it; runs x centres rows come to the driver, which holds the centres.  Starts are drawn as k-means++ does: each next centre
with a probability in proportion to the squared distance from those drawn, as a race of exponential times that a hash of the
run, the step and the vector gives, so that a start does not depend on the partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...session import materialize
from . import blocks as B

CHUNK = 8192  # rows whose distances are held at once


def weighted_vectors(df: DataFrame, features: list[str]) -> DataFrame:
    """``v, w, h``: distinct complete vectors, their rows and a hash, written once."""
    rows = B.complete_rows(df, features)
    return materialize(rows.groupBy("v").agg(F.count(F.lit(1)).cast("double").alias("w")).withColumn("h", F.xxhash64("v")), "kmeans-vectors")


def _scan(vec: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work(x, w, h)`` over parts of the vectors, which adds to what it keeps; ``work.rows()`` gives a task's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = work()
        for b in batches:
            x = np.array(b.column("v").flatten()).reshape(b.num_rows, -1)
            w, h = b.column("w").to_numpy(), b.column("h").to_numpy().view(np.uint64)
            for at in range(0, len(x), CHUNK):
                state.add(x[at:at + CHUNK], w[at:at + CHUNK], h[at:at + CHUNK])
        yield from state.rows()

    return vec.mapInArrow(run, schema)


def squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances, added up dimension by dimension."""
    total = np.zeros((len(x), len(centers)))
    for k in range(x.shape[1]):
        step = x[:, k, None] - centers[None, :, k]
        total += step * step
    return total


class _Race:
    """Per run the vector whose exponential time, at a rate of weight times squared distance, comes first."""

    def __init__(self, runs: dict[int, np.ndarray], seed: int, step: int):
        self.runs, self.seed, self.step = runs, seed, step
        self.best: dict[int, tuple[float, list[float]]] = {}

    def add(self, x, w, h) -> None:
        for r, centers in self.runs.items():
            rate = w * (squares(x, centers).min(axis=1) if len(centers) else 1.0)
            time = _exponential(h, self.seed + r, self.step)
            time = np.divide(time, rate, out=np.full(len(x), np.inf), where=rate > 0)
            k = int(np.lexsort((*x.T[::-1], time))[0])
            if np.isfinite(time[k]) and (r not in self.best or (time[k], x[k].tolist()) < self.best[r]):
                self.best[r] = (float(time[k]), x[k].tolist())

    def rows(self):
        if self.best:
            runs = list(self.best)
            yield pa.RecordBatch.from_arrays([pa.array(runs, pa.int32()), pa.array([self.best[r][0] for r in runs]),
                                              pa.array([self.best[r][1] for r in runs], pa.list_(pa.float64()))], names=["run", "time", "v"])


def _exponential(h: np.ndarray, seed: int, step: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = h + np.uint64(seed * 2 + 1) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(step) * np.uint64(0xD1B54A32D192ED03)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
        z ^= z >> np.uint64(31)
    return -np.log((z >> np.uint64(11)).astype(float) * 2.0 ** -53 + 2.0 ** -54)


class _Sums:
    """Per run and centre: weight, sum and cost of the vectors nearest to it (of equals, to the first)."""

    def __init__(self, runs: dict[int, np.ndarray]):
        self.runs = runs
        self.held = {r: np.zeros((len(c), c.shape[1] + 2)) for r, c in runs.items()}

    def add(self, x, w, h) -> None:
        for r, centers in self.runs.items():
            d = squares(x, centers)
            near = d.argmin(axis=1)
            cost = d[np.arange(len(x)), near] * w
            n = len(centers)
            cols = [np.bincount(near, weights=z, minlength=n) for z in (w, cost, *(x * w[:, None]).T)]
            self.held[r] += np.stack(cols, axis=1)

    def rows(self):
        runs = [r for r, c in self.runs.items() for _ in c]
        if runs:
            whole = np.concatenate([self.held[r] for r in self.runs])
            numbers = [k for c in self.runs.values() for k in range(len(c))]
            yield pa.RecordBatch.from_arrays([pa.array(runs, pa.int32()), pa.array(numbers, pa.int32()), *map(pa.array, whole.T)],
                                             names=["run", "cluster", "n", "cost", *[f"s{k}" for k in range(whole.shape[1] - 2)]])


def seeded_starts(vec: DataFrame, k: int, seeds: int, seed: int = 42, passes: list | None = None) -> list[np.ndarray]:
    """``seeds`` starts of ``k`` distinct centres, drawn in ``k`` scans."""
    runs = {r: np.zeros((0, 0)) for r in range(seeds)}
    for step in range(k):
        found = _scan(vec, lambda runs=dict(runs), step=step: _Race(runs, seed, step), "run int, time double, v array<double>")
        first = found.groupBy("run").agg(F.min(F.struct("time", "v")).alias("e")).select("run", "e.v").collect()
        if passes is not None:
            passes.append("seed")
        if len(first) < seeds:
            raise ValueError("not enough distinct records for the requested number of clusters")
        for r in first:
            runs[r["run"]] = np.array([*runs[r["run"]].tolist(), list(r["v"])])
    return [runs[r] for r in range(seeds)]


def _summed(vec: DataFrame, runs: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    d = next(iter(runs.values())).shape[1]
    cols = ["n", "cost", *[f"s{k}" for k in range(d)]]
    found = _scan(vec, lambda: _Sums(runs), "run int, cluster int, " + ", ".join(f"{c} double" for c in cols))
    out = {r: np.zeros((len(c), d + 2)) for r, c in runs.items()}
    for row in found.groupBy("run", "cluster").agg(*[F.sum(c).alias(c) for c in cols]).collect():
        out[row["run"]][row["cluster"]] = [row[c] for c in cols]
    return out


def lloyd(vec: DataFrame, starts: list, max_iter: int = 300, tol: float = 1e-4, passes: list | None = None) -> list[tuple[np.ndarray, float, np.ndarray]]:
    """(centres, cost, rows per centre) of each start after Lloyd's rounds; a run whose centres move by at most ``tol`` rests.

    A centre without rows stays where it is.  Scans: one per round of the longest run and one for the costs, however many starts.
    """
    centers = {r: np.array(c, float) for r, c in enumerate(starts)}
    moving = dict(centers)
    for _ in range(max_iter):
        if not moving:
            break
        sums = _summed(vec, moving)
        if passes is not None:
            passes.append("move")
        for r, c in list(moving.items()):
            n = sums[r][:, 0]
            new = np.where(n[:, None] > 0, sums[r][:, 2:] / np.maximum(n, 1e-300)[:, None], c)
            centers[r] = new
            if np.sqrt(((new - c) ** 2).sum(axis=1)).max() <= tol:
                del moving[r]
            else:
                moving[r] = new
    sums = _summed(vec, centers)
    if passes is not None:
        passes.append("cost")
    return [(centers[r], float(sums[r][:, 1].sum()), sums[r][:, 0]) for r in sorted(centers)]
