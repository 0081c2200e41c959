"""Sums of products of all column pairs, in one pass: a task adds up one block of numbers per pair and gives a row per pair.

Values are taken relative to a pivot, some value of their column, so that large means do not cancel the differences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import nan_as_null

SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
PIVOT_ROWS = 1000


def pair_moments(df: DataFrame, cols: list[str], complete: bool = False) -> DataFrame:
    """``i, j, n, sx, sy, sxx, syy, sxy, x_varies, y_varies`` for i <= j: sums over the rows where both columns (``complete``: all) have a value."""
    d = len(cols)
    num = nan_as_null(df, cols).select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
    first = num.limit(PIVOT_ROWS).agg(*[F.first(f"c{k}", ignorenulls=True).alias(f"c{k}") for k in range(d)]).first()
    pivot = np.array([first[k] or 0.0 for k in range(d)])
    i, j = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, ss, prod = (np.zeros((d, d)) for _ in range(4))
        low, high = np.full((d, d), np.inf), np.full((d, d), -np.inf)
        for b in batches:
            x = np.stack([b.column(k).to_numpy(zero_copy_only=False).astype(float) for k in range(d)], axis=1) - pivot
            there = ~np.isnan(x)
            if complete:
                there &= there.all(axis=1, keepdims=True)
            x, m = np.where(there, x, 0.0), there.astype(float)
            n, s, ss, prod = n + m.T @ m, s + x.T @ m, ss + (x * x).T @ m, prod + x.T @ x  # [a, b]: of a, where b is there
            for k in range(d):
                mine = there[:, k]
                if mine.any():
                    both = there[mine]
                    low[:, k] = np.minimum(low[:, k], np.where(both, x[mine], np.inf).min(axis=0))
                    high[:, k] = np.maximum(high[:, k], np.where(both, x[mine], -np.inf).max(axis=0))
        values = (n[i, j], s[i, j], s.T[i, j], ss[i, j], ss.T[i, j], prod[i, j], low[i, j], high[i, j], low.T[i, j], high.T[i, j])
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *map(pa.array, values)],
                                         names=["i", "j", *SUMS, "x_low", "x_high", "y_low", "y_high"])

    ranges = ("x_low", "x_high", "y_low", "y_high")
    parts = num.mapInArrow(run, "i int, j int, " + ", ".join(f"{c} double" for c in SUMS + ranges))
    total = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in SUMS], *[(F.min if c.endswith("low") else F.max)(c).alias(c) for c in ranges])
    return total.select("i", "j", *SUMS, (F.col("x_low") < F.col("x_high")).alias("x_varies"), (F.col("y_low") < F.col("y_high")).alias("y_varies"))


def both_ways(cells: DataFrame, cols: list[str], value: str) -> DataFrame:
    """``col_a, col_b, value`` of every ordered pair, from rows for i <= j."""
    names = F.array(*[F.lit(c) for c in cols])
    a, b = (F.element_at(names, F.col(c) + 1) for c in "ij")
    one, other = (F.struct(x.alias("col_a"), y.alias("col_b")) for x, y in ((a, b), (b, a)))
    return (cells.select(F.explode(F.when(F.col("i") == F.col("j"), F.array(one)).otherwise(F.array(one, other))).alias("k"), value)
            .select("k.col_a", "k.col_b", value))
