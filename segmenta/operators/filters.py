"""Filters, pickers, paging and projections.

Every predicate is a plain Catalyst expression, so it reaches the Parquet scan
as a pushed filter; no operator sorts the full input unless the order is the
observable result (a page, a head).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import present

ALL = "Todos"  # fixed value: the picker entry meaning "no filter"


def filter_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Inclusive range; null values never pass (as a comparison with NaN)."""
    return df.where(F.col(col).between(lo, hi))


def filter_equals(df: DataFrame, col: str | None, value, all_token: str = ALL) -> DataFrame:
    """Equality filter.  Empty column/value or the ``all_token`` passes everything;
    a column absent from the frame matches nothing."""
    if not col or value is None or value == "" or value == all_token:
        return df
    if col not in df.columns:
        return df.where(F.lit(False))
    return df.where(F.col(col) == F.lit(value))


def filter_survey(df: DataFrame, edad: tuple | None = None, genero=ALL, signo=ALL) -> DataFrame:
    """P2-P4 composed: age range, then gender and sign pickers."""
    if edad is not None:
        df = filter_range(df, "edad", *edad)
    return filter_equals(filter_equals(df, "genero", genero), "signo", signo)


def distinct_first_seen(df: DataFrame, col: str, order_col: str = "id") -> DataFrame:
    """Distinct values (null kept) in first-appearance order: (value, first_seen)."""
    return (df.groupBy(F.col(col).alias("value"))
            .agg(F.min(order_col).alias("first_seen"))
            .orderBy("first_seen"))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null, non-empty values, sorted."""
    return (df.select(F.col(col).alias("value"))
            .where(F.col("value").isNotNull() & (F.col("value").cast("string") != ""))
            .distinct().orderBy("value"))


def select_present(df: DataFrame, cols: list[str]) -> DataFrame:
    """Projection onto the requested columns that exist, in the requested order."""
    return df.select(*present(df, cols))


def numeric_matrix(df: DataFrame, features: list[str], key: str | None = "id") -> DataFrame:
    """P10: parse every feature to double and drop rows with any missing/unparsable one.

    The row key is kept, so labels computed on the matrix join back by key
    (never by position)."""
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"numeric_matrix: missing feature columns {missing}")
    cols = [F.col(c).try_cast("double").alias(c) if dict(df.dtypes)[c] == "string"
            else F.col(c).cast("double").alias(c) for c in features]
    keep = [F.col(key)] if key else []
    return df.select(*keep, *cols).dropna(subset=features)


def seeded_order(key: str | Column, seed: int = 0) -> Column:
    """A random-looking text per key, the same in every engine and partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), (F.col(key) if isinstance(key, str) else key).cast("string")).cast("binary"))


def cap_per_group(df: DataFrame, group_col: str, key: str, cap: int, seed: int = 0) -> DataFrame:
    """At most ``cap`` rows of each group: those whose key comes first in the seeded order (ties: the smallest key).

    Each task keeps only ``cap`` rows per group before the shuffle.
    """
    if cap < 1:
        raise ValueError("cap must be positive")
    first = Window.partitionBy(group_col).orderBy(seeded_order(key, seed), key)
    return df.withColumn("__rank", F.row_number().over(first)).where(F.col("__rank") <= cap).drop("__rank")


def scatter_series(df: DataFrame, features: list[str], cluster_col: str = "Cluster", cap: int | None = None, key: str | None = None,
                   seed: int = 0) -> DataFrame:
    """(cluster, x, y) with x = first feature, y = second (0 if only one), nulls -> 0; with ``cap``, that many points per cluster at most."""
    if not features:
        raise ValueError("scatter_series: at least one feature is required")
    if cap is not None:
        if key is None:
            raise ValueError("scatter_series: a cap needs the key that it draws by")
        df = cap_per_group(df, cluster_col, key, cap, seed)
    x = F.coalesce(F.col(features[0]).cast("double"), F.lit(0.0))
    y = F.coalesce(F.col(features[1]).cast("double"), F.lit(0.0)) if len(features) > 1 else F.lit(0.0)
    return df.select(F.col(cluster_col).alias("cluster"), x.alias("x"), y.alias("y"))


def null_to_dash(c: str) -> Column:
    """Rendered cell; null -> '-'."""
    return F.coalesce(F.col(c).cast("string"), F.lit("-"))


def rendered(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Every column as display text."""
    return df.select(*[null_to_dash(c).alias(c) for c in (cols or df.columns)])


def head_by(df: DataFrame, order_col: str = "id", n: int = 15, cols: list[str] | None = None) -> DataFrame:
    """First ``n`` rows by ``order_col`` (TakeOrderedAndProject, no global sort)."""
    out = df.orderBy(order_col).limit(n)
    return out.select(*present(out, cols)) if cols else out


def page_count(total: int, size: int) -> int:
    """O2: number of pages, at least one."""
    return max(1, math.ceil(total / size))


def page(df: DataFrame, page_no: int, size: int = 10, order_col: str = "id") -> DataFrame:
    """O2: 1-based page ``page_no`` of ``size`` rows ordered by ``order_col``.

    Shallow pages use a top-k (``offset``+``limit``); for deep pages prefer
    :func:`page_after` (keyset), which reads only rows past the last key.
    """
    if size <= 0 or page_no <= 0:
        raise ValueError("page: page_no and size must be positive")
    return df.orderBy(order_col).offset((page_no - 1) * size).limit(size)


def page_after(df: DataFrame, last_key, size: int = 10, order_col: str = "id") -> DataFrame:
    """O2 keyset variant: the ``size`` rows following ``last_key`` (the filter is pushed to the scan)."""
    src = df if last_key is None else df.where(F.col(order_col) > F.lit(last_key))
    return src.orderBy(order_col).limit(size)


def page_info(df: DataFrame, page_no: int, size: int) -> DataFrame:
    """O2 footer: total, pages, first and last row number of the page (one-row aggregate)."""
    n = F.count(F.lit(1))
    pages = F.greatest(F.lit(1), F.ceil(n / F.lit(size))).cast("bigint")
    first = F.least(n, F.lit((page_no - 1) * size + 1))
    last = F.least(n, F.lit(page_no * size))
    return df.agg(n.alias("total"), pages.alias("pages"),
                  F.when(n == 0, F.lit(0)).otherwise(first).cast("bigint").alias("row_from"),
                  last.cast("bigint").alias("row_to"))
