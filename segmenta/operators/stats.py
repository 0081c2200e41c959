"""Descriptive statistics.

Design: moments of many columns come from ONE wide aggregate (partial/final,
no explode of raw rows); per-value counts (modes, frequencies) come from one
``unpivot`` followed by a (column, value) aggregate whose map-side combine keeps
the shuffle at (#columns x #distinct values) rows, whatever the row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import nan_as_null, order_by_position, present, stack_rows


# ---------------------------------------------------------------- expressions
def mean_or_zero(c: str | Column) -> Column:
    """A1: mean over non-nulls; 0.0 when there are none."""
    return F.coalesce(F.avg(c).cast("double"), F.lit(0.0))


def var_samp_or_zero(c: str | Column) -> Column:
    """A3: sample variance; 0.0 when fewer than two values."""
    return F.coalesce(F.var_samp(c), F.lit(0.0))


def std_samp_or_zero(c: str | Column) -> Column:
    """A4: sample standard deviation; 0.0 when fewer than two values."""
    return F.coalesce(F.stddev_samp(c), F.lit(0.0))


def var_pop_or_zero(c: str | Column) -> Column:
    """Population variance; 0.0 when fewer than two values."""
    return F.when(F.count(c) < 2, F.lit(0.0)).otherwise(F.var_pop(c))


def std_pop_or_zero(c: str | Column) -> Column:
    """Population standard deviation."""
    return F.when(F.count(c) < 2, F.lit(0.0)).otherwise(F.stddev_pop(c))


def parse_number(c: str | Column) -> Column:
    """Safe per-value numeric parse; blank/unparsable -> null ('nan' -> NaN).

    The cast accepts a type letter after the digits ('1d', '2f'); those are no numbers here.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.when(~col.cast("string").rlike(r"(?i)[0-9.][df]\s*$"), col.try_cast("double"))


def to_double(df: DataFrame, c: str) -> Column:
    """Numeric view of a column: strings are parsed with ``try_cast``, numbers cast."""
    if dict(df.dtypes)[c] == "string":
        return parse_number(c)
    return F.col(c).cast("double")


# ---------------------------------------------------------------- A2 / A5
def first_seen_mode(df: DataFrame, cols: list[str], order_col: str = "id") -> DataFrame:
    """A2: per column, the most frequent non-null value; ties -> value seen first by ``order_col``.

    Returns (question, mode).  One unpivot + two small aggregates.
    """
    cols = present(df, cols)
    df = nan_as_null(df, cols)
    counts = (
        df.select(order_col, *cols)
        .unpivot([order_col], cols, "question", "value")
        .where(F.col("value").isNotNull())
        .groupBy("question", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.min(order_col).alias("first_seen"))
    )
    return counts.groupBy("question").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("first_seen"))).alias("mode")
    )


def question_stats(df: DataFrame, cols: list[str], order_col: str = "id", digits: int | None = 3) -> DataFrame:
    """A5: per question n, mean, first-seen mode, sample variance and sd (rounded to ``digits``).

    One scan and one shuffle for any number of columns: the answers are
    unpivoted and counted per (question, value) with the first ``order_col`` seen
    (map-side combined) and that small table is written once.  Moments come from that small table in two passes (mean,
    then centred squares — numerically stable); the mode is the most frequent
    value, ties to the one seen first.  Questions without any answer still appear
    (n 0, mean 0.0, mode null, variance 0.0).
    """
    cols = present(df, cols)
    df = nan_as_null(df, cols)
    if not cols:
        raise ValueError("question_stats: none of the columns is present")
    from ..session import materialize

    counts = materialize(df.select(order_col, *cols)
                         .unpivot([order_col], cols, "question", "value")
                         .where(F.col("value").isNotNull())
                         .groupBy("question", "value")
                         .agg(F.count(F.lit(1)).alias("n"), F.min(order_col).alias("first_seen")),
                         "question-counts")  # read by three branches: one scan of the input
    m1 = counts.groupBy("question").agg(
        F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean"),
        F.min_by("value", F.struct(-F.col("n"), F.col("first_seen"))).alias("mode"))
    m2 = (counts.join(F.broadcast(m1.select("question", F.col("mean").alias("mu"))), "question")
          .groupBy("question").agg(F.sum(F.col("n") * (F.col("value") - F.col("mu")) ** 2).alias("ss")))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "question string")  # the column list
    var = F.when(F.col("n") < 2, F.lit(0.0)).otherwise(F.col("ss") / (F.col("n") - 1))
    out = (names.join(m1, "question", "left").join(m2, "question", "left")
           .select("question", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
                   F.coalesce(F.col("mean").cast("double"), F.lit(0.0)).alias("mean"), "mode",
                   F.coalesce(var.cast("double"), F.lit(0.0)).alias("variance")))
    out = out.withColumn("std_dev", F.sqrt("variance"))
    if digits is not None:
        out = out.select("question", "n", F.round("mean", digits).alias("mean"), "mode",
                         F.round("variance", digits).alias("variance"),
                         F.round("std_dev", digits).alias("std_dev"))
    return order_by_position(out, "question", cols)


# ---------------------------------------------------------------- A6
# Theme names and their Likert columns.
DEFAULT_THEMES = {
    "Fuego (Impulso/Liderazgo)": ["p1", "p2", "p3"],
    "Tierra (Estabilidad/Orden)": ["p4", "p5", "p6"],
    "Aire (Sociabilidad/Mente)": ["p7", "p8", "p9"],
    "Agua (Sensibilidad/Emoción)": ["p10", "p11", "p12"],
    "General/Polaridades": ["p13", "p14", "p15"],
}


def row_mean(cols: list[str]) -> Column:
    """Row-wise mean over the non-null values of ``cols``; 0.0 when all are null. Narrow."""
    total = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols), F.lit(0.0))
    count = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    return F.when(count == 0, F.lit(0.0)).otherwise(total / count)


def dimension_means(df: DataFrame, themes: dict[str, list[str]] | None = None,
                    keep: list[str] | None = None) -> DataFrame:
    """One column per theme with the row mean of its present columns (no shuffle)."""
    themes = themes or DEFAULT_THEMES
    out = [F.col(k) for k in (keep or [])]
    for name, cols in themes.items():
        cols = present(df, cols)
        df = nan_as_null(df, cols)
        if cols:
            out.append(row_mean(cols).alias(name))
    return df.select(*out)


# ---------------------------------------------------------------- A7
def basic_stats(df: DataFrame, features: list[str], digits: int | None = 2) -> DataFrame:
    """Mean, sample sd, min, max per present feature; one aggregate, stacked to rows."""
    feats = present(df, features)
    df = nan_as_null(df, feats)
    aggs = []
    for c in feats:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"),
                 F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max")]
    r = (lambda x: F.round(x, digits)) if digits is not None else (lambda x: x)
    return stack_rows(df.agg(*aggs), [
        {"feature": F.lit(c), "mean": r(F.col(f"{c}__mean")), "std": r(F.col(f"{c}__std")),
         "min": r(F.col(f"{c}__min")), "max": r(F.col(f"{c}__max"))} for c in feats])


# ---------------------------------------------------------------- A8-A15
def _numeric_frame(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[to_double(df, c).alias(c) for c in present(df, cols)])


def numeric_summary(df: DataFrame, cols: list[str], digits: int = 2) -> DataFrame:
    """A15 (with A8-A14): n, mean, median, population variance/sd, min, max, range, quartiles.

    Values are parsed per value (blank/unparsable skipped); columns with no value
    are omitted.  One scan: the input becomes a range-partitioned (column, value, n) table
    (map-side combined, written once) which is read three times: totals, centred
    squares with the mode counts, and exact quartiles by ranks (``quantiles``).  The modes
    themselves are rows of :func:`multi_mode` (a column can have unboundedly many);
    ``mode_count`` says how many there are (null: no representative mode).
    """
    from . import quantiles as Q

    cols = present(df, cols)
    ranged, per_part = Q.ranged_counts(df, cols)
    m1 = Q.column_totals(per_part)
    q = (Q.quantiles_from_ranges(ranged, per_part, (0.25, 0.5, 0.75))
         .groupBy("column").agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(f"q{k}")
                                  for k, p in ((1, 0.25), (2, 0.5), (3, 0.75))]))
    var = F.when(F.col("n") < 2, F.lit(0.0)).otherwise(F.col("ss") / F.col("n"))
    rd = lambda x: F.round(x, digits)
    out = (m1.join(Q.spread_and_modes(ranged, m1), "column").join(q, "column")
           .select("column", "n", rd(F.col("mean")).alias("mean"), rd(F.col("q2")).alias("median"),
                   rd(var).alias("variance"), rd(F.sqrt(var)).alias("std_dev"), "min", "max",
                   (F.col("max") - F.col("min")).alias("range"), rd(F.col("q1")).alias("q1"),
                   rd(F.col("q2")).alias("q2"), rd(F.col("q3")).alias("q3"), "mode_count"))
    return order_by_position(out, "column", cols)


def _modes_from_counts(counts: DataFrame) -> DataFrame:
    bounds = counts.groupBy("column").agg(F.max("n").alias("max_n"), F.min("n").alias("min_n"))
    return (counts.join(F.broadcast(bounds), "column")
            .where((F.col("n") == F.col("max_n")) & (F.col("max_n") > F.col("min_n")))
            .select("column", F.col("value").alias("mode")))


def value_counts_long(df: DataFrame, cols: list[str], numeric: bool = True) -> DataFrame:
    """(column, value, n) for every non-null value of every column: one unpivot + partial aggregate."""
    cols = present(df, cols)
    src = _numeric_frame(df, cols) if numeric else df.select(*[F.col(c).cast("string") for c in cols])
    return (src.unpivot([], cols, "column", "value")
            .where(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def multi_mode(df: DataFrame, cols: list[str]) -> DataFrame:
    """A10: all modes of each column as rows (column, mode), sorted.

    A column where every distinct value has the same frequency (this includes a
    single distinct value, and a continuous column where every count is 1) has
    no representative mode and yields no row.  The per-column max/min frequency
    table has one row per column and is joined back by column name.
    """
    return _modes_from_counts(value_counts_long(df, cols)).orderBy("column", "mode")


def median(c: str | Column) -> Column:
    """A9 as a column expression: exact median (linear interpolation) via ``percentile``.

    ``percentile`` keeps the group's distinct values in one buffer: fine for
    bounded-cardinality columns (Likert answers, sizes).  For continuous columns
    at scale use :func:`numeric_summary` / ``quantiles.quantiles_long`` (exact, by
    rank, distributed) or ``approx_median``.
    """
    return F.percentile(c, F.lit(0.5))


def approx_median(c: str | Column, accuracy: int = 10000) -> Column:
    return F.percentile_approx(c, F.lit(0.5), F.lit(accuracy))


def quartiles(c: str | Column) -> Column:
    """A14 as a column expression (bounded-cardinality columns; see :func:`median`)."""
    return F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))


# ---------------------------------------------------------------- A16
def category_frequencies(df: DataFrame, col: str, digits: int = 1) -> DataFrame:
    """(value, conteo, porcentaje) over non-null, non-empty values, sorted by value.

    The total is a scalar subquery over the same filtered input (no window, no
    cross join); its partial count runs map-side.
    """
    base = df.select(F.col(col).cast("string").alias("value")).where(
        F.col("value").isNotNull() & (F.col("value") != ""))
    counts = base.groupBy("value").agg(F.count(F.lit(1)).alias("conteo"))
    total = counts.select(F.sum("conteo")).scalar()  # reuses the counts' exchange, no second scan
    return (counts.withColumn("porcentaje", F.round(F.col("conteo") * 100.0 / total, digits))
            .orderBy("value"))


# ---------------------------------------------------------------- A23 / A27
def total_count(df: DataFrame) -> DataFrame:
    """One-row count."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def column_bounds(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, min, max) from one aggregate."""
    cols = present(df, cols)
    df = nan_as_null(df, cols)
    wide = df.agg(*[F.min(c).cast("double").alias(f"{c}__min") for c in cols],
                  *[F.max(c).cast("double").alias(f"{c}__max") for c in cols])
    return stack_rows(wide, [{"column": F.lit(c), "min": F.col(f"{c}__min"), "max": F.col(f"{c}__max")}
                             for c in cols])


# ---------------------------------------------------------------- A24-A26
def eda_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """A24 numeric part: mean, median, population variance/sd, range, min, max per column."""
    cols = present(df, cols)
    num = _numeric_frame(df, cols)
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"),
                 F.var_pop(c).alias(f"{c}__var"), F.stddev_pop(c).alias(f"{c}__sd"),
                 F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    from .quantiles import bracketed_quantiles

    med = bracketed_quantiles(df, cols, (0.5,)).select("column", F.col("value").alias("median"))
    moments = stack_rows(num.agg(*aggs), [
        {"column": F.lit(c), "n": F.col(f"{c}__n"), "mean": F.col(f"{c}__mean"),
         "variance": F.col(f"{c}__var"), "std_dev": F.col(f"{c}__sd"),
         "range": F.col(f"{c}__max") - F.col(f"{c}__min"), "min": F.col(f"{c}__min"),
         "max": F.col(f"{c}__max")} for c in cols])
    return moments.join(med, "column", "left").select(
        "column", "n", "mean", "median", "variance", "std_dev", "range", "min", "max")


def eda_categorical(df: DataFrame, cols: list[str]) -> DataFrame:
    """A24 categorical part: (column, value, n) for every non-null value."""
    return value_counts_long(df, cols, numeric=False)


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """``bins`` equal-width bins between min and max: (bin, lo, hi, n), empty bins included.

    x = max falls in the last bin; a constant column gives a single bin [min, max].
    Min and max are scalar subqueries; the per-bin counts are aggregated map-side
    and joined to the <= ``bins`` bin rows.
    """
    x = to_double(df, col)
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    lo = vals.select(F.min("x")).scalar()
    hi = vals.select(F.max("x")).scalar()
    width = (hi - lo) / bins
    bin_of = F.when(hi > lo, F.least(F.floor((F.col("x") - lo) / width).cast("int"), F.lit(bins - 1))) \
              .otherwise(F.lit(0))
    counts = vals.select(bin_of.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    edges = (df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
             .where(lo.isNotNull() & ((F.col("bin") == 0) | (hi > lo))))
    edges = edges.select("bin",
                         F.when(hi > lo, lo + F.col("bin") * width).otherwise(lo).alias("lo"),
                         F.when(hi > lo, F.when(F.col("bin") == bins - 1, hi)
                                .otherwise(lo + (F.col("bin") + 1) * width)).otherwise(hi).alias("hi"))
    return (edges.join(F.broadcast(counts), "bin", "left")
            .select("bin", "lo", "hi", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
            .orderBy("bin"))


def relative_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, mean, relative) with relative = mean / max(mean) * 100 (max 0 -> divide by 1)."""
    cols = present(df, cols)
    df = nan_as_null(df, cols)
    wide = df.agg(*[F.avg(c).alias(c) for c in cols])
    top = F.greatest(*[F.col(c) for c in cols]) if len(cols) > 1 else F.col(cols[0])
    wide = wide.withColumn("__top", F.when((top.isNull()) | (top == 0), F.lit(1.0)).otherwise(top))
    return stack_rows(wide, [{"column": F.lit(c), "mean": F.col(c),
                              "relative": F.col(c) / F.col("__top") * 100.0} for c in cols])
