"""Exact quantiles (linear interpolation at p*(n-1)) without a single-task value buffer.

``percentile`` keeps every distinct value of a group in one aggregation buffer,
merged in one final task — unbounded for a continuous column at scale.  Here:

1. (column, value) -> count, aggregated map-side (a hot value is one row after this);
2. range-partition those rows by (column, value) and materialise them, so each
   partition holds a contiguous value range;
3. per (partition, column) totals — one row per partition and column — give each
   partition its starting rank (a small window over partition ids);
4. a running count inside each partition locates the rows holding ranks
   floor(p*(n-1)) and the next one, then interpolation.

Every step is a partitioned job; the only broadcast is the (partitions x columns)
offset table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from ._util import present


def value_counts_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value double, n) over the non-null parsed values ('nan' parses to NaN and counts,
    as in the reference; NaN sorts after every number)."""
    from .stats import to_double

    cols = present(df, cols)
    num = df.select(*[to_double(df, c).alias(c) for c in cols])
    return (num.unpivot([], cols, "column", "value")
            .where(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def quantiles_long(df: DataFrame, cols: list[str], probs=(0.25, 0.5, 0.75),
                   partitions: int | None = None) -> DataFrame:
    """(column, p, value) for every column with at least one value."""
    return quantiles_from_ranges(*ranged_counts(df, cols, partitions), probs)


def ranged_counts(df: DataFrame, cols: list[str], partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The (column, value, n, pid) table, range-partitioned and written once, and its totals per (pid, column)."""
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(value_counts_numeric(df, cols).repartitionByRange(parts, "column", "value")
                         .withColumn("pid", F.spark_partition_id()), "ranged")
    per_part = ranged.groupBy("pid", "column").agg(
        F.sum("n").alias("pn"), F.sum(F.col("n") * F.col("value")).alias("total"), F.min("value").alias("min"),
        F.max("value").alias("max"), F.min("n").alias("min_n"), F.max("n").alias("max_n"))
    return ranged, materialize(per_part, "ranged-totals")


def column_totals(per_part: DataFrame) -> DataFrame:
    """(column, n, mean, min, max, min_n, max_n) from the totals per partition."""
    return per_part.groupBy("column").agg(
        F.sum("pn").alias("n"), (F.sum("total") / F.sum("pn")).alias("mean"), F.min("min").alias("min"),
        F.max("max").alias("max"), F.min("min_n").alias("min_n"), F.max("max_n").alias("max_n"))


def spread_and_modes(ranged: DataFrame, totals: DataFrame) -> DataFrame:
    """(column, ss, mode_count): centred squares and the number of modes (null where there is none), in one pass."""
    around = F.broadcast(totals.select("column", "mean", "min_n", "max_n"))
    modes = F.count_if((F.col("n") == F.col("max_n")) & (F.col("max_n") > F.col("min_n")))
    return (ranged.join(around, "column").groupBy("column")
            .agg(F.sum(F.col("n") * (F.col("value") - F.col("mean")) ** 2).alias("ss"), modes.alias("mode_count"))
            .withColumn("mode_count", F.when(F.col("mode_count") > 0, F.col("mode_count"))))


def quantiles_from_ranges(ranged: DataFrame, per_part: DataFrame, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """(column, p, value) from :func:`ranged_counts`; one pass over the counts."""
    offsets = per_part.select(
        "pid", "column",
        (F.sum("pn").over(Window.partitionBy("column").orderBy("pid")) - F.col("pn")).alias("off"))
    run = F.sum("n").over(Window.partitionBy("pid", "column").orderBy("value")
                          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cum = (ranged.withColumn("run", run).join(F.broadcast(offsets), ["pid", "column"])
           .select("column", "value", (F.col("off") + F.col("run") - F.col("n")).alias("lo_rank"),
                   (F.col("off") + F.col("run")).alias("hi_rank")))
    # for each p, the two ranks bracketing p*(n-1): one row per (column, p, side)
    totals = per_part.groupBy("column").agg(F.sum("pn").alias("total"))
    pos = F.col("p") * (F.col("total") - 1)
    targets = (totals.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
               .select("column", "p", pos.alias("pos"), F.floor(pos).cast("long").alias("r0"),
                       F.least(F.floor(pos).cast("long") + 1, F.col("total") - 1).alias("r1"))
               .select("column", "p", "pos", "r0",
                       F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("r0").alias("rank")),
                                         F.struct(F.lit(1).alias("side"), F.col("r1").alias("rank")))).alias("t"))
               .select(F.col("column").alias("tcol"), "p", "pos", "r0", "t.side", "t.rank"))
    hit = cum.join(F.broadcast(targets), (F.col("column") == F.col("tcol")) & (F.col("lo_rank") <= F.col("rank"))
                   & (F.col("rank") < F.col("hi_rank")))
    return (hit.groupBy("column", "p")
            .agg(F.max("pos").alias("pos"), F.max("r0").alias("r0"),
                 F.max(F.when(F.col("side") == 0, F.col("value"))).alias("v0"),
                 F.max(F.when(F.col("side") == 1, F.col("value"))).alias("v1"))
            .select("column", "p", (F.col("v0") + (F.col("pos") - F.col("r0")) * (F.col("v1") - F.col("v0")))
                    .alias("value")))


FEW = 4096  # values between two bounds from which a quantile is read off
ACCURACY = 2000  # of the sketch: its ranks are off by at most this fraction of the values


def bracketed_quantiles(df: DataFrame, cols: list[str], probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """(column, p, value) as :func:`quantiles_long`, without shuffling the values.

    A mergeable rank sketch (one aggregate over all columns) brackets each quantile; a pass counts what lies below and
    inside.  That is repeated inside the bracket until few values are left, or one value that occurs often, and these alone
    are counted one by one.  Exact: a bracket that misses its ranks is not used.  Rows that reach the driver: bounds and counts
    per quantile, and at most about ``FEW`` values of each.
    """
    from .stats import to_double

    cols = present(df, cols)
    num = df.select(*[to_double(df, c).alias(c) for c in cols])
    sizes = num.agg(*[F.count(c).alias(f"{c}__n") for c in cols], *[F.count_if(F.isnan(c)).alias(f"{c}__nan") for c in cols]).first()
    spots = []
    for c in cols:
        n, nans = sizes[f"{c}__n"], sizes[f"{c}__nan"]
        for p in probs:
            if n:
                at = p * (n - 1)
                r0 = int(at)
                all_, none = (float("-inf"), float("inf")), (float("inf"), float("-inf"))
                lo, hi = all_ if r0 < n - nans else none  # ranks past the numbers are those of NaN
                spots.append({"column": c, "p": float(p), "at": at, "r0": r0, "r1": min(r0 + 1, n - 1), "numbers": n - nans,
                              "lo": lo, "hi": hi, "below": 0, "inside": n - nans})
    while True:
        wide = [s for s in spots if s["inside"] > FEW and s["lo"] < s["hi"] and not s.get("stuck")]
        if not wide:
            break
        _narrow(num, wide)
    return _read_off(num, spots)


def _inside(s: dict):
    x = F.col(s["column"])
    return ~F.isnan(x) & (x >= F.lit(s["lo"])) & (x <= F.lit(s["hi"]))


def _narrow(num: DataFrame, spots: list[dict]) -> None:
    aggs = []
    for k, s in enumerate(spots):
        ranks = [(s[r] - s["below"]) / s["inside"] + step * 2 / ACCURACY for r, step in (("r0", -1), ("r1", 1))]
        bounds = F.array(*[F.lit(min(max(r, 0.0), 1.0)) for r in ranks])
        aggs.append(F.percentile_approx(F.when(_inside(s), F.col(s["column"])), bounds, ACCURACY).alias(f"b{k}"))
    row = num.agg(*aggs).first()
    tries = [s | {"lo": row[f"b{k}"][0], "hi": row[f"b{k}"][1]} for k, s in enumerate(spots)]
    counts = num.agg(*[F.count_if(~F.isnan(s["column"]) & (F.col(s["column"]) < F.lit(s["lo"]))).alias(f"below{k}") for k, s in enumerate(tries)],
                     *[F.count_if(_inside(s)).alias(f"inside{k}") for k, s in enumerate(tries)]).first()
    for k, (s, t) in enumerate(zip(spots, tries, strict=True)):
        below, inside = counts[f"below{k}"], counts[f"inside{k}"]
        holds = below <= s["r0"] and min(s["r1"], s["numbers"] - 1) < below + inside
        if holds and inside < s["inside"]:
            s |= {"lo": t["lo"], "hi": t["hi"], "below": below, "inside": inside}
        else:
            s["stuck"] = True  # values that occur often: few different ones are left


def _read_off(num: DataFrame, spots: list[dict]) -> DataFrame:
    schema = "column string, p double, value double"
    if not spots:
        return num.sparkSession.createDataFrame([], schema)
    rows = F.array(*[F.struct(F.lit(k).alias("k"), F.when(_inside(s), F.col(s["column"])).alias("value")) for k, s in enumerate(spots)])
    found = num.select(F.inline(rows)).where(F.col("value").isNotNull()).groupBy("k", "value").agg(F.count(F.lit(1)).alias("n"))
    held: dict[int, list] = {}
    for r in found.collect():
        held.setdefault(r["k"], []).append((r["value"], r["n"]))
    out = []
    for k, s in enumerate(spots):
        values = []
        for rank in (s["r0"], s["r1"]):
            run, value = s["below"], float("nan")
            for v, n in sorted(held.get(k, [])):
                run += n
                if rank < run:
                    value = v
                    break
            values.append(value)
        out.append((s["column"], s["p"], values[0] + (s["at"] - s["r0"]) * (values[1] - values[0])))
    return num.sparkSession.createDataFrame(out, schema)
