"""Scoring new survey records as they arrive (Structured Streaming).

The reference has no streaming operators; what carries over are its stateless
row operators, which are plain Catalyst expressions and therefore run unchanged
on a streaming DataFrame: scaling with fitted parameters (M1/M2), assignment to
saved centroids (M15), lexicon polarity (N1/N2) and theme means (A6).  Running
cluster sizes (A21) are the one stateful aggregate, keyed by the (small) label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cluster.assign import assign_nearest
from ..operators.stats import dimension_means
from ..operators.text import sentiment_rows


def score(df: DataFrame, features: list[str], centroids, scaler=None, text_cols: list[str] | None = None,
          keep: list[str] | None = None, label_col: str = "Cluster") -> DataFrame:
    """Stateless scoring usable on batch or streaming input: one projection, no join, no state.

    Adds ``label_col`` (nearest saved centroid on the scaled features); with
    ``text_cols`` also ``sentimiento_promedio`` and the five theme means.
    """
    keep = keep if keep is not None else [c for c in ("id",) if c in df.columns]
    scaled_names = {f: f"__s_{f}" for f in features}
    base = df.select("*", *[F.col(f).alias(scaled_names[f]) for f in features])
    if scaler is not None:
        renamed = type(scaler)({scaled_names[k]: v for k, v in
                                (scaler.bounds if hasattr(scaler, "bounds") else scaler.moments).items()
                                if k in scaled_names})
        base = renamed.transform(base)
    out = assign_nearest(base, list(scaled_names.values()), centroids, label_col)
    cols = [*keep, label_col]
    if text_cols:
        out = sentiment_rows(out, text_cols, keep=out.columns)
        out = dimension_means(out, keep=[*cols, "sentimiento_promedio"])
        return out
    return out.select(*cols)


def read_stream(spark: SparkSession, source_dir: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        r = r.option("header", True)
    return r.load(source_dir)


def start_scoring(scored: DataFrame, sink_dir: str, checkpoint: str, trigger_once: bool = True):
    """Append scored rows to Parquet with an exactly-once file sink (checkpointed offsets)."""
    w = scored.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="10 seconds")
    return w.start()


def running_cluster_sizes(scored: DataFrame, label_col: str = "Cluster") -> DataFrame:
    """A21 over a stream: state is one counter per label (bounded by k)."""
    return scored.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
