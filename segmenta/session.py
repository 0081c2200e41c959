"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_spark(app: str = "segmenta", cpus: int | str = "*", shuffle_partitions: int | None = None,
              event_log_dir: str | None = None) -> SparkSession:
    """Local session used by tests, bench and examples.

    On a cluster the session comes from the launcher; nothing here is needed.
    """
    parts = shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1) * 2)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SEGMENTA_DRIVER_MEMORY", "16g"))
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    The cluster names it in ``spark.checkpoint.dir``; we only create our own
    (a fresh scratch folder) when the session has none and runs in one process,
    as in local tests: a folder of one machine is no use to executors on others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="segmenta-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


_SCOPES: list[list[str]] = []


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialize`` writes inside go when the block ends without an error: what was made of them has to be written by then."""
    _SCOPES.append([])
    try:
        yield
    except BaseException:
        _SCOPES.pop()
        raise
    for path in _SCOPES.pop():
        remove_folder(spark, path)


def materialize(df, name: str = "t", observe: list | None = None):
    """Cut lineage by writing ``df`` as Parquet under the session's checkpoint folder and reading it back.

    Columnar and splittable, so re-reading is cheap and survives executor loss.
    With ``observe`` (aggregate Columns), their values are computed during the
    same write job and returned as a dict alongside the frame (no extra job).
    """
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    if observe:
        from pyspark.sql import Observation

        obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        df.observe(obs, *observe).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path), obs.get
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
