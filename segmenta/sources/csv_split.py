"""CSV files whose quoted cells hold line breaks, read in parallel.

A file is cut into Spark's usual ranges of lines.  Whether a range begins inside a quoted cell depends only on the number of
quote characters before it, so a first pass counts them per range (one row each), and a second pass joins each
range's lines to records.  Only a record that reaches over the end of its range leaves it, in pieces, to be put together by a
small aggregate.  Quotes inside cells are doubled, so they never change the parity; files that escape them otherwise
need the reader that parses each file in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHOLE, HEAD, TAIL = 0, 1, 2
PIECES = "file string, block long, kind int, first boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.csv").text(path)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in file order with ``inside`` (whether their range begins in a quoted cell) -> records and pieces of records."""
    place, open_, odd, head, header = None, [], False, False, False

    def row(kind: int, lines: list[str]) -> tuple:
        return (*place, kind, header and kind != HEAD, "\n".join(lines))

    def closed() -> list[tuple]:
        """What a range leaves at its end."""
        return [row(HEAD if head else TAIL if odd else WHOLE, open_)] if open_ else []

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["file", "block", "kind", "first", "record"])

    for b in batches:
        out: list[tuple] = []
        quotes = pc.count_substring(b.column("value"), '"').to_numpy(zero_copy_only=False)
        values, files, blocks, insides = (b.column(c).to_pylist() for c in ("value", "file", "block", "inside"))
        for value, n, file, block, inside in zip(values, quotes.tolist(), files, blocks, insides, strict=True):
            if place != (file, block):
                out += closed()
                place, open_, odd, head, header = (file, block), [], bool(inside), bool(inside), block == 0
            elif not odd:  # the line before ended its record
                out.append(row(HEAD if head else WHOLE, open_))
                header = header and head
                open_, head = [], False
            open_.append(value)
            odd ^= bool(n & 1)
        if out:
            yield batch(out)
    if place is not None:
        yield batch(closed())


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, first, record``: every record of the CSV files below ``path`` as its text; ``first`` marks each file's first one."""
    lines = _lines(spark, path)
    odd = (F.sum(F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2).alias("odd")
    before = F.sum("odd").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    ranges = lines.groupBy("file", "block").agg(odd).select("file", "block", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside"))
    # one row per range of lines; the join keeps the lines' order
    pieces = lines.join(F.broadcast(ranges), ["file", "block"]).select("value", "file", "block", "inside").mapInArrow(_joined, PIECES)
    whole = pieces.where(F.col("kind") == WHOLE).select("file", "first", "record")
    cut = pieces.where(F.col("kind") != WHOLE)
    which = F.sum((F.col("kind") == TAIL).cast("int")).over(Window.partitionBy("file").orderBy("block", "kind"))
    joined = (cut.withColumn("which", which).groupBy("file", "which")
              .agg(F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("block", F.expr(f"kind = {TAIL}").alias("tail"), "record"))).alias("parts"))
              .select("file", "first", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record")))
    ended = F.regexp_replace("record", "\r\\z", "")
    return whole.unionByName(joined).select("file", "first", ended.alias("record"))


def parse_records(records: DataFrame, ddl: str, options: dict, header: bool) -> DataFrame:
    """The records' cells; blank records and, with ``header``, each file's first one are left out."""
    rows = records.where(F.col("record") != "")
    if header:
        rows = rows.where(~F.col("first"))
    opts = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}
    return rows.select(F.from_csv("record", ddl, opts | {"multiLine": "true"}).alias("r")).select("r.*")
