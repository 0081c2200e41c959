"""Operator 1: exact top-k by inner product over a bit-sliced index.

Attributes are whole numbers.  A block of rows stores, per dimension, the binary digits of (value - smallest value of the
block) as bitmaps.  A query's scores for all rows of a block are made by bitmap arithmetic alone: its digits select
shifted slices, carry-save adders sum them (three bitmaps in, two out), a ripple adder finishes.  The top rows are then
read off from the most significant slice downward; rows that tie at the border are resolved by the smaller id, exactly.

Blocks of rows meet blocks of queries as cells of a grid; each cell yields at most k rows per query, and a last rank per
query picks the k best.  No block, cell or query set goes through the driver.

Vectors that are null or hold null or non-finite components take no part.  Vectors of other lengths are scored only
against their like.  Identical (id, vector) rows count once; a query never meets rows of its own id.  Empty tables give
no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


CELL_TASKS = 20_000  # tasks among which the cells of a search are dealt, at most


def quantised(df: DataFrame, id_col: str, vector_col: str, factor: int = 256) -> DataFrame:
    """``id, v``: floor(factor * x) per component of every usable vector; distinct rows."""
    v = F.col(vector_col)
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.where(fine & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * factor).cast("long")).alias("v"))
            .distinct())


def build_block(ids: np.ndarray, values: np.ndarray) -> dict:
    """Slices of one block: rows in id order, ``slices[d, i]`` the bitmap of digit i of dimension d."""
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order]
    low = values.min(axis=0)
    rest = (values - low).astype(np.uint64)
    bits = max(1, int(rest.max()).bit_length())
    words = -(-len(ids) // 64)
    slices = np.zeros((values.shape[1], bits, words * 8), np.uint8)
    for i in range(bits):
        packed = np.packbits((rest >> np.uint64(i) & np.uint64(1)).astype(np.uint8).T, axis=1, bitorder="little")
        slices[:, i, :packed.shape[1]] = packed
    return {"ids": ids, "low": low, "bits": bits, "words": words, "slices": slices.tobytes()}


class Block:
    def __init__(self, ids, low, bits, words, slices):
        self.ids, self.low, self.bits, self.words = ids, low, bits, words
        self.slices = np.frombuffer(slices, np.uint64).reshape(len(low), bits, words)
        self.present = np.zeros(words * 8, np.uint8)
        packed = np.packbits(np.ones(len(ids), np.uint8), bitorder="little")
        self.present[:len(packed)] = packed
        self.present = self.present.view(np.uint64)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """(bitmaps of sum, least first; constant): the score of a row is its number in the bitmaps plus the constant."""
        constant = int(sum(int(a) * int(b) for a, b in zip(query, self.low, strict=True)))
        by_shift: dict[int, list[np.ndarray]] = {}
        for d, q in enumerate(query.tolist()):
            piece = self.slices[d]
            if q < 0:  # -|q| v = |q| (top - v) - |q| top
                piece = ~piece
                constant += q * ((1 << self.bits) - 1)
            for shift in range(abs(q).bit_length()):
                if abs(q) >> shift & 1:
                    by_shift.setdefault(shift, []).append(piece)
        # carry-save: all digits of three numbers at once, until at most two numbers are left at each shift
        shift, columns = 0, {}
        while by_shift:
            todo = by_shift.pop(shift, [])
            while len(todo) > 2:
                a, b, c = todo.pop(), todo.pop(), todo.pop()
                x = a ^ b
                todo.insert(0, x ^ c)
                by_shift.setdefault(shift + 1, []).append(a & b | x & c)
            for number in todo:
                for i, bitmap in enumerate(number):
                    columns.setdefault(shift + i, []).append(bitmap)
            shift += 1
        # single bitmaps by weight: full and half adders, carries go up
        out, weight = [], 0
        while columns:
            todo = columns.pop(weight, [])
            while len(todo) > 1:
                a, b = todo.pop(), todo.pop()
                x = a ^ b
                if todo:
                    c = todo.pop()
                    todo.insert(0, x ^ c)
                    carry = a & b | x & c
                else:
                    todo.append(x)
                    carry = a & b
                columns.setdefault(weight + 1, []).append(carry)
            out.append(todo[0] if todo else np.zeros(self.words, np.uint64))
            weight += 1
        return out, constant

    def top(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The k best (id, score), ties to the smaller id."""
        planes, constant = self.scores(query)
        border = self.present.copy()
        for at in range(*np.searchsorted(self.ids, [own, own + 1])):
            border[at >> 6] &= ~(np.uint64(1) << np.uint64(at & 63))
        sure = np.zeros_like(border)
        for plane in reversed(planes):
            ones = border & plane
            n = int(np.bitwise_count(sure | ones).sum())
            if n > k:
                border = ones
            else:
                sure |= ones
                border &= ~plane
                if n == k:
                    border[:] = 0
                    break
        rows = positions(sure)
        rows = np.concatenate([rows, positions(border)[:k - len(rows)]])
        score = [constant + sum(int(p[r >> 6] >> np.uint64(r & 63) & np.uint64(1)) << w for w, p in enumerate(planes)) for r in rows.tolist()]
        return list(zip(self.ids[rows].tolist(), score, strict=True))


def positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def build_index(vectors: DataFrame, block_rows: int = 16384) -> DataFrame:
    """``dim, block, ids, low, bits, words, slices`` from ``id, v``: blocks of about ``block_rows`` rows, written once."""
    per_dim = vectors.groupBy(F.size("v").alias("dim")).agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks"))
    keyed = (vectors.withColumn("dim", F.size("v")).join(per_dim, "dim")
             .withColumn("block", F.pmod(F.xxhash64("id", "v"), F.col("blocks"))).drop("blocks"))

    def build(key, pdf):
        b = build_block(pdf["id"].to_numpy(np.int64), np.stack(pdf["v"].to_numpy()).astype(np.int64))
        return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "ids": [b["ids"]], "low": [b["low"]], "bits": [b["bits"]],
                             "words": [b["words"]], "slices": [b["slices"]]})

    schema = "dim int, block long, ids array<long>, low array<long>, bits int, words int, slices binary"
    return materialize(keyed.groupBy("dim", "block").applyInPandas(build, schema), "bit-slices")


def search(index: DataFrame, queries: DataFrame, k: int = 5, query_rows: int = 512) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row of ``queries(id, v)`` its k best rows of the index.

    A block is sent to one cell per sheet of ``query_rows`` queries, and every cell is dealt out by itself.
    """
    # several vectors may bear one id: each is a query of its own, numbered so that results stay apart
    q = queries.withColumn("dim", F.size("v")).withColumn("twin", F.row_number().over(Window.partitionBy("id").orderBy("v")))
    per_dim = q.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / query_rows).alias("sheets"))
    sheets = (q.join(per_dim, "dim").withColumn("sheet", F.pmod(F.xxhash64("id", "twin"), F.col("sheets")))
              .groupBy("dim", "sheet").agg(F.collect_list(F.struct("id", "twin", "v")).alias("queries")))
    sheets = materialize(sheets, "query-sheets")
    names = materialize(index.select("dim", "block").join(sheets.select("dim", "sheet"), "dim"), "top-k-grid")  # names of blocks only
    cells = names.join(sheets, ["dim", "sheet"]).join(index, ["dim", "block"]).repartition(min(max(names.count(), 1), CELL_TASKS), "dim", "block", "sheet")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                cell = {c: b.column(c)[i] for c in ("ids", "low", "bits", "words", "slices", "queries")}
                block = Block(cell["ids"].values.to_numpy(), cell["low"].values.to_numpy(), cell["bits"].as_py(),
                              cell["words"].as_py(), cell["slices"].as_buffer())
                found = [(one["id"], one["twin"], vec, score) for one in cell["queries"].as_py()
                         for vec, score in block.top(np.array(one["v"], np.int64), one["id"], k)]
                cols = list(zip(*found, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                                                  pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                                                 names=["query_id", "twin", "vec_id", "score"])

    found = cells.drop("dim", "block", "sheet").mapInArrow(run, "query_id long, twin int, vec_id long, score long")
    best = Window.partitionBy("query_id", "twin").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def top_k(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5) -> DataFrame:
    """Queries are the rows whose id is divisible by ``every``; candidates are all rows but the query's own."""
    vectors = quantised(df, id_col, vector_col)
    return search(build_index(vectors), vectors.where(F.col("id") % every == 0), k)
