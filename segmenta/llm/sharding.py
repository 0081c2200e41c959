"""Operator 11: a uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

How many rows of each input block go to each shard is drawn first, exactly as a uniform shuffle of all rows would deal
them out: row sums are the blocks' sizes, column sums the shards'.  The matrix is never built whole.  The blocks are the
leaves of a binary tree; at a node, the left half's share of every shard is hypergeometric, drawn from a generator
seeded by the node.  A task walks from the root to the blocks it holds and so gets their rows of the matrix, the same
ones on every executor and retry.  Then a block permutes its rows and deals them by its row of the matrix (first
permutation), the rows are exchanged, and random 63-bit numbers order each shard (second permutation): their range is cut
into cells of about ``CELL`` rows, a cell's rows are ranked in one task, and the cells before it give its first slot.

A block is at most 2 ** 20 neighbouring rows of one input partition, so no key, text or source makes one large.  Blocks
and places in them are pinned by a written table.  What the driver sees and sends out is one count per block, at most
(rows / 2 ** 20 + input partitions) numbers.  The same seed gives the same result for the same partitions of the input.

The law is ``rows``: shard sizes differ by at most one, larger ones first.  Equal texts are dealt like any other rows, each
on its own, as a uniform shuffle does.  A null text has no bytes (size 1, the checksum of nothing); a null id, repeated
rows and ties are rows like any other; fewer rows than shards leave shards empty; an empty table gives no rows.  Extra
columns are dropped by ``digest`` and kept by ``shuffle`` and ``write_shards``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .textarrays import mix

CELL = 1 << 16  # rows ranked together, about


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Marked ones among ``n`` drawn without replacement from ``good`` marked and ``bad`` others, of any size.

    Inversion over the values around the mode, by ratios of neighbouring probabilities; what lies more than 40 standard
    deviations away has a probability far below a double's resolution.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    mode = min(max((good + 1) * (n + 1) // (total + 2), low), high)
    spread = 40 * int(np.sqrt(n * (good / total) * (bad / total) * ((total - n) / max(total - 1, 1)))) + 40
    low, high = max(low, mode - spread), min(high, mode + spread)
    x = np.arange(low, high, dtype=np.float64)
    steps = np.log((good - x) * (n - x)) - np.log((x + 1) * (bad - n + x + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    mass = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(mass, rng.random() * mass[-1], side="right").clip(0, high - low))


def split(rng: np.random.Generator, shares: tuple[int, ...], n: int) -> tuple[int, ...]:
    """How many of ``n`` rows, drawn from rows of which ``shares`` go to each shard, go to each shard."""
    out, rest = [], sum(shares)
    for share in shares:
        rest -= share
        out.append(hypergeometric(rng, share, rest, n))
        n -= out[-1]
    return tuple(out)


class Matrix:
    """Rows of the communication matrix of blocks of given sizes, drawn on demand."""

    def __init__(self, sizes: np.ndarray, shards: int, seed: int):
        self.ends = np.concatenate([[0], np.cumsum(sizes)])
        total = int(self.ends[-1])
        self.seed, self.whole = seed, tuple(total // shards + (j < total % shards) for j in range(shards))
        self.node = functools.lru_cache(maxsize=256)(self._node)

    def _node(self, lo: int, hi: int, depth: int, at: int) -> tuple[int, ...]:
        """Rows that go from blocks lo..hi to each shard; ``at`` numbers the nodes of one depth."""
        if not depth:
            return self.whole
        # the parent of (lo, hi) is known by its number: walk down again from the root
        parent_lo, parent_hi = self.range(depth - 1, at // 2)
        both = self.node(parent_lo, parent_hi, depth - 1, at // 2)
        middle = (parent_lo + parent_hi) // 2
        rng = np.random.default_rng([self.seed, depth - 1, at // 2])
        left = split(rng, both, int(self.ends[middle] - self.ends[parent_lo]))
        return left if at % 2 == 0 else tuple(b - a for a, b in zip(left, both, strict=True))

    def range(self, depth: int, at: int) -> tuple[int, int]:
        lo, hi = 0, len(self.ends) - 1
        for k in reversed(range(depth)):
            middle = (lo + hi) // 2
            lo, hi = (middle, hi) if at >> k & 1 else (lo, middle)
        return lo, hi

    def row(self, block: int) -> tuple[int, ...]:
        lo, hi, depth, at = 0, len(self.ends) - 1, 0, 0
        while hi - lo > 1:
            middle = (lo + hi) // 2
            right = block >= middle
            lo, hi = (middle, hi) if right else (lo, middle)
            depth, at = depth + 1, 2 * at + right
        return self.node(lo, hi, depth, at)


def pinned(rows: DataFrame, block_bits: int) -> DataFrame:
    """``row, at, block, place``: the rows, written once, with their partition and place (``at``) and block."""
    at = F.col("at")
    return (materialize(rows.select(F.struct("*").alias("row")).withColumn("at", F.monotonically_increasing_id()), "shard-rows")
            .withColumn("block", F.shiftright(at, block_bits)).withColumn("place", (at % (1 << block_bits)).cast("int")))


def deal(placed: DataFrame, names: np.ndarray, sizes: np.ndarray, shards: int, cells: int, seed: int) -> DataFrame:
    """``placed`` with the ``shard`` of each row, its random number ``r`` for the place there, and the ``cell`` of that number."""
    given = placed.schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = Matrix(sizes, shards, seed)

        @functools.lru_cache(maxsize=4)
        def permuted(k: int) -> np.ndarray:
            dealt = np.repeat(np.arange(shards, dtype=np.int32), matrix.row(k))
            return np.random.default_rng([seed, 1 << 32, int(names[k])]).permutation(dealt)

        for b in batches:
            if not b.num_rows:
                continue
            block, place = b.column("block").to_numpy(), b.column("place").to_numpy()
            shard = np.empty(len(block), np.int32)
            edges = np.flatnonzero(np.diff(block, prepend=block[0] - 1, append=block[-1] + 1))
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                shard[lo:hi] = permuted(int(np.searchsorted(names, block[lo])))[place[lo:hi]]
            with np.errstate(over="ignore"):
                start = mix(np.array([seed + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                r = mix(b.column("at").to_numpy().astype(np.uint64) ^ start) >> np.uint64(1)
            cell = (r.astype(np.float64) * (cells / 2.0 ** 63)).astype(np.int64).clip(0, cells - 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard), pa.array(cell), pa.array(r.astype(np.int64))],
                                             names=[*(f.name for f in given), "shard", "cell", "r"])

    return placed.mapInArrow(run, T.StructType([*given, *T.StructType.fromDDL("shard int, cell long, r long").fields]))


def shuffle(rows: DataFrame, shards: int = 16, seed: int = 0, block_bits: int = 20) -> DataFrame:
    """``rows`` with ``shard`` (int, from 0) and ``slot`` (long, the place in it, gapless from 0); columns of these names are replaced."""
    rows = rows.drop("shard", "slot")
    placed = pinned(rows, block_bits)
    blocks = placed.groupBy("block").agg(F.count(F.lit(1)).alias("n")).orderBy("block").toPandas()
    names, sizes = blocks["block"].to_numpy(np.int64), blocks["n"].to_numpy(np.int64)
    cells = max(1, -(-int(sizes.sum()) // (shards * CELL)))
    # first slot of each cell: one row per cell; only the places are read for it
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    first = (deal(placed.drop("row"), names, sizes, shards, cells, seed).groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
             .select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    within = Window.partitionBy("shard", "cell").orderBy("r", "at")
    return (deal(placed, names, sizes, shards, cells, seed).withColumn("rank", F.row_number().over(within) - 1).join(first, ["shard", "cell"])
            .select("row.*", "shard", (F.col("first") + F.col("rank")).cast("long").alias("slot")))


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 0) -> None:
    """All columns of ``docs`` as Parquet below ``path``, a folder ``shard=N`` each, files and rows in the order of the slots."""
    dealt = shuffle(docs, shards, seed)
    dealt.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def digest(docs: DataFrame, shards: int = 16, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row; only these columns are moved."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    thin = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    return shuffle(thin, shards, seed).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                              F.lit(None).cast("int").alias("grown_shard"))
