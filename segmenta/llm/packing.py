"""Operator 2: best-fit packing with large-item matching.

Lengths are whole numbers up to the capacity, so the packing problem of any corpus is a histogram of at most
``capacity`` counts.  Spark tokenises and counts; the plan is made on the histogram (its size does not grow with the
data) as runs "items of length L and rank r..r+n go to sequences s..s+n at offset o"; Spark then ranks the pieces of
each length and looks its run up.  No piece goes through the driver or one task.

Plan: items above a third of the capacity fit at most two to a sequence; the largest takes the longest such partner
that still fits.  Smaller items, longest first, go where the least room that suffices is left (best fit).

Null text packs as the empty text (its closing id alone); repeated rows are packed as often as they occur; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import json
import os
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .textarrays import distinct_chunks, ragged_take, text_rows, text_slices


class ChunkEncoder:
    """Ids of distinct chunks by the library; chunks of earlier batches are remembered, within a bound.

    Many chunks go through one library call, joined by a special token of the vocabulary whose id marks the borders;
    a chunk that itself holds that token's string is encoded alone.
    """

    MEMO_ENTRIES = 200_000
    JOINED = 256

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs one task per core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        self.folds = {"Replace", "Lowercase"} <= {x["type"] for x in steps} and {"Regex": "\\s+"} in [x.get("pattern") for x in steps]
        special = {i: t for i, t in self.tok.get_added_tokens_decoder().items() if t.special and not (t.lstrip or t.rstrip or t.single_word)}
        self.border, self.mark = max(((i, t.content) for i, t in special.items()), default=(None, None))
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.ptr, self.values = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids per text, all ids) of texts without the mark."""
        if self.mark is None:
            ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
            return (np.fromiter(map(len, ids), np.int64, len(ids)),
                    np.fromiter((x for one in ids for x in one), np.uint32, sum(map(len, ids))))
        joined = ["".join(c + self.mark for c in texts[i:i + self.JOINED]) for i in range(0, len(texts), self.JOINED)]
        parts = [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(joined, add_special_tokens=False)]
        flat = np.concatenate([*parts, np.zeros(0, np.uint32)])
        ends = np.flatnonzero(flat == self.border)
        return np.diff(ends, prepend=-1) - 1, flat[flat != self.border]

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of each chunk, ptr, ids)."""
        if len(self.memo) + len(chunks) > self.MEMO_ENTRIES:
            self.forget()
        new = [c for c in chunks if c not in self.memo]
        alone = [c for c in new if self.mark is not None and self.mark in c]
        plain = [c for c in new if self.mark is None or self.mark not in c] if alone else new
        lengths, values = self.library(plain)
        odd = [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(alone, add_special_tokens=False)]
        lengths = np.concatenate([lengths, np.fromiter(map(len, odd), np.int64, len(odd))])
        self.memo.update(zip(plain + alone, range(len(self.memo), len(self.memo) + len(new)), strict=True))
        self.ptr = np.concatenate([self.ptr, self.ptr[-1] + np.cumsum(lengths)])
        self.values = np.concatenate([self.values, values, *odd])
        return np.fromiter((self.memo[c] for c in chunks), np.int64, len(chunks)), self.ptr, self.values


@functools.lru_cache(maxsize=4)
def chunk_encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def encode_rows(path: str, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every row as (ptr, ids): each distinct chunk is encoded once by the library."""
    encoder = chunk_encoder(path)
    plain = not any(pc.any(pc.match_substring(text, s, ignore_case=True)).as_py() for s in encoder.special)
    chunks, codes, _, rows = distinct_chunks(text, words=plain, fold=plain and encoder.folds)
    at, ptr, ids = encoder.encode(chunks.to_pylist())
    values, per = ragged_take(ptr, ids, at[codes])
    return per[rows], values


def tokenize_pieces(docs: DataFrame, vocab_path: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: the document's ids and a closing ``end_id``, cut only where longer than ``capacity``.

    ``doc_id, piece, start, length, ids_crc32`` and, with ``keep_ids``, the ids themselves.
    """
    names = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            ptr, values = encode_rows(vocab_path, b.column("text"))
            out: list[list] = [[] for _ in names]
            for i, doc in enumerate(b.column("id").to_pylist()):
                ids = np.append(values[ptr[i]:ptr[i + 1]], np.uint32(end_id)).astype("<u4")
                for k, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    row = (doc, k, start, len(part), zlib.crc32(part.tobytes())) + ((part.tolist(),) if keep_ids else ())
                    for col, v in zip(out, row, strict=True):
                        col.append(v)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=False)], names=names)

    schema = f"{id_col} long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * keep_ids
    return text_rows(docs, id_col, text_col).mapInArrow(run, schema)


def packing_plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs ``(length, first rank, count, first sequence, offset)`` covering the histogram, and the number of sequences."""
    left = {k: v for k, v in histogram.items() if v}
    used: dict[int, int] = defaultdict(int)
    runs, gaps, bins = [], defaultdict(list), 0  # gaps: room left -> [(first sequence, count)]

    def put(length: int, n: int, first: int, offset: int) -> None:
        runs.append((length, used[length], n, first, offset))
        used[length] += n

    large = sorted(k for k in left if 3 * k > capacity)
    while large:
        a = large[-1]
        at = bisect.bisect_right(large, capacity - a) - 1
        b = large[at] if at >= 0 else None
        if b == a and left[a] == 1:
            b = large[at - 1] if at else None
        n = left[a] if b is None else left[a] // 2 if b == a else min(left[a], left[b])
        put(a, n, bins, 0)
        left[a] -= n
        if b is not None:
            put(b, n, bins, a)
            left[b] -= n
        gaps[capacity - a - (b or 0)].append((bins, n))
        bins += n
        large = [k for k in large if left[k]]
    rooms = sorted(g for g in gaps if g)
    for length in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                per = capacity // length
                n = -(-left[length] // per)  # new sequences filled with this length alone
                gaps[capacity].append((bins, n))
                bisect.insort(rooms, capacity)
                bins += n
                continue
            room = rooms[at]
            first, n = gaps[room].pop()
            if n > left[length]:
                gaps[room].append((first + left[length], n - left[length]))
                n = left[length]
            if not gaps[room]:
                rooms.pop(at)
            put(length, n, first, capacity - room)
            left[length] -= n
            if room > length:
                if not gaps[room - length]:
                    bisect.insort(rooms, room - length)
                gaps[room - length].append((first, n))
    return runs, bins


def pack(pieces: DataFrame, capacity: int = 2048, order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ``pieces`` (needs ``length`` in 1..capacity)."""
    pieces = materialize(pieces.withColumn("__part", F.spark_partition_id()), "pieces")  # numbered once, read twice
    counts = pieces.groupBy("__part", "length").agg(F.count(F.lit(1)).alias("__n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    if any(not 0 < k <= capacity for k in histogram):
        raise ValueError(f"piece lengths must lie in 1..{capacity}")
    runs, _ = packing_plan(histogram, capacity)
    runs.sort()
    plan = np.array(runs, np.int64).reshape(-1, 5)
    before = F.sum("__n").over(Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__part", "length", F.coalesce(before, F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy("__part", "length").orderBy(*order)) - 1
    ranked = (pieces.withColumn("__within", within).join(offsets, ["__part", "length"])
              .withColumn("__rank", F.col("__before") + F.col("__within")).drop("__part", "__within", "__before"))
    base = len(plan) and int(plan[:, 1].max() + plan[:, 2].max()) + 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = plan[:, 0] * base + plan[:, 1]
        for b in batches:
            rank = b.column("__rank").to_numpy(zero_copy_only=False).astype(np.int64)
            run = np.searchsorted(keys, b.column("length").to_numpy(zero_copy_only=False) * base + rank, side="right") - 1
            cols = [b.column(c) for c in b.schema.names if c != "__rank"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(plan[run, 3] + rank - plan[run, 1]), pa.array(plan[run, 4])],
                                             names=[*(c for c in b.schema.names if c != "__rank"), "sequence_id", "offset"])

    out = ranked.drop("__rank").schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, out)


def pack_documents(docs: DataFrame, vocab_path: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs(doc_id, text)``: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    packed = pack(tokenize_pieces(docs, vocab_path, capacity, end_id, keep_ids), capacity)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * keep_ids)
