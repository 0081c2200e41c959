"""Whole-batch text handling shared by the operators: byte slices, whitespace-led chunks, ragged helpers.

A *chunk* is a run of white space followed by a run of other characters.  Texts are cut before an ASCII
white-space byte that follows a character which is surely not white space, so no pre-token of the tokenizers
used here crosses a cut, and work can be done once per distinct chunk instead of once per occurrence.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_ROWS = 4000
BATCH_BYTES = 16 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """Have the session send texts to Python in batches of at most ``BATCH_ROWS`` rows and about ``BATCH_BYTES``: they count in JVM and worker alike.

    The settings are read when the job runs, so they stay; smaller ones of the caller's are kept.
    """
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        given = conf.get(key, None) or ""
        if not (given.isdigit() and 0 < int(given) <= most):
            conf.set(key, str(most))
    return df


def text_rows(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Only the named columns under fixed names (``id``, ``text``, …); a null text becomes the empty text."""
    return small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more)


def text_slices(batches: Iterator[pa.RecordBatch], max_bytes: int = 8 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows of about ``max_bytes`` of text (a longer text comes alone, whole)."""
    for b in batches:
        if not b.num_rows:
            continue
        off = text_offsets(b.column(column))
        start = 0
        while start < b.num_rows:
            end = int(np.searchsorted(off, off[start] + max_bytes, side="right")) - 1
            end = min(max(end, start + 1), b.num_rows)
            yield b.slice(start, end - start)
            start = end
    give_back()


def segments(text: pa.Array, max_bytes: int) -> Iterator[tuple[pa.Array, int]]:
    """(rows, first byte) of ``text`` as it is, or of one long row cut between chunks into rows of about ``max_bytes``, one at a time."""
    b, off = text_bytes(text)
    if len(text) != 1 or len(b) <= max_bytes:
        yield text, 0
        return
    cuts = np.append(chunk_cuts(b, off), len(b))
    start = 0
    while start < len(b):
        k = int(np.searchsorted(cuts, start + max_bytes, side="right")) - 1
        end = int(cuts[k]) if cuts[k] > start else int(cuts[k + 1])
        yield pa.Array.from_buffers(pa.large_string(), 1, [None, pa.py_buffer(np.array([start, end])), pa.py_buffer(b)]), start
        start = end


def give_back() -> None:
    """Return freed memory to the system at the end of a task: workers stay, and several share an executor's allowance."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def text_offsets(arr: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else np.int32
    return np.frombuffer(arr.buffers()[1], kind)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all rows, row offsets from 0) without copying the text."""
    off = text_offsets(arr)
    data = arr.buffers()[2]
    b = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return b, off - off[0]


def byte_kinds() -> np.ndarray:
    """1 ASCII letter, 2 ASCII punctuation but the apostrophe, 0 other bytes."""
    kind = np.zeros(256, np.uint8)
    kind[[x for x in range(128) if chr(x).isalpha()]] = 1
    kind[[x for x in range(33, 127) if not chr(x).isalnum() and chr(x) != "'"]] = 2
    return kind


KIND = byte_kinds()
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[[9, 10, 13]] = 32


def word_borders(b: np.ndarray) -> np.ndarray:
    """Positions between an (ASCII or Latin-1) letter and ASCII punctuation other than the apostrophe, either way round.

    Pre-token patterns that keep runs of letters and runs of punctuation apart split there whatever stands around,
    except inside a special token's own string.
    """
    kind = KIND[b]
    lead = np.flatnonzero(b[:-1] == 0xC3)
    lead = lead[(b[lead + 1] != 0x97) & (b[lead + 1] != 0xB7)]  # U+00C0..U+00FF but the signs for times and division
    kind[lead] = kind[lead + 1] = 1
    return np.flatnonzero((kind[1:] + kind[:-1] == 3)) + 1


def chunk_cuts(b: np.ndarray, off: np.ndarray, max_len: int | None = None, words: bool = False) -> np.ndarray:
    """Start positions of chunks (every row start included), ascending.

    ``max_len``: longer chunks are cut further, between characters.  ``words``: also cut at ``word_borders``.
    """
    if not len(b):
        return np.zeros(0, np.int64)
    ws = (b == 32) | (b == 10) | (b == 13) | (b == 9)
    at = np.flatnonzero(ws[1:]) + 1
    prev = b[at - 1]
    ok = (prev > 32) & (prev != 127)
    # white space outside ASCII ends in a byte above 0x7F: C2 85, C2 A0, E1 9A 80, E2 80/81 xx, E3 80 80
    wide = np.flatnonzero(prev >= 128)
    two, three = b[np.maximum(at[wide] - 2, 0)], b[np.maximum(at[wide] - 3, 0)]
    ok[wide] &= ~((two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3)))
    cut = np.zeros(len(b), bool)
    cut[off[:-1][off[1:] > off[:-1]]] = True
    cut[at[ok]] = True
    if words:
        cut[word_borders(b)] = True
    cuts = np.flatnonzero(cut)
    if max_len:
        length = np.diff(np.append(cuts, len(b)))
        more = [np.arange(cuts[i] + max_len, cuts[i] + length[i], max_len) for i in np.flatnonzero(length > max_len)]
        if more:
            extra = np.concatenate(more)
            for _ in range(3):  # forward to the start of a character
                extra += (b[np.minimum(extra, len(b) - 1)] & 0xC0) == 0x80
            cut[extra[extra < len(b)]] = True
            cuts = np.flatnonzero(cut)
    return cuts


def distinct_chunks(arr: pa.Array, max_len: int | None = None, words: bool = False, fold: bool = False):
    """-> (distinct chunks as an Arrow string array, code of each chunk, start byte of each chunk, row pointer into chunks).

    ``fold``: ASCII capitals become small letters and ASCII white space the blank, for vocabularies that do so themselves.
    """
    b, off = text_bytes(arr)
    if fold:
        b = FOLD[b]
    cuts = chunk_cuts(b, off, max_len, words)
    ptr = np.searchsorted(cuts, off)
    ends = np.append(cuts, len(b)).astype(np.int64)
    chunks = pa.Array.from_buffers(pa.large_string(), len(cuts), [None, pa.py_buffer(ends), pa.py_buffer(b)])
    d = chunks.dictionary_encode()
    return d.dictionary, d.indices.to_numpy(zero_copy_only=False), cuts, ptr


def ragged_take(ptr: np.ndarray, values: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the ragged rows ``pick`` of (ptr, values); returns (values, new ptr)."""
    n = (ptr[1:] - ptr[:-1])[pick]
    out = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(ptr[:-1][pick] - out[:-1], n) + np.arange(out[-1])
    return values[at], out


def sums_by_row(x: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
    return c[ptr[1:]] - c[ptr[:-1]]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser over uint64 (wraps)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
