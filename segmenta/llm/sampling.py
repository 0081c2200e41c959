"""Operator 4: sampled SentencePiece segmentations and lossless decoding.

A segmentation of a text is drawn from the piece lattice with probability proportional to the product of
``exp(alpha * score)`` of its pieces: forward sums filter, then pieces are drawn backward from the end of every chunk.
The random numbers are a hash of the seed, the row key and the byte position, so a row gets the same segmentation in
any batch, partition or retry.  A character that is no piece is spelled in the vocabulary's byte pieces, and so is a
literal mark, so decoding gives back the exact bytes.  Forward sums are made once per distinct chunk of a batch; chunks of any
length are drawn whole.

No blank is added in front and nothing is normalised.  Null text is the empty text (no ids); rows that repeat with one
key get one segmentation; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .lattice import MARK, Lattice, Pieces, pieces
from .textarrays import distinct_chunks, mix, ragged_take, segments, text_bytes, text_rows, text_slices

SLICE = 3 << 20  # bytes of text worked on at once: the arrays made from them take about 60 times as much


def row_hash(seed: int, keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(keys.astype(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))


def uniform(row: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Hash of (row hash, position) as a double in [0, 1)."""
    with np.errstate(over="ignore"):
        x = mix(row ^ (position.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)))
    return (x >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def sample_rows(vocab: Pieces, keys: np.ndarray, text: pa.Array, alpha: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(ptr, ids) of one sampled segmentation per row; a text longer than ``SLICE`` is drawn in runs of chunks.

    ``alpha`` times the vocabulary's size is at most 75: products of a few pieces' weights have to stay above a double's least.
    """
    if alpha * vocab.size > 75:
        raise ValueError(f"alpha may be at most {75 / vocab.size:.2g} for this vocabulary")
    parts = [sample_part(vocab, keys, part, alpha, seed, first) for part, first in segments(text, SLICE)]
    if len(parts) == 1:
        return parts[0]
    ids = np.concatenate([x for _, x in parts])
    return np.array([0, len(ids)]), ids


def sample_part(vocab: Pieces, keys: np.ndarray, text: pa.Array, alpha: float, seed: int, first: int) -> tuple[np.ndarray, np.ndarray]:
    """(ptr, ids) of one sampled segmentation per row; rows begin at byte ``first`` of their texts."""
    chunks, codes, starts, rows = distinct_chunks(text)
    if not len(codes):
        return np.zeros(len(text) + 1, np.int64), np.zeros(0, np.int64)
    b, off = text_bytes(text)
    lat = Lattice(vocab, chunks, escape=True)
    weight = np.exp(alpha * np.append(vocab.score, -vocab.size))[lat.ids]
    forward, scale = lat.forward(weight)
    order = np.argsort(lat.dst, kind="stable")
    src, dst, ids = lat.src[order], lat.dst[order], lat.ids[order]
    share = forward[src] * weight[order] / forward[dst] * np.exp(scale[src] - scale[dst])
    into = np.concatenate([[0], np.cumsum(np.bincount(dst, minlength=lat.nodes))])  # edges into node v: into[v] .. into[v+1]
    row_of = np.repeat(np.arange(len(text)), np.diff(rows))
    row = row_hash(seed, keys)[row_of]
    place = first + starts - off[row_of]  # a chunk has no more characters than bytes, so its places are its own
    home = lat.first[codes]
    node = home + lat.length[codes]
    live = np.arange(len(codes))
    rounds = np.zeros(len(codes), np.int64)
    drawn = []
    while len(live):
        now, start = node[live], home[live]
        u = uniform(row[live], place[live] + (now - start))
        edge, last = into[now], into[now + 1] - 1
        u -= share[edge]
        more = np.flatnonzero((u >= 0) & (edge < last))
        while len(more):
            edge[more] += 1
            u[more] -= share[edge[more]]
            more = more[(u[more] >= 0) & (edge[more] < last[more])]
        drawn.append((live, edge))
        rounds[live] += 1
        now = src[edge]
        node[live] = now
        live = live[now != start]
    per_chunk = np.concatenate([[0], np.cumsum(rounds)])
    edge = np.empty(per_chunk[-1], np.int64)
    for k, (who, e) in enumerate(drawn):  # pieces were drawn from the end
        edge[per_chunk[who + 1] - 1 - k] = e
    piece = ids[edge]
    # spell out the characters that are no pieces
    spelled = np.flatnonzero(piece == vocab.size)
    char_at = np.zeros(lat.nodes, np.int64)
    char_at[lat.node_of_char] = lat.char
    size = np.ones(len(piece), np.int64)
    raw = [chr(c).encode("utf-8") for c in char_at[src[edge[spelled]]]]
    size[spelled] = [len(x) for x in raw]
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(at[-1], np.int64)
    out[at[:-1]] = piece
    if len(spelled):
        spell, ptr = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum(size[spelled])])
        out[np.repeat(at[spelled] - ptr[:-1], size[spelled]) + np.arange(ptr[-1])] = vocab.byte_id[spell]
    return at[per_chunk][rows], out


def piece_bytes(vocab: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(ptr, bytes) of what each id stands for in a text."""
    raw = [t.replace(MARK, " ").encode() for t in vocab.text]
    for byte, i in enumerate(vocab.byte_id):
        raw[i] = bytes([byte])
    return np.concatenate([[0], np.cumsum([len(x) for x in raw])]), np.frombuffer(b"".join(raw), np.uint8)


def decode_rows(vocab: Pieces, ptr: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ptr, bytes) of the texts of ragged id rows."""
    table, raw = piece_bytes(vocab)
    out, per = ragged_take(table, raw, ids)
    return per[ptr], out


def encode(docs: DataFrame, vocab_path: str, alpha: float = 2e-4, seed: int = 0, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: one sampled segmentation per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, SLICE):
            ptr, ids = sample_rows(pieces(vocab_path), b.column("id").to_numpy(zero_copy_only=False), b.column("text"), alpha, seed)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(ids, pa.int32()))],
                                             names=[id_col, "ids"])

    return text_rows(docs, id_col, text_col).mapInArrow(run, f"{id_col} long, ids array<int>")


def decode(encoded: DataFrame, vocab_path: str, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("ids")
            ptr = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
            ids = col.values.to_numpy(zero_copy_only=False).astype(np.int64)[ptr[0]:ptr[-1]]
            at, raw = decode_rows(pieces(vocab_path), ptr - ptr[0], ids)
            text = pa.Array.from_buffers(pa.large_string(), len(col), [None, pa.py_buffer(at), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([b.column(id_col), text.cast(pa.string())], names=[id_col, "text"])

    return encoded.select(id_col, "ids").mapInArrow(run, f"{id_col} long, text string")


def digest(docs: DataFrame, vocab_path: str, alpha: float = 2e-4, seed: int = 0, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per row: number and checksum of the sampled ids, and of the text decoded from them.

    ``doc_id, n_bytes, n_pieces, ids_crc32, decoded_sha256, lossless``; ids and decoded text stay within the batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = pieces(vocab_path)
        for b in text_slices(batches, SLICE):
            text = b.column("text")
            ptr, ids = sample_rows(vocab, b.column("id").to_numpy(zero_copy_only=False), text, alpha, seed)
            at, raw = decode_rows(vocab, ptr, ids)
            given, off = text_bytes(text)
            ids32, raw, given = ids.astype("<u4").tobytes(), raw.tobytes(), given.tobytes()
            rows = range(len(text))
            back = [raw[at[i]:at[i + 1]] for i in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(np.diff(off)), pa.array(np.diff(ptr)),
                 pa.array([zlib.crc32(ids32[4 * ptr[i]:4 * ptr[i + 1]]) for i in rows], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string()),
                 pa.array([back[i] == given[off[i]:off[i + 1]] for i in rows], pa.bool_())],
                names=[id_col, "n_bytes", "n_pieces", "ids_crc32", "decoded_sha256", "lossless"])

    return text_rows(docs, id_col, text_col).mapInArrow(
        run, f"{id_col} long, n_bytes long, n_pieces long, ids_crc32 long, decoded_sha256 string, lossless boolean")
