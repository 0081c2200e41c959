"""Operator 13: alignment of two tokenizers' tokens by pointer jumping.

A text with a blank in front is cut by a byte-level BPE vocabulary (A) and by a piece vocabulary with byte fallback (B).  Every
token points to its farthest-right overlapping token of the other cut, or to itself where none reaches farther; where an A and
a B token end together, A points to B.  Replacing all pointers by their pointers' pointers doubles the reach of each, so a few
rounds over flat arrays lead every token to the last token of its component: the label of its group.

No token of either vocabulary crosses a cut before a blank that follows a character which is surely no white space, and both
end there, so groups and links lie inside such chunks.  A batch's distinct chunks are encoded and aligned once, all in
the same arrays; documents are sums over their chunks.

Corpus-wide counts of id pairs never meet the documents one by one: a slice of documents keeps a list of its distinct
pairs, in how many of its documents each occurs, and per document the numbers and uses of its pairs in that list.  The lists are added
up by pair (a pair comes once per slice, so none is hot), joined back to the slices, and a slice's documents look their pairs up in it.

Texts that are null, empty or whose joined tokens are not the text's bytes (a literal U+2581, say) have no tokens: zeros and an empty
group string.  A text longer than a slice is worked on in segments, cut between chunks.  Rows are documents: repeated rows count
as often as they occur, a null id stays.  An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .textarrays import distinct_chunks, give_back, ragged_take, sums_by_row, text_bytes, text_rows, text_slices
from .token_counts import byte_alphabet

SLICE = 4 << 20  # bytes of text worked on at once
MARK = "▁"


class Vocabularies:
    """Both libraries, the bytes of every id and its digits with a sign before them, as (ptr, bytes).

    Many chunks go through one call of A, joined by a special token whose id marks the borders; chunks that hold that
    token's string themselves go alone through a second instance, for which such strings are plain text.
    """

    JOINED = 256

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs one task per core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.plain = Tokenizer.from_file(a_path), Tokenizer.from_file(a_path)
        self.plain.encode_special_tokens = True
        added = [(i, t) for i, t in self.a.get_added_tokens_decoder().items()]
        self.special = [t.content for _, t in added]
        self.border, self.mark = next(((i, t.content) for i, t in added if t.special and not (t.lstrip or t.rstrip or t.single_word)), (None, None))
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {c: i for i, c in enumerate(byte_alphabet())}
        vocab = json.load(open(a_path, encoding="utf-8"))["model"]["vocab"]
        raw = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            raw[i] = bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()
        self.a_bytes = self.flat(raw)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = self.flat([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)])
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError(f"{b_path}: pieces that hold a blank after other characters cross chunks")
        self.digits = self.flat([b";%d" % i for i in range(max(len(raw), len(pieces)))])

    @staticmethod
    def flat(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([[0], np.cumsum([len(x) for x in raw])]), np.frombuffer(b"".join(raw), np.uint8)

    def encode(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ptr, ids) under A and (ptr, ids) under B of distinct chunks that begin with a blank (B puts it in front itself)."""
        texts = chunks.to_pylist()
        b = self.b.encode([c[1:] for c in texts], num_threads=1)
        if " " in texts:  # nothing is put in front of nothing
            b[texts.index(" ")] = [self.b.piece_to_id(MARK)]
        # A's pre-tokens keep letters and punctuation apart, so that chunks share their words
        words, codes, _, ptr = distinct_chunks(chunks, words=True)
        a_ptr, a = self.encode_a(words)
        a, per = ragged_take(a_ptr, a, codes)
        return per[ptr], a, *self.ragged(b)

    def encode_a(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        chunks = words.to_pylist()
        odd = range(len(chunks)) if self.mark is None else np.flatnonzero(
            np.logical_or.reduce([pc.match_substring(words, s).to_numpy(zero_copy_only=False) for s in self.special])).tolist()
        alone = [e.ids for e in self.plain.encode_batch_fast([chunks[i] for i in odd], add_special_tokens=False)]
        if len(odd) == len(chunks):
            return self.ragged(alone)
        held = list(chunks)
        for i in odd:
            held[i] = ""  # only its border comes back
        joined = [self.mark.join([*held[i:i + self.JOINED], ""]) for i in range(0, len(held), self.JOINED)]
        flat = np.concatenate([np.array(e.ids, np.int64) for e in self.a.encode_batch_fast(joined, add_special_tokens=False)])
        ends = np.flatnonzero(flat == self.border)
        size, ids = np.diff(ends, prepend=-1) - 1, flat[flat != self.border]
        if odd:
            at = np.cumsum(size)[odd]
            size[odd] = list(map(len, alone))
            ids = np.insert(ids, np.repeat(at, size[odd]), list(itertools.chain.from_iterable(alone)))
        return np.concatenate([[0], np.cumsum(size)]), ids

    @staticmethod
    def ragged(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        ptr = np.concatenate([[0], np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)))])
        return ptr, np.fromiter(itertools.chain.from_iterable(rows), np.int64, int(ptr[-1]))


@functools.lru_cache(maxsize=2)
def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(a_path, b_path)


def blank_cuts(b: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Places of row starts and of blanks that follow a character which is surely no white space, ascending."""
    at = np.flatnonzero(b[1:] == 32) + 1
    prev = b[at - 1]
    ok = (prev > 32) & (prev != 127)
    wide = np.flatnonzero(prev >= 128)  # white space outside ASCII: C2 85, C2 A0, E1 9A 80, E2 80/81 xx, E3 80 80
    two, three = b[np.maximum(at[wide] - 2, 0)], b[np.maximum(at[wide] - 3, 0)]
    ok[wide] &= ~((two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3)))
    cut = np.zeros(len(b), bool)
    cut[off[:-1][off[1:] > off[:-1]]] = True
    cut[at[ok]] = True
    return np.flatnonzero(cut)


def terminals(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> np.ndarray:
    """For every token (A's, then B's) the last token of its component, always one of B's.

    Starts and ends are ascending byte places; both cuts cover the same bytes.
    """
    n = len(end_a)
    last_b = np.searchsorted(start_b, end_a) - 1  # the token that holds an A token's last byte
    last_a = np.searchsorted(start_a, end_b) - 1
    to = np.concatenate([np.where(end_b[last_b] >= end_a, n + last_b, np.arange(n)),
                         np.where(end_a[last_a] > end_b, last_a, n + np.arange(len(end_b)))])
    while True:
        further = to[to]
        if (further == to).all():
            return to
        to = further


class Aligned:
    """Distinct chunks, aligned: counts, links and group strings by chunk."""

    def __init__(self, vocab: Vocabularies, chunks: pa.Array):
        """``chunks`` begin with a blank each."""
        raw, off = text_bytes(chunks)
        a_ptr, a, b_ptr, b = vocab.encode(chunks)
        a, a_ptr, bad_a = self.checked(vocab.a_bytes, a_ptr, a, raw, off)
        b, b_ptr, bad_b = self.checked(vocab.b_bytes, b_ptr, b, raw, off)
        self.bad = bad_a | bad_b
        # chunks that cannot be aligned have no tokens here
        good = np.flatnonzero(~self.bad)
        (a, a_at), (b, b_at) = ragged_take(a_ptr, a, good), ragged_take(b_ptr, b, good)
        size_a, size_b = np.diff(vocab.a_bytes[0])[a], np.diff(vocab.b_bytes[0])[b]
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        start_a, start_b = end_a - size_a, end_b - size_b
        n = np.zeros((2, len(chunks)), np.int64)
        n[0, good], n[1, good] = np.diff(a_at), np.diff(b_at)
        self.n_a, self.n_b = n
        label = terminals(start_a, end_a, start_b, end_b) - len(a)
        of_a, of_b = label[:len(a)], label[len(a):]  # ascending: the group's last B token
        is_last = of_b == np.arange(len(b))
        self.n_groups = np.zeros(len(chunks), np.int64)
        self.n_groups[good] = sums_by_row(is_last, b_at)
        # links: each A token with the B tokens from the one that holds its first byte to the one that holds its last
        first, last = np.searchsorted(end_b, start_a, side="right"), np.searchsorted(start_b, end_a)
        width = last - first
        ptr = np.concatenate([[0], np.cumsum(width)])
        hit = np.arange(ptr[-1]) - np.repeat(ptr[:-1] - first, width)
        self.keys = np.repeat(a, width) << 32 | b[hit]
        self.link_ptr = np.zeros(len(chunks) + 1, np.int64)
        self.link_ptr[good + 1] = np.diff(ptr[a_at])
        self.link_ptr = np.cumsum(self.link_ptr)
        # keys of links as numbers in the list of distinct ones
        self.distinct, self.link_code = np.unique(self.keys, return_inverse=True)
        # group strings, each token's digits with the sign before them: a group's A tokens, then its B tokens
        ends = np.flatnonzero(is_last)
        a_end, b_end = np.searchsorted(of_a, ends, side="right"), ends + 1
        b_first = np.concatenate([[0], b_end[:-1]])
        group_a, group_b = np.searchsorted(ends, of_a), np.searchsorted(ends, of_b)
        ids, sign = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[np.arange(len(a)) + b_first[group_a]] = a
        ids[np.arange(len(b)) + a_end[group_b]] = b
        sign[np.concatenate([[0], a_end[:-1]])[:len(ends)] + b_first] = ord(";")
        sign[a_end + b_first] = ord("|")
        text, at = ragged_take(*vocab.digits, ids)
        text[at[:-1]] = sign
        tokens = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])
        text, at = text.tobytes(), at[tokens].tolist()
        self.text = [text[i:j] for i, j in zip(at[:-1], at[1:])]  # of each chunk, led by a semicolon

    @staticmethod
    def checked(table: tuple[np.ndarray, np.ndarray], ptr: np.ndarray, ids: np.ndarray, raw: np.ndarray, off: np.ndarray):
        """(ids, ptr, which chunks' joined token bytes are not the chunk's)."""
        out, per = ragged_take(table[0], table[1], ids)
        at = per[ptr]
        bad = np.diff(at) != np.diff(off)
        if not bad.any():
            same = out == raw
        else:
            good = np.flatnonzero(~bad)
            same = np.ones(len(raw), bool)
            places = ragged_take(off, np.arange(len(raw)), good)[0]
            same[places] = ragged_take(at, out, good)[0] == raw[places]
        return ids, ptr, bad | (sums_by_row(~same, off) > 0)


def segments(b: np.ndarray, cuts: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Byte ranges of about ``size`` between cuts."""
    out, start = [], 0
    while start < len(b):
        k = int(np.searchsorted(cuts, start + size, side="right")) - 1
        end = int(cuts[k]) if cuts[k] > start else int(cuts[k + 1]) if k + 1 < len(cuts) else len(b)
        end = len(b) if len(b) - start <= size else end
        out.append((start, end))
        start = end
    return out


class Documents:
    """Sums over the chunks of some documents, which may be added segment by segment."""

    def __init__(self, n: int):
        self.sums = np.zeros((4, n), np.int64)
        self.hash = [hashlib.sha256() for _ in range(n)]
        self.bad = np.zeros(n, bool)
        self.pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # (document, key, uses), distinct within a part
        self.n = n

    def add(self, vocab: Vocabularies, b: np.ndarray, off: np.ndarray) -> None:
        """The next bytes of each document; every non-empty one begins with a blank."""
        if not len(b):
            return
        cuts = blank_cuts(b, off)
        ptr = np.searchsorted(cuts, off)
        chunks = pa.Array.from_buffers(pa.large_string(), len(cuts), [None, pa.py_buffer(np.append(cuts, len(b)).astype(np.int64)), pa.py_buffer(b)])
        d = chunks.dictionary_encode()
        codes = d.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lat = Aligned(vocab, d.dictionary)
        self.bad |= sums_by_row(lat.bad[codes], ptr) > 0
        n_links = np.diff(lat.link_ptr)
        self.sums += np.array([sums_by_row(x[codes], ptr) for x in (lat.n_a, lat.n_b, lat.n_groups, n_links)])
        places = codes.tolist()
        for i in np.flatnonzero((np.diff(ptr) > 0) & ~self.bad).tolist():
            text = b"".join([lat.text[k] for k in places[ptr[i]:ptr[i + 1]]])
            self.hash[i].update(text if self.pairs else text[1:])
        # chunks of each document with their uses, then their links
        doc = np.repeat(np.arange(self.n), np.diff(ptr))
        keep = ~self.bad[doc]
        both, uses = np.unique(doc[keep] * len(lat.bad) + codes[keep], return_counts=True)
        doc, code = both // len(lat.bad), both % len(lat.bad)
        link, per = ragged_take(lat.link_ptr, lat.link_code, code)
        self.collect(np.repeat(doc, np.diff(per)), link, np.repeat(uses, np.diff(per)), lat.distinct)

    def collect(self, doc: np.ndarray, link: np.ndarray, uses: np.ndarray, distinct: np.ndarray) -> None:
        """Add up the uses of each (document, key); ``link`` numbers the keys in ``distinct``."""
        both = doc * max(len(distinct), 1) + link
        order = np.argsort(both)
        both, uses = both[order], uses[order]
        first = np.flatnonzero(np.diff(both, prepend=-1))
        both, uses = both[first], np.add.reduceat(uses, first) if len(first) else uses[:0]
        self.pairs.append((both // max(len(distinct), 1), distinct[both % max(len(distinct), 1)], uses))

    def finished(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, key, uses), distinct, by document; without those of documents that cannot be aligned."""
        parts = [np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*self.pairs)] or [np.zeros(0, np.int64)] * 3
        if len(self.pairs) > 1:
            doc, keys, uses = parts
            distinct, link = np.unique(keys, return_inverse=True)
            self.pairs = []
            self.collect(doc, link, uses, distinct)
            parts = self.pairs[0]
        doc, keys, uses = parts
        ok = ~self.bad[doc]
        self.sums[:, self.bad] = 0
        return doc[ok], keys[ok], uses[ok]


def led_by_blanks(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) with a blank before each text that is not empty."""
    led = pc.if_else(pc.equal(text, ""), "", pc.binary_join_element_wise("", text, " "))
    return text_bytes(led)


SCHEMA = ("slice long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "codes array<int>, uses array<int>, a array<int>, b array<int>, n array<int>")


def alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str, size: int = SLICE) -> DataFrame:
    """Rows of two kinds, written once: a document with its figures and pairs; a slice with its list of distinct pairs (``a`` not null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabularies(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        ints, lists = pa.int64(), pa.list_(pa.int32())
        types = [ints] * 6 + [pa.string()] + [lists] * 5
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for part in text_slices(batches, size):
            raw, off = led_by_blanks(part.column("text"))
            docs_ = Documents(part.num_rows)
            if part.num_rows == 1 and len(raw) > size:
                for lo, hi in segments(raw, blank_cuts(raw, off), size):
                    docs_.add(vocab, raw[lo:hi], np.array([0, hi - lo]))
            else:
                docs_.add(vocab, raw, off)
            doc, keys, uses = docs_.finished()
            distinct, codes, n = np.unique(keys, return_inverse=True, return_counts=True)
            ptr = np.searchsorted(doc, np.arange(part.num_rows + 1))
            shas = [h.hexdigest() if n_a else "" for h, n_a in zip(docs_.hash, docs_.sums[0].tolist(), strict=True)]
            per_doc = [pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(x, pa.int32())) for x in (codes, uses)]
            rows = part.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(np.full(rows, number)), part.column("id"), *(pa.array(x) for x in docs_.sums),
                                              pa.array(shas, pa.string()), *per_doc, *[pa.nulls(rows, lists)] * 3], names=names)
            if len(distinct):
                pairs = [pa.array([x.tolist()], lists) for x in (distinct >> 32, distinct & 0xFFFFFFFF, n)]
                yield pa.RecordBatch.from_arrays([pa.array([number], ints), *(pa.nulls(1, t) for t in types[1:9]), *pairs], names=names)
            number += 1
        give_back()

    return materialize(text_rows(docs, id_col, text_col).mapInArrow(run, SCHEMA), "alignments")


def pair_counts(found: DataFrame) -> DataFrame:
    """``a, b, count, best``: documents that hold the pair linked, and whether no pair of its A id has more."""
    pairs = listed(found).groupBy("a", "b").agg(F.sum("n").cast("long").alias("count"))
    most = pairs.groupBy("a").agg(F.max("count").alias("most"))
    return pairs.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def listed(found: DataFrame) -> DataFrame:
    return (found.where(F.col("a").isNotNull()).select("slice", F.posexplode(F.arrays_zip("a", "b", "n")).alias("code", "p"))
            .select("slice", "code", "p.a", "p.b", "p.n"))


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SLICE) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row."""
    found = alignments(docs, a_path, b_path, id_col, text_col, size)
    looked_up = listed(found).join(pair_counts(found), ["a", "b"]).select("slice", "code", "count", "best")
    rows = (found.where(F.col("a").isNull()).drop("a", "b", "n").unionByName(looked_up, allowMissingColumns=True)
            .repartition("slice").sortWithinPartitions("slice", F.col("code").asc_nulls_last()))
    schema = f"{id_col} long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    same = ("n_a", "n_b", "n_groups", "n_links")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_, parts, count, best = None, [], None, None
        for b in batches:
            number, code = b.column("slice").to_numpy(), b.column("code")
            is_doc = code.is_null().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.diff(number, prepend=number[:1] - 1, append=number[-1:] + 1)) if b.num_rows else np.zeros(1, int)
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if number[lo] != slice_:
                    slice_, parts, count = int(number[lo]), [], None
                n_pairs = int((~is_doc[lo:hi]).sum())
                if n_pairs:
                    at = b.slice(lo, n_pairs)
                    parts.append((at.column("count").to_numpy(), at.column("best").to_numpy(zero_copy_only=False)))
                if n_pairs == hi - lo:
                    continue
                if count is None:  # the slice's list is complete, its documents follow
                    count = np.concatenate([np.zeros(0, np.int64), *(x for x, _ in parts)])
                    best = np.concatenate([np.zeros(0, bool), *(x for _, x in parts)])
                docs_ = b.slice(lo + n_pairs, hi - lo - n_pairs)
                ptr, codes = ragged_list(docs_.column("codes"))
                uses = ragged_list(docs_.column("uses"))[1]
                n_best, total = sums_by_row(best[codes] * uses, ptr), sums_by_row(count[codes] * uses, ptr)
                yield pa.RecordBatch.from_arrays([docs_.column("doc_id"), *(docs_.column(c) for c in same), pa.array(n_best), pa.array(total),
                                                  docs_.column("groups_sha256")],
                                                 names=[id_col, *same, "n_best", "count_sum", "groups_sha256"])

    return rows.mapInArrow(run, schema)


def ragged_list(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    ptr = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    return ptr - ptr[0], col.values.to_numpy(zero_copy_only=False).astype(np.int64)[ptr[0]:ptr[-1]]
