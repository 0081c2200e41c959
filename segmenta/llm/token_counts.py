"""Operator 10: token counts by rank-synchronous array merging.

Distinct pre-tokens of a batch are held as one ragged numpy array of symbols.  In every step each sequence finds
its lowest-rank adjacent pair and all its (non-overlapping, leftmost first) occurrences are merged at once, for all
sequences together; what is left when no pair has a rank are the tokens.  A long pre-token (``LONG`` symbols and more) keeps the ranks of its
pairs between steps, filed by rank, and looks up only the pairs beside its merges: a step costs what it merges, so a
megabyte of unbroken letters takes seconds.  Counts go back to the documents through the chunk codes.  One narrow pass over the
texts, no shuffle.

Null text counts as the empty text (0 tokens); repeated rows give repeated results; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .textarrays import distinct_chunks, sums_by_row, text_bytes, text_rows, text_slices

NO_RANK = np.int64(1 << 40)
LONG = 256  # symbols from which a pre-token is merged by itself
MEMO_ENTRIES = 600_000  # distinct chunks a worker remembers between batches, about 100 MB


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or the next from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(x) if x in shown else chr(next(rest)) for x in range(256)]


class MergeTable:
    """Ranks of a byte-level BPE vocabulary file: symbols of single bytes, and (left, right) -> (rank, merged)."""

    def __init__(self, path: str, pattern: str):
        spec = json.load(open(path, encoding="utf-8"))
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.byte_symbol = np.array([vocab[c] for c in byte_alphabet()], np.int64)
        self.size = max(vocab.values()) + 1
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.rank = key[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)  # by rank
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.pattern = regex.compile(pattern)
        self.memo: dict[str, int] = {}

    def may_hold_special(self, text: pa.Array) -> bool:
        return any(pc.any(pc.match_substring(text, s)).as_py() for s in self.special)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NO_RANK)

    def pretokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of one chunk and how many special tokens it holds."""
        if self.split is None or not self.split.search(text):
            return self.pattern.findall(text), 0
        parts = self.split.split(text)
        return [t for p in parts for t in self.pattern.findall(p)], len(parts) - 1

    def surviving(self, symbols: np.ndarray, seq: np.ndarray, n: int) -> np.ndarray:
        """Symbols left in each of ``n`` sequences; ``seq`` (ascending) is the sequence of each symbol."""
        counts = np.bincount(seq, minlength=n)
        while len(symbols) > 1:
            rank = np.full(len(symbols), NO_RANK)
            same = seq[1:] == seq[:-1]
            rank[:-1][same] = self.ranks(symbols[:-1][same], symbols[1:][same])
            first = np.flatnonzero(np.concatenate([[True], ~same]))
            low = np.minimum.reduceat(rank, first)
            length = np.diff(np.append(first, len(seq)))
            live = np.repeat(low < NO_RANK, length)
            if not live.any():
                break
            symbols, seq, rank, low = symbols[live], seq[live], rank[live], np.repeat(low, length)[live]
            hit = rank == low
            # runs of hits overlap only for pairs of one symbol: take every second from the run's start
            start = hit & ~np.concatenate([[False], hit[:-1]])
            at = np.arange(len(hit))
            begin = np.maximum.accumulate(np.where(start, at, 0))
            hit &= (at - begin) % 2 == 0
            symbols = np.where(hit, self.merged[np.where(hit, rank, 0)], symbols)
            keep = ~np.concatenate([[False], hit[:-1]])
            counts -= np.bincount(seq[~keep], minlength=n)
            symbols, seq = symbols[keep], seq[keep]
        return counts

    def surviving_long(self, symbols: np.ndarray) -> int:
        """Symbols left in one sequence: its lowest-rank pair is merged everywhere at once, until no pair has a rank."""
        n = len(symbols)
        symbols, left = symbols.copy(), n
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)  # n: no symbol
        rank = np.full(n + 1, NO_RANK)
        rank[:n - 1] = self.ranks(symbols[:-1], symbols[1:])
        filed: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def file(at: np.ndarray) -> None:
            at = at[rank[at] < NO_RANK]
            at = at[np.argsort(rank[at], kind="stable")]
            cuts = np.flatnonzero(np.diff(rank[at])) + 1
            for part in np.split(at, cuts) if len(at) else ():
                r = int(rank[part[0]])
                if r not in filed:
                    filed[r] = []
                    heapq.heappush(heap, r)
                filed[r].append(part)

        file(np.arange(n - 1))
        while heap:
            r = heapq.heappop(heap)
            at = np.unique(np.concatenate(filed.pop(r)))
            at = at[rank[at] == r]  # pairs that have changed since they were filed do not count
            if not len(at):
                continue
            # pairs of one symbol overlap in runs: every second from the run's start
            place = np.arange(len(at))
            begins = np.concatenate([[True], after[at[:-1]] != at[1:]])
            at = at[(place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0]
            gone = after[at]
            symbols[at] = self.merged[r]
            rank[gone] = NO_RANK
            left -= len(at)
            after[at] = after[gone]
            inner = after[at] < n
            before[after[at][inner]] = at[inner]
            has_left = before[at] >= 0
            near = np.unique(np.concatenate([at, before[at][has_left]]))
            near = near[after[near] < n]
            rank[at] = NO_RANK
            rank[near] = self.ranks(symbols[near], symbols[after[near]])
            file(near)
        return left

    def counts(self, chunks: list[str]) -> np.ndarray:
        """Tokens of each of the distinct ``chunks``; those of earlier batches are remembered, within a bound."""
        if len(self.memo) + len(chunks) > MEMO_ENTRIES:
            self.memo.clear()
        known = [self.memo.get(c, -1) for c in chunks]
        new = [c for c, n in zip(chunks, known, strict=True) if n < 0]
        counted = self.merged_counts(new)
        out = np.array(known, np.int64)
        out[out < 0] = counted
        self.memo.update(zip(new, counted.tolist(), strict=True))
        return out

    def merged_counts(self, chunks: list[str]) -> np.ndarray:
        number: dict[str, int] = {}
        owner, which, special = [], [], np.zeros(len(chunks), np.int64)
        for i, c in enumerate(chunks):
            toks, special[i] = self.pretokens(c)
            for t in toks:
                owner.append(i)
                which.append(number.setdefault(t, len(number)))
        if not number:
            return special
        raw = [t.encode() for t in number]
        long = [i for i, x in enumerate(raw) if len(x) >= LONG]
        done = [self.surviving_long(self.byte_symbol[np.frombuffer(raw[i], np.uint8)]) for i in long]
        for i in long:
            raw[i] = b""
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self.byte_symbol[np.frombuffer(b"".join(raw), np.uint8)]
        per = self.surviving(symbols, np.repeat(np.arange(len(raw)), length), len(raw))
        per[long] = done
        return special + np.bincount(owner, weights=per[which], minlength=len(chunks)).astype(np.int64)


@functools.lru_cache(maxsize=4)
def merge_table(path: str, pattern: str) -> MergeTable:
    return MergeTable(path, pattern)


def count_tokens(docs: DataFrame, vocab_path: str, pattern: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merge_table(vocab_path, pattern)
        for b in text_slices(batches):
            text = b.column("text")
            chunks, codes, _, ptr = distinct_chunks(text, words=not table.may_hold_special(text))
            per = table.counts(chunks.to_pylist())
            n = sums_by_row(per[codes], ptr) if len(codes) else np.zeros(b.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(np.diff(text_bytes(text)[1])), pa.array(n), pa.array(n > limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return text_rows(docs, id_col, text_col).mapInArrow(run, f"{id_col} long, n_bytes long, n_tokens long, over_limit boolean")
