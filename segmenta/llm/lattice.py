"""The piece lattice of strings of any length over a fixed public vocabulary, as flat numpy arrays.

Every vocabulary piece that matches at a position is an edge; a character that is no piece by itself gets an edge of
its own (``fallback``), so a path always exists.  Sums over all segmentations are kept as a number and the logarithm of a
scale per node; every ``STEP`` characters a string's scale is set to its running total, so that no length leaves a double's
range.  A string's sums do not depend on the strings beside it.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

from .textarrays import mix

STEP = 8  # characters between two settings of a string's scale
MARK = "▁"  # stands for a blank in the vocabulary


class Pieces:
    """Vocabulary of a sentencepiece model and a hash table of (prefix state, character) -> state."""

    NOWHERE = 0x110000  # a code past Unicode: in no piece

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(self.size)]
        self.score = np.array([sp.get_score(i) for i in range(self.size)])
        self.byte_id = np.full(256, -1, np.int64)
        plain = []
        for i in range(self.size):
            if sp.is_byte(i):
                self.byte_id[int(self.text[i][3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                plain.append(i)
        states: dict[tuple[int, int], int] = {}
        piece_at = [-1]
        for i in plain:
            state = 0
            for c in self.text[i]:
                nxt = states.get((state, ord(c)))
                if nxt is None:
                    nxt = states[state, ord(c)] = len(piece_at)
                    piece_at.append(-1)
                state = nxt
            piece_at[state] = i
        self.plain = np.array(plain)
        self.score = np.maximum(self.score, -float(self.size))  # runs of blanks carry a placeholder far below all ranks
        self.piece_at = np.array(piece_at, np.int32)
        self.root = np.full(self.NOWHERE + 1, -1, np.int32)
        for (state, c), nxt in states.items():
            if not state:
                self.root[c] = nxt
        self.longest = max(len(self.text[i]) for i in plain)
        keys = np.array([s << 21 | c for s, c in states], np.uint64)
        self.bits = int(np.ceil(np.log2(len(keys) * 8)))
        self.slot_key = np.full(1 << self.bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.slot_state = np.full(1 << self.bits, -1, np.int32)
        for k, slot, v in zip(keys, self.slot(keys).tolist(), states.values(), strict=True):
            while self.slot_state[slot] >= 0:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            self.slot_key[slot], self.slot_state[slot] = k, v

    def slot(self, key: np.ndarray) -> np.ndarray:
        return (mix(key) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Next prefix states; -1 where none."""
        key = state.astype(np.uint64) << np.uint64(21) | char.astype(np.uint64)
        at = self.slot(key)
        out = np.where(self.slot_key[at] == key, self.slot_state[at], -1)
        open_ = np.flatnonzero((self.slot_key[at] != key) & (self.slot_state[at] >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            same = self.slot_key[at[open_]] == key[open_]
            out[open_[same]] = self.slot_state[at[open_[same]]]
            open_ = open_[~same & (self.slot_state[at[open_]] >= 0)]
        return out


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Lattice:
    """Edges of many strings; nodes are numbered through: string i owns ``first[i] .. first[i] + length[i]``."""

    def __init__(self, vocab: Pieces, strings: pa.Array, escape: bool):
        """``escape``: a literal mark in a string is not the blank's piece and falls back."""
        start_byte = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + len(strings) + 1]
        data = strings.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[start_byte[0]:start_byte[-1]] if data is not None else np.zeros(0, np.uint8)
        self.char = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.int32)
        is_lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80, dtype=np.int32)])
        cp = is_lead[start_byte - start_byte[0]]  # first character of each string
        self.length = np.diff(cp)
        n_chars = len(self.char)
        strings_at = np.arange(len(self.length), dtype=np.int32)
        owner = np.repeat(strings_at, self.length)
        node = np.arange(n_chars, dtype=np.int32) + owner  # one node more than characters per string
        self.first = (cp[:-1] + strings_at).astype(np.int32)
        self.nodes = n_chars + len(self.length)
        depth = node - self.first[owner]
        left = self.length.astype(np.int32)[owner] - depth
        sym = self.char.copy()
        if escape:
            sym[sym == ord(MARK)] = vocab.NOWHERE
        sym[sym == 32] = ord(MARK)
        state = vocab.root[sym]
        at = np.flatnonzero(state >= 0).astype(np.int32)
        state = state[at]
        piece = vocab.piece_at[state]
        hit = piece >= 0
        covered = np.zeros(n_chars, bool)
        covered[at[hit]] = True
        bare = np.flatnonzero(~covered)
        # one number past the vocabulary: spell the character out
        chars, reach, ids = [at[hit], bare], [1, 1], [piece[hit], np.full(len(bare), vocab.size, np.int32)]
        for k in range(1, vocab.longest):
            live = left[at] > k
            at, state = at[live], state[live]
            state = vocab.step(state, sym[at + k])
            live = state >= 0
            at, state = at[live], state[live]
            if not len(at):
                break
            piece = vocab.piece_at[state]
            hit = piece >= 0
            chars.append(at[hit])
            reach.append(k + 1)
            ids.append(piece[hit])
        reach = np.repeat(np.array(reach, np.int32), list(map(len, chars)))
        chars, ids = np.concatenate(chars), np.concatenate(ids)
        kind = np.uint16 if self.length.max(initial=0) < 1 << 16 else np.uint32
        end_depth = (depth[chars] + reach).astype(kind)
        order = np.argsort(end_depth, kind="stable")
        self.src, self.ids = node[chars[order]], ids[order]
        self.dst = self.src + reach[order]
        self.owner = owner[chars[order]]  # string of each edge
        self.start_depth = (end_depth[order] - reach[order]).astype(kind)
        self.node_of_char = node
        self.bounds = np.concatenate([[0], np.cumsum(np.bincount(end_depth)[1:])]) if len(ids) else np.zeros(1, int)

    @staticmethod
    def add_up(own: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(strings, their sums of ``x``, place of each edge's string among them)."""
        if len(own) * 8 > own.max() + 1:
            total = np.bincount(own, weights=x)
            return np.arange(len(total)), total, own
        strings, at = np.unique(own, return_inverse=True)
        return strings, np.bincount(at, weights=x), at

    def forward(self, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum over all segmentations up to each node, given a weight per edge (1 at the start of a string), over a scale; the scale's logarithm."""
        alpha, scale = np.zeros(self.nodes), np.zeros(self.nodes)
        alpha[self.first] = 1.0
        now = np.zeros(len(self.length))
        for d, (a, b) in enumerate(zip(self.bounds[:-1], self.bounds[1:], strict=True), 1):
            own, src = self.owner[a:b], self.src[a:b]
            if not len(own):
                continue
            x = alpha[src] * weight[a:b]
            if d > STEP:
                x *= np.exp(scale[src] - now[own])
            strings, total, at = self.add_up(own, x)
            if d % STEP == 0:
                met = total > 0
                now[strings[met]] += np.log(total[met])
                total[met] = 1.0
            alpha[self.dst[a:b]] = total[at]
            if d >= STEP:
                scale[self.dst[a:b]] = now[own]
        return alpha, scale

    def backward(self, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum over all segmentations from each node to the end of its string, over a scale; the scale's logarithm."""
        beta, scale = np.zeros(self.nodes), np.zeros(self.nodes)
        beta[self.first + self.length] = 1.0
        now = np.zeros(len(self.length))
        order = np.argsort(self.start_depth, kind="stable")
        ends = np.cumsum(np.bincount(self.start_depth)) if len(order) else np.zeros(0, int)
        for d in range(len(ends) - 1, -1, -1):
            edges = order[ends[d - 1] if d else 0:ends[d]]
            if not len(edges):
                continue
            own, dst = self.owner[edges], self.dst[edges]
            x = beta[dst] * weight[edges] * np.exp(scale[dst] - now[own])
            strings, total, at = self.add_up(own, x)
            left = self.length[strings] - d
            met = (left > 0) & (left % STEP == 0) & (total > 0)
            now[strings[met]] += np.log(total[met])
            total[met] = 1.0
            beta[self.src[edges]] = total[at]
            scale[self.src[edges]] = now[own]
        return beta, scale
