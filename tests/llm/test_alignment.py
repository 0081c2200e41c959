"""Operator 13 against token-by-token loops over the libraries' own encodings of whole texts."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from segmenta.llm import alignment, queries

SMALL = "/root/testdata/sf0.001"
WIDE = "doc_id long, text string, a int, b string, slice string, code int, codes string, id string, count int"
ODD = ["", None, " ", "  a  b\n\n c   ", "x<|endoftext|> y  <|endoftext|>z <s> </s> <unk>", "a  b　 c  d", "\x1c \x1d a\x1fb \x85 c",
       "'s it's don't  \t\r\n 12 345.67!?'s", "ΑΣ ΒΣ é ́x İstanbul ẞ", "x" * 5000, " " * 3000 + "a", "日本語 テキスト 😀😀 ok", "a▁b", "fine ▁ fine", "a\x00b\x00",
       "ünïcödé " * 30, "ünïcödé " * 30, "ﬁ Å   x", "﻿bom", "http://a.b/c?d=e&f=g " * 20, " \ta", "<0x0A> <0xE2>", "tab\tand line"]


def alphabet():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return {chr(x) if x in shown else chr(next(rest)): x for x in range(256)}


class Brute:
    def __init__(self):
        self.a = Tokenizer.from_file(queries.BYTE_BPE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
        self.byte_of = alphabet()

    def tokens(self, text):
        """[(id, bytes)] under A and B, or none."""
        if not text:
            return [], []
        e = self.a.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(self.byte_of[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])

    def groups(self, a, b):
        out, i, j, end_a, end_b, part = [], 0, 0, 0, 0, ([], [])
        while i < len(a) or j < len(b):
            if end_a <= end_b:
                part[0].append(a[i][0])
                end_a, i = end_a + len(a[i][1]), i + 1
            else:
                part[1].append(b[j][0])
                end_b, j = end_b + len(b[j][1]), j + 1
            if end_a == end_b:
                out.append(part)
                part = ([], [])
        return out

    def links(self, a, b):
        out, at_a, j, at_b = [], 0, 0, 0
        for i, x in a:
            end = at_a + len(x)
            while at_b + len(b[j][1]) <= at_a:
                at_b, j = at_b + len(b[j][1]), j + 1
            k, at = j, at_b
            while k < len(b) and at < end:
                out.append((i, b[k][0]))
                at, k = at + len(b[k][1]), k + 1
            at_a = end
        return out

    def digest(self, docs):
        cut = [(d, *self.tokens(t)) for d, t in docs]
        linked = [self.links(a, b) for _, a, b in cut]
        count = Counter(p for x in linked for p in set(x))
        most = defaultdict(int)
        for (a, _), n in count.items():
            most[a] = max(most[a], n)
        out = []
        for (d, a, b), x in zip(cut, linked):
            groups = self.groups(a, b)
            text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
            out.append((d, len(a), len(b), len(groups), len(x), sum(count[p] == most[p[0]] for p in x), sum(count[p] for p in x),
                        hashlib.sha256(text.encode()).hexdigest() if a else ""))
        return ordered(out)


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r))


@pytest.fixture(scope="module")
def brute():
    return Brute()


def test_whole_table(spark, brute):
    t = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    assert ordered(queries.op13_alignment(spark, SMALL).collect()) == brute.digest([(r["doc_id"], r["text"]) for r in t])


@pytest.mark.parametrize("size", [1, 300, 4 << 20])
def test_odd_texts_in_slices_and_segments(spark, brute, size):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "null id"), (100, " ".join(f"word{i % 97}x{i}" for i in range(3000))), (101, "a▁ " + "b " * 500)]
    df = spark.createDataFrame([(i, t, 1, "b", "s", 2, "c", "i", 3) for i, t in docs], WIDE).repartition(3)
    assert ordered(alignment.align(df, queries.BYTE_BPE, queries.PIECES, size=size).collect()) == brute.digest(docs)


def test_empty_tables(spark):
    none = spark.createDataFrame([], WIDE)
    assert alignment.align(none, queries.BYTE_BPE, queries.PIECES).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (3, "▁")], "doc_id long, text string")
    assert ordered(alignment.align(blank, queries.BYTE_BPE, queries.PIECES).collect()) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]


def test_pointers_reach_the_last_token():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        a, b = (np.unique(np.append(rng.integers(1, n + 1, rng.integers(0, n + 1)), n)) for _ in "ab")
        to = alignment.terminals(np.append(0, a[:-1]), a, np.append(0, b[:-1]), b) - len(a)
        ends = np.intersect1d(a, b)
        want = np.searchsorted(b, ends[np.searchsorted(ends, np.concatenate([a, b]))])
        assert (to == want).all()
