"""Operator 5: language ID by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.  A text's likelihood under a language is
the sum over all ways to cut it into pieces, by the forward algorithm; chunks (white space, then a word) are
independent, so it is computed once per distinct chunk of a batch.

Chunks of any length are summed whole, with a scale that follows the running total (``lattice``); a text longer than
``SLICE`` is worked through in runs of chunks.  A row's result depends on the model and its own text alone.

Learning is one expectation step over *all* training rows: under equal piece probabilities, forward and backward sums
give each chunk's expected piece counts, which are added up by (language, piece).  The table that results is bounded by
vocabulary times languages; it is what the driver sees and sends out.

Null text and text without a letter are ``und`` with score 0; without training rows everything is ``und``; ties go to the
first language by name; repeated rows count as often as they occur (training) and give repeated results; extra columns
are ignored (``identify``) or kept (``label``).  A row with a null id is never learned from, and its ``held_out`` is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lattice import Lattice, Pieces, pieces
from .textarrays import distinct_chunks, segments, small_batches, text_rows, text_slices

UND = "und"
FALLBACK = 1e-7  # probability of a character outside the vocabulary
SMOOTH = 200.0  # pieces' worth of the all-language distribution mixed into each language
FLOOR = 1e-9  # least probability of a vocabulary piece, seen or not
SCALE = 64.0  # per character: keeps sums over a few characters near 1
FIXED = float(1 << 20)  # expected counts are summed as whole multiples of 1/FIXED, so that order does not matter
SLICE = 3 << 19  # bytes of text worked on at once: the arrays made from them take about 60 times as much


def folded(text: pa.Array) -> pa.Array:
    """Small letters, and blanks for line breaks."""
    return pc.replace_substring_regex(pc.utf8_lower(text), r"[\n\r\t]", " ")


def chunk_lattice(path: str, text: pa.Array):
    chunks, codes, _, ptr = distinct_chunks(text)
    return Lattice(pieces(path), chunks, escape=False), codes, ptr


def piece_shares(vocab: Pieces, lat: Lattice) -> np.ndarray:
    """Probability that a segmentation of the edge's string uses the edge, under equal piece probabilities."""
    w = np.where(lat.ids < vocab.size, SCALE / len(vocab.plain), FALLBACK * SCALE)
    w = w * SCALE ** (lat.dst - lat.src - 1)
    (alpha, up), (beta, down) = lat.forward(w), lat.backward(w)
    end = lat.first + lat.length
    total = np.log(alpha[end]) + up[end]
    return alpha[lat.src] * w * beta[lat.dst] * np.exp(up[lat.src] + down[lat.dst] - total[lat.owner])


def expected_counts(train: DataFrame, vocab_path: str) -> DataFrame:
    """``lang, piece, n``: expected uses of each piece (in 1/FIXED) over all rows of ``train(id, text, lang)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = pieces(vocab_path)
        sums: dict[str, np.ndarray] = {}
        for b in text_slices(batches, SLICE):
            langs = np.array(b.column("lang").to_pylist(), object)
            for text, _ in segments(folded(b.column("text")), SLICE):
                lat, codes, ptr = chunk_lattice(vocab_path, text)
                if not len(codes):
                    continue
                share = piece_shares(vocab, lat)
                of_chunk = np.repeat(langs, np.diff(ptr))
                for lang in set(langs):
                    uses = np.bincount(codes[of_chunk == lang], minlength=len(lat.length))
                    n = np.bincount(lat.ids, weights=share * uses[lat.owner], minlength=vocab.size + 1)
                    sums[lang] = sums.get(lang, 0) + n
        for lang, n in sums.items():
            at = np.flatnonzero(n[:vocab.size] > 0)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(np.rint(n[at] * FIXED).astype(np.int64))],
                                             names=["lang", "piece", "n"])

    parts = train.mapInArrow(run, "lang string, piece long, n long")
    return parts.groupBy("lang", "piece").agg(F.sum("n").alias("n"))


class Model:
    """Languages in order and their piece probabilities (the last column: a character outside the vocabulary)."""

    def __init__(self, languages: list[str], prob: np.ndarray, vocab_path: str):
        self.languages, self.prob, self.vocab_path = languages, prob, vocab_path

    def loglik(self, text: pa.Array) -> np.ndarray:
        """Rows by languages; the constant of SCALE is the same for all languages."""
        out = np.zeros((len(text), len(self.languages)))
        for part, _ in segments(folded(text), SLICE):
            lat, codes, ptr = chunk_lattice(self.vocab_path, part)
            if not len(codes):
                continue
            stretch = SCALE ** (lat.dst - lat.src)
            row, end = np.repeat(np.arange(len(text)), np.diff(ptr)), lat.first + lat.length
            for k in range(len(self.languages)):
                alpha, scale = lat.forward(self.prob[k][lat.ids] * stretch)
                per = np.log(alpha[end]) + scale[end]
                out[:, k] += np.bincount(row, weights=per[codes], minlength=len(text))
        return out

    def label(self, text: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Language and score of every row."""
        letters = pc.match_substring_regex(text, r"\p{L}").to_numpy(zero_copy_only=False)
        if not self.languages:
            return pa.array([UND] * len(text), pa.string()), pa.array(np.zeros(len(text)))
        ll = self.loglik(text)
        score = np.where(letters, 1 / np.exp(ll - ll.max(axis=1, keepdims=True)).sum(axis=1), 0.0)
        return pa.array([self.languages[k] if ok else UND for k, ok in zip(ll.argmax(axis=1), letters, strict=True)], pa.string()), pa.array(score)


def fit(train: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from all rows of ``train`` whose language is not null."""
    rows = text_rows(train.where(F.col(lang_col).isNotNull()), id_col, text_col, F.col(lang_col).cast("string").alias("lang"))
    table = expected_counts(rows, vocab_path).toPandas()  # at most vocabulary x languages rows
    vocab = pieces(vocab_path)
    languages = sorted(table["lang"].unique())
    count = np.zeros((len(languages), vocab.size))
    count[[languages.index(x) for x in table["lang"]], table["piece"].to_numpy(np.int64)] = table["n"].to_numpy() / FIXED
    known = np.zeros(vocab.size)
    known[vocab.plain] = 0.01
    all_ = count.sum(axis=0) + known
    prob = count + SMOOTH * all_ / max(all_.sum(), 1e-9)
    prob = np.maximum(prob / np.maximum(prob.sum(axis=1, keepdims=True), 1e-300), FLOOR)
    return Model(languages, np.hstack([prob, np.full((len(languages), 1), FALLBACK)]), vocab_path)


def label(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (columns of these names are replaced), in one narrow pass: no row is moved or joined.

    The score is the winner's posterior under equal priors.  A null text counts as empty and stays null.
    """
    rest = docs.drop("lang_pred", "score")
    kept = [f for f in rest.schema.fields if keep_text or f.name != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, SLICE, text_col):
            names, score = model.label(pc.fill_null(b.column(text_col), ""))
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in kept), names, score], names=[*(f.name for f in kept), "lang_pred", "score"])

    return small_batches(rest).mapInArrow(run, T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def held_out(id_col: str = "doc_id"):
    """Rows never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(F.col(id_col).cast("string")) % 4 == 2


def learn(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from the rows that are not held out."""
    return fit(docs.where(~held_out(id_col)), vocab_path, id_col, text_col, lang_col)


def identify(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out, predict all: ``doc_id, held_out, lang_pred, score``."""
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col))
    found = label(rows, learn(docs, vocab_path, id_col, text_col, lang_col), text_col, keep_text=False)
    return found.select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")
