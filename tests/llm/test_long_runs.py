"""Runs of any length without white space: exact sums, predictions by a plain loop, no effect on other rows, token counts."""

import math
import time
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from segmenta.llm import language, lattice, queries, sampling, token_counts

URL = "http://example.org/a-rather-long-path/with-many-parts/" + "segment-of-a-name_" * 9 + "?query=a%20b&c=d"
RUNS = ["a" + "\x01" * 64, "я" * 65, "x" * 66, URL, "日本語" * 40, "\x02\x03" * 3000, "ab" * 5_000, "😀" * 200, "щ" * 40]


def known_pieces(vocab):
    return {vocab.text[i].replace("▁", " "): i for i in vocab.plain}


def log_sum(text, vocab, known, weight):
    """Logarithm of the sum over all segmentations, by a loop over places in logarithms."""
    best = [0.0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        terms = []
        for n in range(1, min(vocab.longest, end) + 1):
            i = known.get(text[end - n:end], vocab.size if n == 1 else None)
            if i is not None:
                terms.append(best[end - n] + math.log(weight[i]))
        top = max(terms)
        best[end] = top + math.log(sum(math.exp(t - top) for t in terms))
    return best[-1]


@pytest.mark.parametrize("text", [" " + URL, "a" + "\x01" * 64, "日本" * 300, "я" * 1000, "xy" * 50_000])
def test_sums_over_long_strings(text):
    vocab = lattice.pieces(queries.PIECES)
    weight = np.random.default_rng(1).uniform(1e-12, 1e-3, vocab.size + 1)
    lat = lattice.Lattice(vocab, pa.array(["the", text, "x"], pa.large_string()), False)
    (f, up), (b, down) = lat.forward(weight[lat.ids]), lat.backward(weight[lat.ids])
    end = lat.first + lat.length
    forward, backward = np.log(f[end]) + up[end], np.log(b[lat.first]) + down[lat.first]
    for i, t in enumerate(["the", text, "x"]):
        want = log_sum(t, vocab, known_pieces(vocab), weight)
        assert forward[i] == pytest.approx(want) and backward[i] == pytest.approx(want)


def trained():
    train = ["the words of the house and the garden", "die Wörter des Hauses und der Garten", "les mots de la maison et le jardin"] * 4
    langs = ["en", "de", "fr"] * 4
    return train, langs


def model(spark):
    train, langs = trained()
    return language.fit(spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(zip(train, langs))], "doc_id long, text string, lang string"), queries.PIECES)


def test_predictions_of_a_plain_loop(spark):
    m = model(spark)
    vocab = lattice.pieces(queries.PIECES)
    known = known_pieces(vocab)
    texts = ["the garden", "der Garten und", "la maison", "Haus-und-Garten", "x", "die\nmots  the", URL, "я" * 100 + " the", "THE HOUSE", "a" + "\x01" * 200]
    names, score = m.label(pa.array(texts))
    for t, name, s in zip(texts, names.to_pylist(), score.to_pylist()):
        ll = [log_sum(t.lower().replace("\n", " "), vocab, known, p) for p in m.prob]
        want = 1 / sum(math.exp(x - max(ll)) for x in ll)
        assert name == m.languages[ll.index(max(ll))] and s == pytest.approx(want, abs=1e-6)


def test_a_row_more_changes_no_other_row(spark):
    m = model(spark)
    train, _ = trained()
    alone = m.label(pa.array(train))
    for run in RUNS:
        names, score = m.label(pa.array([*train[:5], run, *train[5:]]))
        names, score = names.to_pylist(), score.to_pylist()
        assert 0 <= score[5] <= 1
        del names[5], score[5]
        assert names == alone[0].to_pylist() and score == alone[1].to_pylist()


def test_runs_in_the_query_and_the_pipeline(spark):
    train, langs = trained()
    rows = [(i, t, x, "s", len(t)) for i, (t, x) in enumerate(zip(train + RUNS, langs + ["en"] * len(RUNS)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    got = {r["doc_id"]: r for r in language.identify(docs, queries.PIECES).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    kept = {r["doc_id"]: r["lang"] for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert all(kept[i] == got[i]["lang_pred"] for i in kept) and {i for i in got if got[i]["score"] >= corpus_pipeline.MIN_SCORE
                                                                and got[i]["lang_pred"] != "und"} == set(kept)


def test_long_texts_in_segments(monkeypatch):
    text = pa.array([(" ".join(RUNS[:5]) + " the house ") * 20])
    for module in (language, sampling):
        monkeypatch.setattr(module, "SLICE", 1 << 30)
    vocab = lattice.pieces(queries.PIECES)
    m = language.Model(["a", "b"], np.random.default_rng(2).uniform(1e-9, 1e-2, (2, vocab.size + 1)), queries.PIECES)
    whole, (_, ids) = m.loglik(text), sampling.sample_rows(vocab, np.array([5]), text, 2e-4, 1)
    for module in (language, sampling):
        monkeypatch.setattr(module, "SLICE", 500)
    ptr, parts = sampling.sample_rows(vocab, np.array([5]), text, 2e-4, 1)
    assert m.loglik(text) == pytest.approx(whole) and parts.tolist() == ids.tolist() and ptr.tolist() == [0, len(ids)]


def test_samples_cross_any_place():
    """Pieces of a long URL cross every place at which a window of fixed length might end."""
    vocab = lattice.pieces(queries.PIECES)
    texts = [("the" + URL * 3)[k % 9:][:400] for k in range(200)]
    ptr, ids = sampling.sample_rows(vocab, np.arange(200), pa.array(texts), 2e-4, 0)
    ends = []
    for i, text in enumerate(texts):
        parts = [vocab.text[k] for k in ids[ptr[i]:ptr[i + 1]].tolist()]
        assert "".join(parts) == text
        ends.append(set(np.cumsum([len(x) for x in parts]).tolist()))
    crossed = {at for at in range(1, 400) if any(at not in e for e in ends)}
    assert {64, 128, 192, 256, 320, 384} <= crossed
    with pytest.raises(ValueError):
        sampling.sample_rows(vocab, np.arange(1), pa.array([URL]), 0.5, 0)


def test_token_counts_of_long_runs(spark):
    rng = np.random.default_rng(3)
    letters = "".join(rng.choice(list("etaoinshrdlu"), 30_000))
    texts = [*RUNS, letters, "a" * 1001, "ab" * 999 + "a", "the" * 5000, "!" * 3000, "é" * 3001, " " * 999 + "x" * 300, letters.upper() + " " + letters]
    tok = Tokenizer.from_file(queries.BYTE_BPE)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, queries.BYTE_BPE, P.PATTERN).collect()}
    assert got == {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_a_megabyte_of_letters_takes_seconds():
    text = "".join(np.random.default_rng(4).choice(list("etaoinshrdlucmfw"), 1_000_000))
    start = time.time()
    n = token_counts.merge_table(queries.BYTE_BPE, P.PATTERN).counts([text])[0]
    assert time.time() - start < 60
    assert n == len(Tokenizer.from_file(queries.BYTE_BPE).encode(text, add_special_tokens=False).ids)

