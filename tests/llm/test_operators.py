"""Every operator against a brute-force version, an exact round trip or held-out accuracy, and on awkward inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
import regex
import public_tokenizers as P
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline
from segmenta.llm import language, lattice, licenses, packing, pii, queries, sampling, suffix_dedup, text_dedup, token_counts, topk, vector_dedup

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     # names that operators use inside
                     T.StructField("key", T.StringType()), T.StructField("doc", T.StringType()), T.StructField("id", T.StringType()),
                     T.StructField("kept", T.StringType()), T.StructField("length", T.StringType())])

LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
PASSAGE = "a passage that many documents share, word for word, and that is longer than a hundred bytes, so it must go the second time. "
ODD = ["", None, " ", "  a  b\n\n c   ", "x<|endoftext|> y  <|endoftext|>z", "a  b　 c  d", "\x1c \x1d a\x1fb \x85 c",
       "'s it's don't  \t\r\n 12 345.67!?'s", "ΑΣ ΒΣ é ́x İstanbul ẞ", "x" * 5000, " " * 3000 + "a", "日本語 テキスト 😀😀 ok", "aaaa" * 50 + " aaaaa",
       "<|startoftext|>A b<|ENDOFTEXT|>", "a \u0085b", "x▁y ▁ <0x0A>", "a\x00b\x00", LONG, PASSAGE * 3, "before " + PASSAGE, PASSAGE + "after", PASSAGE * 3,
       "ünïcödé " * 30, "ünïcödé " * 30]


def rows_of(texts, first=0):
    return [(first + i, t, "en", "s", 1, "k", "d", "i", "x", "l") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    # a repeated row and a null id besides
    rows = rows_of(ODD) + rows_of(ODD)[17:19]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def medium():
    t = pq.read_table(f"{MEDIUM}/documents.parquet").to_pylist()
    return {r["doc_id"]: r for r in t}


def collected(df):
    return [r.asDict() for r in df.collect()]


# ---------------------------------------------------------------- 1
def brute_top(ids, vectors, every=50, k=5):
    q = np.floor(vectors.astype(np.float64) * 256).astype(np.int64)
    out = []
    for i in np.flatnonzero(ids % every == 0):
        s = q @ q[i]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out += [(int(ids[i]), r + 1, int(ids[j]), int(s[j])) for r, j in enumerate(order)]
    return sorted(out)


def test_topk_is_exact(spark):
    t = pq.read_table(f"{MEDIUM}/embeddings.parquet")
    want = brute_top(t["vec_id"].to_numpy(), np.stack(t["embedding"].to_numpy()))
    df = spark.read.parquet(f"{MEDIUM}/embeddings.parquet")
    got = sorted(map(tuple, topk.top_k(df).collect()))
    assert got == want
    v = topk.quantised(df, "vec_id", "embedding")
    small = topk.search(topk.build_index(v, block_rows=70), v.where("id % 50 = 0"), 5, query_rows=3)
    assert sorted(map(tuple, small.collect())) == want


def test_topk_awkward(spark):
    schema = "vec_id long, embedding array<float>, label int, block string, score string"
    rows = [(0, [1.0, -2.5], 1, "b", "s"), (1, [1.0, -2.5], 1, "b", "s"), (2, [1.0, -2.5], 1, "b", "s"), (2, [1.0, -2.5], 1, "b", "s"), (3, None, 1, "b", "s"),
            (4, [1.0, None], 1, "b", "s"), (5, [float("nan"), 1.0], 1, "b", "s"), (6, [float("inf"), 1.0], 1, "b", "s"), (50, [3.0, 4000.0], 1, "b", "s"),
            (100, [1.0, 2.0, 3.0], 1, "b", "s"), (150, [], 1, "b", "s"), (None, [1.0, 1.0], 1, "b", "s")]
    got = sorted(map(tuple, topk.top_k(spark.createDataFrame(rows, schema)).collect()))
    assert [(q, r, v) for q, r, v, _ in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (50, 1, 0), (50, 2, 1), (50, 3, 2)]
    assert got[0][3] == 256 ** 2 + 640 ** 2
    assert topk.top_k(spark.createDataFrame([], schema)).count() == 0


# ---------------------------------------------------------------- 2
def check_packing(rows, texts, capacity):
    tok = Tokenizer.from_file(queries.WORD_BPE)
    by_doc = defaultdict(list)
    bins = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, text in texts.items():
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        assert len({(r["piece"]) for r in by_doc[doc]}) == -(-len(ids) // capacity)
        for r in by_doc[doc]:
            part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4")
            assert r["start"] == r["piece"] * capacity and r["ids_crc32"] == zlib.crc32(part.tobytes())
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(r["length"] for r in rows)


def test_packing_whole_corpus(spark, medium):
    rows = collected(queries.op2_packing(spark, MEDIUM))
    n, total = check_packing(rows, {k: r["text"] for k, r in medium.items()}, 2048)
    assert n <= -(-total // 2048) + 1


def test_packing_awkward(spark, odd, empty):
    rows = collected(packing.pack_documents(odd, queries.WORD_BPE, 64, 0, keep_ids=True))
    check_packing(rows, dict(enumerate(ODD)), 64)
    assert Counter(r["doc_id"] for r in rows)[18] == 2 * Counter(r["doc_id"] for r in rows)[21]
    assert packing.pack_documents(empty, queries.WORD_BPE).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_fills_and_never_overflows(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(1, 200))
    histogram = Counter(rng.integers(1, capacity + 1, 3000).tolist())
    runs, bins = packing.packing_plan(dict(histogram), capacity)
    load = np.zeros(bins, int)
    seen = Counter()
    for length, rank, n, first, offset in sorted(runs, key=lambda r: r[4]):
        assert (load[first:first + n] == offset).all()
        load[first:first + n] += length
        seen[length] += n
    assert seen == histogram and load.max() <= capacity
    large = sum(v for k, v in histogram.items() if 2 * k > capacity)
    assert bins <= max(large, -(-int(load.sum()) // capacity)) * 1.25 + 2


def test_tokens_equal_the_library_alone():
    import pyarrow as pa

    tok = Tokenizer.from_file(queries.WORD_BPE)
    for text in [t for t in ODD if t is not None]:
        ptr, ids = packing.encode_rows(queries.WORD_BPE, pa.array([text]))
        assert ids.tolist() == tok.encode(text, add_special_tokens=False).ids


# ---------------------------------------------------------------- 3
def brute_repeats(texts, n=100):
    """texts: {id: str} -> {id: mask}."""
    seen, out = {}, {}
    for doc in sorted(texts):
        raw = (texts[doc] or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - n + 1):
            part = raw[s:s + n]
            if part in seen:
                gone[s:s + n] = True
            else:
                seen[part] = s
        out[doc] = (raw, gone)
    return out


def repeat_digest(raw, gone):
    spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
    return (len(raw), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest())


def test_repeats_equal_brute_force(spark, medium):
    want = {k: repeat_digest(*v) for k, v in brute_repeats({k: r["text"] for k, r in medium.items()}).items()}
    got = {r[0]: tuple(r[1:]) for r in queries.op3_suffix_dedup(spark, MEDIUM).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 10_000


@pytest.mark.parametrize("all_hot", [False, True])
def test_repeats_awkward(spark, empty, all_hot, monkeypatch):
    rng = np.random.default_rng(5)
    base = "".join(rng.choice(list("abcd é\n"), 900))
    texts = [t for t in ODD] + [base, base[:450] + "Q" + base[450:], "z" * 250, base[100:199], base[100:200], base[100:201] + "!", "z" * 99, "z" * 101]
    texts += ["".join(rng.choice(list("ab"), 40)) + PASSAGE + "".join(rng.choice(list("ab"), 40)) for _ in range(40)]
    df = spark.createDataFrame(rows_of(texts), DOCS).repartition(4)
    if all_hot:  # every anchor takes the way of the hot ones
        hot = np.concatenate([suffix_dedup.anchors(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]))[1] for t in texts])
        monkeypatch.setattr(suffix_dedup, "hot_anchors", lambda _: np.unique(hot))
    got = {r[0]: tuple(r[1:]) for r in suffix_dedup.digest(df).collect()}
    want = brute_repeats(dict(enumerate(texts)))
    assert got == {k: repeat_digest(*v) for k, v in want.items()}
    kept = {r["doc_id"]: r for r in collected(suffix_dedup.remove_repeats(df))}
    assert set(kept[0]) == set(df.columns)
    assert all(kept[k]["text"] == (None if texts[k] is None else np.frombuffer(raw, np.uint8)[~gone].tobytes().decode(errors="ignore")) for k, (raw, gone) in want.items())
    assert suffix_dedup.digest(empty).count() == 0


def test_repeats_with_shared_and_null_ids(spark):
    other = PASSAGE.upper()
    rows = [(1, PASSAGE), (1, PASSAGE), (2, PASSAGE), (3, other), (3, PASSAGE + other), (None, PASSAGE), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r[0] is not None, r[0], r[1], r[2]) for r in suffix_dedup.digest(df).collect() if r[0] is not None)
    n = len(PASSAGE)
    assert got[:3] == [(True, 1, n, n), (True, 1, n, n), (True, 2, n, n)]  # the null id comes first and keeps it
    assert sum(r[3] for r in got[3:]) >= 2 * n
    assert suffix_dedup.digest(df).count() == len(rows)


# ---------------------------------------------------------------- 4
def test_sampling_round_trip(spark, odd, empty):
    got = collected(sampling.digest(odd, queries.PIECES, seed=3))
    assert len(got) == odd.count() and all(r["lossless"] for r in got)
    enc = sampling.encode(odd, queries.PIECES, seed=3)
    ids = {r["doc_id"]: r["ids"] for r in collected(enc)}
    back = {r["doc_id"]: r["text"] for r in collected(sampling.decode(enc, queries.PIECES))}
    assert back == {i: t or "" for i, t in enumerate(ODD)}
    again = {r["doc_id"]: r["ids"] for r in collected(sampling.encode(odd.repartition(1), queries.PIECES, seed=3))}
    assert again == ids
    assert ids[17] != {r["doc_id"]: r["ids"] for r in collected(sampling.encode(odd, queries.PIECES, seed=4))}[17]
    assert sampling.digest(empty, queries.PIECES).count() == 0
    assert all(r["lossless"] for r in collected(queries.op4_sampling(spark, SMALL)))


def segmentations(text, vocab, weight, known):
    if not text:
        return [((), 1.0)]
    out = []
    for n in range(1, min(vocab.longest, len(text)) + 1):
        piece = text[:n].replace("▁", "\0").replace(" ", "▁")
        i = known.get(piece, vocab.size if n == 1 else None)
        if i is not None:
            out += [((i, *rest), weight[i] * w) for rest, w in segmentations(text[n:], vocab, weight, known)]
    return out


def test_samples_follow_the_lattice():
    import pyarrow as pa

    vocab = lattice.pieces(queries.PIECES)
    known = {vocab.text[i]: i for i in vocab.plain}
    weight = np.exp(2e-4 * np.append(vocab.score, -vocab.size))
    want = Counter(dict(segmentations(" the▁n", vocab, weight, known)))
    total = sum(want.values())
    n = 20_000
    ptr, ids = sampling.sample_rows(vocab, np.arange(n), pa.array([" the▁n"] * n), 2e-4, 0)
    got = Counter(tuple(ids[ptr[i]:ptr[i + 1]].tolist()) for i in range(n))
    spelled = tuple(vocab.byte_id[list("▁".encode())])
    for seg, w in want.items():
        shown = tuple(x for i in seg for x in (spelled if i == vocab.size else (i,)))
        assert abs(got[shown] / n - w / total) < 0.015


# ---------------------------------------------------------------- 5
def test_forward_and_backward_sum_all_segmentations():
    import pyarrow as pa

    vocab = lattice.pieces(queries.PIECES)
    known = {vocab.text[i]: i for i in vocab.plain}
    weight = np.exp(2e-4 * np.append(vocab.score, -vocab.size))
    words = [" the", " Tion", "été", "x▁y", " ", "zq日", ""]
    lat = lattice.Lattice(vocab, pa.array(words, pa.large_string()), True)
    (f, up), (b, down) = lat.forward(weight[lat.ids]), lat.backward(weight[lat.ids])
    for i, w in enumerate(words):
        want = sum(x for _, x in segmentations(w, vocab, weight, known))
        end = lat.first[i] + lat.length[i]
        assert f[end] * np.exp(up[end]) == pytest.approx(want) and b[lat.first[i]] * np.exp(down[lat.first[i]]) == pytest.approx(want)


def test_language_held_out_accuracy(spark, medium):
    got = {r["doc_id"]: r for r in collected(queries.op5_language(spark, MEDIUM))}
    assert len(got) == len(medium)
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in got.items())
    held = [k for k, r in got.items() if r["held_out"]]
    right = [got[k]["lang_pred"] == medium[k]["lang"] for k in held]
    assert np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_label_keeps_rows_and_columns(spark, odd):
    clash = odd.withColumn("lang_pred", F.lit("x")).withColumn("score", F.lit(1))
    got = language.label(clash, language.learn(odd, queries.PIECES))
    assert got.columns == odd.columns + ["lang_pred", "score"] and got.select(*odd.columns).exceptAll(odd).count() == 0
    want = Counter(r[0::2] for r in language.identify(odd, queries.PIECES).select("doc_id", "score", "lang_pred").collect())
    assert Counter(r[0::2] for r in got.select("doc_id", "score", "lang_pred").collect()) == want and got.count() == odd.count()


def test_language_awkward(spark, odd, empty):
    got = {r["doc_id"]: r for r in collected(language.identify(odd, queries.PIECES))}
    assert got[0]["lang_pred"] == got[1]["lang_pred"] == got[2]["lang_pred"] == "und" and got[1]["score"] == 0
    assert got[17]["lang_pred"] == "en"
    assert language.identify(empty, queries.PIECES).count() == 0
    nothing = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in collected(language.identify(nothing, queries.PIECES))} == {"und"}


# ---------------------------------------------------------------- 6
def brute_best_dice(text, templates, threshold):
    words = licenses.words(text or "")
    grams = list(zip(words, words[1:], strict=False))
    best = 0.0
    for t in templates.values():
        tw = licenses.words(t)
        tg = Counter(zip(tw, tw[1:], strict=False))
        n = sum(tg.values())
        for i in range(len(grams)):
            for j in range(i + 1, min(len(grams), i + 2 * n) + 1):
                shared = sum((Counter(grams[i:j]) & tg).values())
                best = max(best, 2 * shared / (j - i + n))
    return best if best >= threshold else None


def test_licenses_equal_brute_force(spark, medium):
    small = {k: v for k, v in licenses.TEMPLATES.items() if k.endswith("line")}
    some = [r["text"] for r in medium.values() if re.search("licen", r["text"], re.I) and len(r["text"]) < 3000][:12]
    some += ["Released under the MIT License.", "was released under the terms of the MIT License today", "nothing here", None, "",
             "Licensed under the Apache-License, version 2.0! Licensed under CC BY-NC 4.0 and Licensed under the Apache License, Version 2.0."]
    df = spark.createDataFrame(rows_of(some), DOCS)
    got = {r["doc_id"]: r for r in collected(licenses.scan(df, small))}
    for i, t in enumerate(some):
        want = brute_best_dice(t, small, 0.8)
        assert got[i]["dice"] == (want if want is None else pytest.approx(want))
    assert got[len(some) - 1]["n_hits"] == 3
    assert got[len(some) - 6]["license"] == "mit-line"


def test_licenses_long_templates_and_awkward(spark, odd, empty):
    texts = ["intro words. " + t + " closing words" for t in licenses.TEMPLATES.values()]
    df = spark.createDataFrame(rows_of(texts), DOCS)
    got = {r["doc_id"]: r["license"] for r in collected(licenses.scan(df))}
    names = list(licenses.TEMPLATES)
    assert [got[i] for i in range(len(names))] == names
    assert {r["n_hits"] for r in collected(licenses.scan(odd))} == {0}
    assert licenses.scan(empty).count() == 0


# ---------------------------------------------------------------- 7
def brute_links(ids, x, threshold=0.95):
    x = x.astype(np.float64)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= threshold
    np.fill_diagonal(link, False)
    comp = ids.copy()
    while True:
        low = np.minimum(comp, np.where(link, comp[None, :], np.iinfo(np.int64).max).min(1))
        if (low == comp).all():
            return link, comp
        comp = low


def test_vector_dedup_against_brute_force(spark):
    t = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    ids, x = t["vec_id"].to_numpy(), np.stack(t["embedding"].to_numpy())
    order = np.argsort(ids)
    link, comp = brute_links(ids[order], x[order])
    got = sorted(map(tuple, queries.op7_vector_dedup(spark, "/root/testdata/sf0.1").collect()))
    assert [g[0] for g in got] == ids[order].tolist()
    found = sum(g[1] for g in got)
    assert found >= 0.9 * link.sum() and all(g[1] <= n for g, n in zip(got, link.sum(1), strict=True))
    assert np.mean([g[2] == c for g, c in zip(got, comp, strict=True)]) > 0.97
    assert all(g[3] == (g[0] == g[2]) for g in got)


def test_vector_dedup_blocks_and_awkward(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "BLOCK", 16)
    rng = np.random.default_rng(1)
    near = rng.standard_normal(8) + 0.02 * rng.standard_normal((60, 8))
    far = rng.standard_normal((60, 8))
    rows = [(i, v.astype(np.float32).tolist(), "c", 7) for i, v in enumerate(np.concatenate([near, far]))]
    rows += [(200 + i, rows[3][1], "c", 7) for i in range(30)]  # equal vectors
    rows += [(300, None, "c", 7), (301, [0.0] * 8, "c", 7), (302, [float("nan")] * 8, "c", 7), (303, [None] * 8, "c", 7), (304, [], "c", 7), (305, [1.0], "c", 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell string, n int").repartition(5)
    got = {r[0]: tuple(r[1:]) for r in vector_dedup.near_duplicates(df, recall=1.0).collect()}
    good = [r for r in rows if r[0] < 300]
    link, comp = brute_links(np.array([r[0] for r in good]), np.array([r[1] for r in good]))
    assert {r[0]: (int(n), int(c), r[0] == c) for r, n, c in zip(good, link.sum(1), comp, strict=True)} == {k: v for k, v in got.items() if k < 300}
    assert all(got[k] == (0, k, True) for k in range(300, 306))
    assert vector_dedup.near_duplicates(spark.createDataFrame([], df.schema)).count() == 0
    assert vector_dedup.near_duplicates(df.where("vec_id >= 300 and vec_id < 305")).count() == 5


# ---------------------------------------------------------------- 8
def shingle_bag(text):
    w = (text or "").lower().split()
    return Counter([tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else [])


def brute_classes(texts, threshold=0.8):
    bags = {k: shingle_bag(t) for k, t in texts.items()}
    holders = defaultdict(list)
    for k, b in bags.items():
        for s in b:
            holders[s].append(k)
    parent = {k: k for k in texts}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    pairs = {(a, b) for h in holders.values() for i, a in enumerate(h) for b in h[i + 1:]}
    for a, b in pairs:
        both = sum((bags[a] & bags[b]).values())
        if both >= threshold * (sum(bags[a].values()) + sum(bags[b].values()) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {k: root(k) for k in texts}


def test_text_dedup_equals_brute_force(spark, medium):
    want = brute_classes({k: r["text"] for k, r in medium.items()})
    got = {r[0]: r[1] for r in queries.op8_text_dedup(spark, MEDIUM).collect()}
    assert got == want and len(set(want.values())) < len(want) - 50


def test_text_dedup_chain_group(spark, monkeypatch):
    """Near copies that meet each other but not the bucket's smallest member must still be linked."""
    monkeypatch.setattr(text_dedup, "BLOCK", 8)
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(60):  # a path: each text moves on by a few words
        w = base[i:] + [f"n{k}" for k in range(i)]
        texts.append(" ".join(w))
    order = rng.permutation(60)
    df = spark.createDataFrame(rows_of([texts[i] for i in order]), DOCS).repartition(4)
    got = {r[0]: r[1] for r in text_dedup.near_duplicates(df).collect()}
    assert got == brute_classes(dict(enumerate(texts[i] for i in order)))


def test_blocks_meet_pairs_whose_bytes_agree_by_chance():
    """An earlier band whose bytes agree but whose key differs is no bucket the pair has met in."""
    import pyarrow as pa

    n = text_dedup.BANDS
    sig = bytes(text_dedup.COORDINATES)
    keys = [[100 + k for k in range(n)], [0] + [100 + k for k in range(1, n)]]  # band 0: another key, the same bytes
    side = [[{"id": i, "comp": i, "n": 50, "u": 0, "sig": sig, "bands": keys[i]} for i in (0, 1)]]
    kind = pa.list_(pa.struct([("id", pa.int64()), ("comp", pa.int64()), ("n", pa.int64()), ("u", pa.int64()), ("sig", pa.binary()),
                               ("bands", pa.list_(pa.int64()))]))
    for band, want in ((1, [0, 1]), (2, [])):
        cell = pa.RecordBatch.from_arrays([pa.array([7]), pa.array([band]), pa.array([0]), pa.array([0]), pa.array(side, kind), pa.array(side, kind)],
                                          names=["key", "band", "i", "j", "left", "right"])
        (out,) = text_dedup.meet_again(iter([cell]), 0.8)
        assert out.column("id").to_pylist() == want


def test_text_dedup_awkward(spark, odd, empty):
    got = {r[0]: (r[1], r[2]) for r in text_dedup.near_duplicates(odd).collect()}
    assert got == {k: (c, c == k) for k, c in brute_classes(dict(enumerate(ODD))).items()}
    kept = text_dedup.keep_first(odd)
    assert kept.columns == odd.columns and {r[0] for r in kept.select("doc_id").collect()} == {k for k, v in got.items() if v[1]}
    assert text_dedup.near_duplicates(empty).count() == 0
    assert kept.count() == sum(v[1] for v in got.values())  # the repeated rows stay once
    null_id = odd.limit(1).withColumn("doc_id", F.lit(None).cast("long"))
    twice = null_id.withColumn("text", F.lit(PASSAGE)).union(null_id.withColumn("text", F.lit(PASSAGE)))
    assert text_dedup.keep_first(twice.union(odd)).where("doc_id is null").count() == 2
    assert text_dedup.near_duplicates(null_id).collect()[0][2]


def test_dart_agreement_is_the_weighted_similarity():
    rng = np.random.default_rng(0)
    agree, true = [], []
    for _ in range(40):
        a, b = rng.integers(0, 4, 60), rng.integers(0, 4, 60)
        rows, hashes = [], []
        for r, w in enumerate((a, b)):
            for i, n in enumerate(w):
                for j in range(n):
                    rows.append(r)
                    hashes.append(i * 100 + j + 1)
        s = text_dedup.dart_signatures(np.array(rows), text_dedup.mix(np.array(hashes, np.uint64)), 2)
        agree.append((s[0] == s[1]).mean())
        true.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(agree) - np.mean(true)) < 0.02


# ---------------------------------------------------------------- 9
BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(re.sub("[^0-9]", "", s)) <= 19 and pii.luhn(re.sub("[^0-9]", "", s))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15),
}
PERSONAL = ["mail a.b@c.de, x@y, @z.com a@b.c@d.e.f %%@a-b.c.d..e é@x.yz", "1.2.3.4 and 1.2.3.256 and 1.2.3.4.5.6.7.8 01.002.3.255 .1.2.3.4",
            "4111 1111 1111 1111 and 4111-1111-1111-1112, 5500005555555559 1 2 3", "+1 (988) 555-2485, +49 30 1234567. +1+22 333 4444 55 +123 ",
            "IBAN DE89 3704 0044 0532 0130 00 or GB82WEST12345698765432, DE88370400440532013000", "my ssn 078-05-1120" + " and so on" * 8 + "; order 078-05-1120-1 123-45-6789",
            "a" * 3000, "1" * 3000, "1." * 1500, "+" * 500 + "1 " * 900, "a@" * 800, "x@" + "a." * 900, "٣٣@a.b 1٣.2.3.4 ＋1 234 567 890", "4" * 16 + "@x.com"]


def brute_spans(text):
    return [(k, m.start(), m.end()) for k, (p, ok) in BASE.items() for m in re.finditer(p, text) if ok(m[0])]


def test_pii_base_spans(spark, medium):
    texts = {**{10_000 + i: t for i, t in enumerate([*PERSONAL, *ODD])}, **{k: r["text"] for k, r in medium.items()}}
    df = spark.createDataFrame([(k, t, "k") for k, t in texts.items()], "doc_id long, text string, kind string").repartition(4)
    found = 0
    for r in collected(pii.digest(pii.find(df))):
        want = brute_spans(texts[r["doc_id"]] or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in BASE] == [sum(w[0] == k for w in want) for k in BASE]
        assert r["spans"].startswith(joined)
        found += len(want)
    assert found > 30


def test_pii_extra_kinds_and_masking(spark, empty):
    kinds = Counter(s[0] for s in pii.spans_of(PERSONAL[4], 0.6))
    assert kinds == {"iban": 2}
    assert [s[:3] for s in pii.spans_of(PERSONAL[5], 0.6)] == [("ssn", 7, 18)]
    assert pii.masked("write a@b.cd or +1 988 555 2485!", 0.6) == "write [EMAIL] or [PHONE]!"
    df = spark.createDataFrame(rows_of(["a@b.cd", None, ""]), DOCS)
    assert [r["text"] for r in pii.redact(df).orderBy("doc_id").collect()] == ["[EMAIL]", None, ""]
    assert pii.find(empty).count() == 0


# ---------------------------------------------------------------- 10
def test_token_counts_equal_the_library(spark, odd, empty, medium):
    tok = Tokenizer.from_file(queries.BYTE_BPE)
    got = {r["doc_id"]: r for r in collected(queries.op10_token_counts(spark, MEDIUM))}
    for k, e in zip(medium, tok.encode_batch([r["text"] for r in medium.values()], add_special_tokens=False), strict=True):
        assert got[k]["n_tokens"] == len(e.ids) and got[k]["n_bytes"] == len(medium[k]["text"].encode())
        assert got[k]["over_limit"] == (len(e.ids) > 1024)
    # one by one: no text shares a batch with another's special tokens
    table = token_counts.merge_table(queries.BYTE_BPE, P.PATTERN)
    import pyarrow as pa

    from segmenta.llm.textarrays import distinct_chunks

    for t in [t for t in ODD if t]:
        arr = pa.array([t])
        chunks, codes, _, _ = distinct_chunks(arr, words=not table.may_hold_special(arr))
        assert table.counts(chunks.to_pylist())[codes].sum() == len(tok.encode(t, add_special_tokens=False).ids)
    rows = collected(token_counts.count_tokens(odd, queries.BYTE_BPE, P.PATTERN))
    assert len(rows) == odd.count() and token_counts.count_tokens(empty, queries.BYTE_BPE, P.PATTERN).count() == 0


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages(spark, odd, empty):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for df in (odd.select(*columns), empty.select(*columns)):
            out = stage(spark, df, SMALL)
            assert out.columns == columns and dict(out.dtypes) == dict(df.dtypes), name
            out.count()
        no_id = odd.select(*columns).where(F.col("text") == PASSAGE + "after").limit(1).withColumn("doc_id", F.lit(None).cast("long"))
        labelled = spark.read.parquet(f"{SMALL}/documents.parquet").select(*columns).where("doc_id < 40")
        assert stage(spark, labelled.union(no_id), SMALL).where("doc_id is null").count() == 1, name


def test_pipeline_equals_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SMALL}/documents.parquet").to_pylist()}
    texts = {k: t for k, t in docs.items() if t and regex.search(r"\p{L}", t)}
    classes = brute_classes(texts)
    texts = {k: t for k, t in texts.items() if classes[k] == k}
    texts = {k: np.frombuffer(raw, np.uint8)[~gone].tobytes().decode(errors="ignore") for k, (raw, gone) in brute_repeats(texts).items()}
    texts = {k: pii.masked(t, 0.6) for k, t in texts.items()}
    rows = collected(corpus_pipeline.run(spark, SMALL))
    assert {r["doc_id"] for r in rows} == set(texts)
    check_packing(rows, texts, 2048)
