"""Operator 11: exact sizes, gapless slots, uniform draws, awkward inputs."""

import zlib
from collections import Counter
from itertools import combinations
from math import comb

import numpy as np
import pyarrow.parquet as pq
import pytest

from segmenta.llm import queries, sharding

SMALL = "/root/testdata/sf0.001"
ROWS = "doc_id long, text string, shard string, slot string, at int, row string, block int, cell int, law string"


def check(rows, texts, shards):
    """Every (id, text) once, sizes at most one apart, slots without a gap."""
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    sizes = Counter(r["shard"] for r in rows)
    assert [sizes[j] for j in range(shards)] == [len(rows) // shards + (j < len(rows) % shards) for j in range(shards)]
    for j in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == j) == list(range(sizes[j]))
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in rows)


def test_whole_table(spark):
    t = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    check([r.asDict() for r in queries.op11_sharding(spark, SMALL).collect()], [(r["doc_id"], r["text"]) for r in t], 16)


def test_awkward_rows(spark):
    texts = [(1, "a"), (1, "a"), (1, "b"), (None, "c"), (2, None), (3, ""), (4, "ü" * 3000)]
    df = spark.createDataFrame([(i, t, "x", "y", 1, "z", 2, 3, "w") for i, t in texts], ROWS).repartition(3)
    check([r.asDict() for r in sharding.digest(df, 3).collect()], texts, 3)
    check([r.asDict() for r in sharding.digest(df, 16).collect()], texts, 16)
    kept = sharding.shuffle(df, 2)
    assert set(kept.columns) == set(df.columns) and dict(kept.dtypes)["shard"] == "int"
    none = sharding.digest(df.limit(0))
    assert none.count() == 0 and none.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_small_blocks_and_cells(spark, monkeypatch):
    """Many blocks and cells give the same laws, and the same seed the same places."""
    monkeypatch.setattr(sharding, "CELL", 16)
    df = spark.range(0, 1000, 1, 7)
    got = [{tuple(r) for r in sharding.shuffle(df, 5, seed, block_bits=4).collect()} for seed in (3, 3, 4)]
    assert got[0] == got[1] != got[2]
    for one in got:
        assert sorted(i for i, _, _ in one) == list(range(1000))
        assert sorted((j, k) for _, j, k in one) == [(j, k) for j in range(5) for k in range(200)]
    # rows of one block are spread over the shards and over the slots
    assert len({j for i, j, _ in got[0] if i < 16}) == 5 or len({k // 20 for i, _, k in got[0] if i < 60}) > 5


def test_written_shards(spark, scratch):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "doc_id long, text string").repartition(4)
    sharding.write_shards(df, f"{scratch}/out", 4, 1)
    back = spark.read.parquet(f"{scratch}/out")
    assert {(r.doc_id, r.text) for r in back.collect()} == {(i, f"t{i}") for i in range(50)}
    assert {r.shard: r["count"] for r in back.groupBy("shard").count().collect()} == {0: 13, 1: 13, 2: 12, 3: 12}


def test_matrix_has_exact_margins():
    sizes = np.array([5, 1, 0, 17, 300, 2, 40])
    for seed in range(20):
        m = sharding.Matrix(sizes, 16, seed)
        rows = np.array([m.row(k) for k in range(len(sizes))])
        again = np.array([sharding.Matrix(sizes, 16, seed).row(k) for k in reversed(range(len(sizes)))])[::-1]
        assert (rows == again).all() and (rows >= 0).all()
        assert (rows.sum(axis=1) == sizes).all() and tuple(rows.sum(axis=0)) == m.whole


@pytest.mark.parametrize("good,bad,n", [(5, 7, 6), (1, 9, 3), (40, 2, 30), (10, 10, 20), (300, 500, 120)])
def test_draws_follow_the_law(good, bad, n):
    rng, draws = np.random.default_rng(1), 20000
    got = Counter(sharding.hypergeometric(rng, good, bad, n) for _ in range(draws))
    chi = cells = 0
    for x in range(max(0, n - bad), min(n, good) + 1):
        expected = draws * comb(good, x) * comb(bad, n - x) / comb(good + bad, n)
        if expected >= 5:
            chi, cells = chi + (got[x] - expected) ** 2 / expected, cells + 1
    assert chi < cells + 5 * np.sqrt(2 * cells) + 5


def test_draws_beyond_32_bits():
    rng = np.random.default_rng(2)
    x = [sharding.hypergeometric(rng, 3 * 10**11, 10**11, 10**6) for _ in range(200)]
    assert abs(np.mean(x) - 750_000) < 200 and 250 < np.std(x) < 700


def test_every_dealing_is_equally_likely():
    """6 rows in blocks of 3, 1 and 2 into two shards: all 20 choices of the first shard's rows."""
    seen = Counter()
    sizes = np.array([3, 1, 2])
    for seed in range(6000):
        m = sharding.Matrix(sizes, 2, seed)
        dealt = np.concatenate([np.random.default_rng([seed, 1 << 32, k]).permutation(np.repeat([0, 1], m.row(k))) for k in range(3)])
        seen[tuple(np.flatnonzero(dealt == 0))] += 1
    assert set(seen) == set(combinations(range(6), 3))
    assert sum((n - 300) ** 2 / 300 for n in seen.values()) < 50  # 19 degrees of freedom
