"""Operator 7: vectors of several lengths in one table, against brute force per length."""

import numpy as np

from segmenta.llm import vector_dedup


def test_every_length_is_indexed(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "OCCUPANCY", 16)
    rng = np.random.default_rng(3)
    rows = []
    for dim, n in ((8, 60), (5, 40), (3, 12), (1, 3)):
        x = np.concatenate([rng.standard_normal(dim) + 0.02 * rng.standard_normal((n // 2, dim)), rng.standard_normal((n - n // 2, dim))])
        rows += [(100 * dim + i, v.tolist()) for i, v in enumerate(x)] + [(100 * dim + 90, x[0].tolist())]
    rows.append((9000, [1.0, 2.0]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {r[0]: tuple(r[1:]) for r in vector_dedup.near_duplicates(df, recall=1.0).collect()}
    assert len(got) == len(rows)
    for dim in {len(v) for _, v in rows}:
        ids, x = np.array([i for i, v in rows if len(v) == dim]), np.array([v for _, v in rows if len(v) == dim])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        link = (x @ x.T >= 0.95) & ~np.eye(len(x), dtype=bool)
        comp = ids.copy()
        for _ in ids:
            comp = np.minimum(comp, np.where(link, comp, 10 ** 9).min(1))
        assert [got[i] for i in ids.tolist()] == [(int(n), int(c), bool(i == c)) for i, n, c in zip(ids, link.sum(1), comp, strict=True)]
