"""Queries that profile or assign by every component or question, against a version in plain Python."""

from collections import Counter, defaultdict

import __spark_entry__ as E
import pytest
from data_paths import SMALL

from segmenta.fixtures import LIKERT, survey_view
from segmenta.tables import table


def test_profile_has_all_components(spark):
    got = {(r["cluster"], r["feature"]): r["mean"] for r in E.queries()["cluster_profile_long_all"](spark, SMALL).collect()}
    vectors = defaultdict(list)
    for r in table(spark, SMALL, "embeddings").collect():
        if r["label"] is not None:
            vectors[r["label"]].append(r["embedding"])
    assert {len(v) for vs in vectors.values() for v in vs} == {64}
    want = {(k, f"e{i}"): sum(v[i] for v in vs) / len(vs) for k, vs in vectors.items() for i in range(64)}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=2e-6) for k in want)


def test_signs_by_clusters_of_all_questions(spark):
    got = {(r["Cluster"], r["signo"]): r["n"] for r in E.queries()["report_sign_by_cluster_all"](spark, SMALL).collect()}
    want = Counter()
    for r in survey_view(spark, SMALL).collect():
        d = [sum(((r[c] or 0) - level) ** 2 for c in LIKERT) for level in (1, 3, 5)]
        if r["signo"] is not None:
            want[d.index(min(d)), r["signo"]] += 1
    assert got == dict(want)
