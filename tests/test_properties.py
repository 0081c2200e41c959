"""Randomised checks of the statistics operators against brute-force Python definitions."""

import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from segmenta.operators import crosstabs as X
from segmenta.operators import stats as A

VALUES = st.lists(st.one_of(st.none(), st.integers(min_value=1, max_value=5)), min_size=0, max_size=25)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _frame(spark, cols):
    n = max(len(v) for v in cols.values())
    rows = [(i + 1, *[(v[i] if i < len(v) else None) for v in cols.values()]) for i in range(n)]
    schema = "id long, " + ", ".join(f"{c} int" for c in cols)
    return spark.createDataFrame(rows, schema)


def _mode_first_seen(vals):
    seen = [v for v in vals if v is not None]
    if not seen:
        return None
    freq = Counter(seen)
    best = max(freq.values())
    return next(v for v in seen if freq[v] == best)


def _var_samp(vals):
    xs = [v for v in vals if v is not None]
    if len(xs) < 2:
        return 0.0
    m = sum(xs) / len(xs)
    return sum((x - m) ** 2 for x in xs) / (len(xs) - 1)


def _quantile(xs, p):
    xs = sorted(xs)
    pos = p * (len(xs) - 1)
    lo = int(pos)
    hi = min(lo + 1, len(xs) - 1)
    return xs[lo] + (pos - lo) * (xs[hi] - xs[lo])


@SETTINGS
@given(a=VALUES.filter(lambda v: len(v) > 0), b=VALUES.filter(lambda v: len(v) > 0))
def test_question_stats_matches_definition(spark, a, b):
    out = {r["question"]: r for r in A.question_stats(_frame(spark, {"a": a, "b": b}), ["a", "b"], digits=None).collect()}
    for name, vals in (("a", a), ("b", b)):
        n = len(a) if name == "a" else len(b)
        vals = vals + [None] * (max(len(a), len(b)) - n)
        xs = [v for v in vals if v is not None]
        r = out[name]
        assert r["n"] == len(xs)
        assert r["mean"] == pytest.approx(sum(xs) / len(xs) if xs else 0.0)
        assert r["mode"] == _mode_first_seen(vals)
        assert r["variance"] == pytest.approx(_var_samp(vals), abs=1e-9)


@SETTINGS
@given(a=st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=30))
def test_summary_quartiles_and_modes(spark, a):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(a)], "id long, x int")
    r = A.numeric_summary(df, ["x"], digits=6).first()
    xs = [float(v) for v in a]
    assert r["n"] == len(xs)
    for key, p in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75)):
        assert r[key] == pytest.approx(round(_quantile(xs, p), 6), abs=1e-9)
    var = 0.0 if len(xs) < 2 else sum((x - sum(xs) / len(xs)) ** 2 for x in xs) / len(xs)
    assert r["variance"] == pytest.approx(round(var, 6), abs=1e-6)
    freq = Counter(xs)
    modes = sorted(v for v, c in freq.items() if c == max(freq.values()))
    want = None if len(modes) == len(freq) else modes
    got = [m["mode"] for m in A.multi_mode(df, ["x"]).collect()] or None
    assert got == want
    assert r["mode_count"] == (len(want) if want else None)


@SETTINGS
@given(x=st.lists(st.one_of(st.none(), st.floats(min_value=-100, max_value=100, allow_nan=False)), min_size=2,
                  max_size=20),
       y=st.lists(st.one_of(st.none(), st.floats(min_value=-100, max_value=100, allow_nan=False)), min_size=2,
                  max_size=20))
def test_correlation_pairwise_complete(spark, x, y):
    n = min(len(x), len(y))
    df = spark.createDataFrame([(x[i], y[i]) for i in range(n)], "x double, y double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in X.correlation_matrix(df, ["x", "y"]).collect()}
    pairs = [(x[i], y[i]) for i in range(n) if x[i] is not None and y[i] is not None]
    want = None
    if len(pairs) >= 1:
        mx = sum(p[0] for p in pairs) / len(pairs)
        my = sum(p[1] for p in pairs) / len(pairs)
        sxx = sum((p[0] - mx) ** 2 for p in pairs)
        syy = sum((p[1] - my) ** 2 for p in pairs)
        sxy = sum((p[0] - mx) * (p[1] - my) for p in pairs)
        if sxx > 1e-12 and syy > 1e-12:
            want = sxy / math.sqrt(sxx * syy)
    if want is None:
        assert got[("x", "y")] is None or abs(got[("x", "y")]) <= 1 + 1e-9
    else:
        assert got[("x", "y")] == pytest.approx(want, abs=1e-6)
        assert got[("y", "x")] == got[("x", "y")]
