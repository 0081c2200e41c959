"""Hand-computed edge cases (FIXTURES.md section 5)."""

import math

import pytest
from pyspark.sql import functions as F

from segmenta.functions.text import polarity
from segmenta.operators import crosstabs as X
from segmenta.operators import scaling as SC
from segmenta.operators import stats as A
from segmenta.operators import text as N


def test_empty_frame(spark):
    df = spark.createDataFrame([], "id long, p1 int")
    r = A.question_stats(df, ["p1"]).first()
    assert (r["n"], r["mean"], r["mode"], r["variance"], r["std_dev"]) == (0, 0.0, None, 0.0, 0.0)
    assert A.numeric_summary(df, ["p1"]).count() == 0


def test_single_row_variance_zero(spark):
    df = spark.createDataFrame([(1, 4)], "id long, p1 int")
    r = A.question_stats(df, ["p1"]).first()
    assert (r["mean"], r["mode"], r["variance"]) == (4.0, 4, 0.0)


def test_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, p1 int")
    r = A.question_stats(df, ["p1"]).first()
    assert r["mean"] == 0.0 and r["mode"] is None
    out = SC.minmax(df, ["p1"]).orderBy("id").collect()
    assert [x["p1"] for x in out] == [None, None]  # left untouched


def test_constant_column(spark):
    df = spark.createDataFrame([(1, 3, 1.0), (2, 3, 2.0), (3, None, 5.0)], "id long, c int, x double")
    out = SC.minmax(df, ["c", "x"]).orderBy("id").collect()
    assert [r["c"] for r in out] == [0.0, 0.0, 0.0]
    assert [r["x"] for r in out] == [0.0, 0.25, 1.0]
    corr = {(r["col_a"], r["col_b"]): r["corr"] for r in X.correlation_matrix(df, ["c", "x"]).collect()}
    assert corr[("c", "x")] is None and corr[("c", "c")] is None and corr[("x", "x")] == 1.0


def test_minmax_null_becomes_zero(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "id long, x double")
    assert [r["x"] for r in SC.minmax(df, ["x"]).orderBy("id").collect()] == [0.0, 0.0, 1.0]


def test_mode_first_seen_tie(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (3, 1), (4, 2)], "id long, p1 int")
    assert A.question_stats(df, ["p1"]).first()["mode"] == 2


def test_multi_mode(spark):
    df = spark.createDataFrame([(v,) for v in [1, 1, 2, 2, 3]], "x int")
    assert [r["mode"] for r in A.multi_mode(df, ["x"]).collect()] == [1.0, 2.0]
    eq = spark.createDataFrame([(v,) for v in [1, 2, 3]], "x int")
    assert A.multi_mode(eq, ["x"]).count() == 0  # equal frequencies -> no mode
    one = spark.createDataFrame([(v,) for v in [5, 5]], "x int")
    assert A.multi_mode(one, ["x"]).count() == 0  # a single distinct value -> no mode


def test_quartiles(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 4]], "x int")
    r = A.numeric_summary(df, ["x"]).first()
    assert (r["q1"], r["q2"], r["q3"], r["median"]) == (1.5, 2.0, 3.0, 2.0)
    assert r["variance"] == round(((1 - 7 / 3) ** 2 + (2 - 7 / 3) ** 2 + (4 - 7 / 3) ** 2) / 3, 2)


def test_unparsable_text_numbers(spark):
    df = spark.createDataFrame([("abc",), ("",), (" 5 ",), ("nan",), (None,), ("7",)], "x string")
    r = A.numeric_summary(df, ["x"]).first()
    assert r["n"] == 3  # ' 5 ', 'nan', '7' parse; 'abc', '' and null are skipped
    vals = [x[0] for x in df.select(A.parse_number("x")).collect()]
    assert vals[0] is None and vals[1] is None and vals[2] == 5.0 and math.isnan(vals[3])


def test_category_frequencies_excludes_empty(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), ("",), (None,)], "c string")
    rows = [tuple(r) for r in A.category_frequencies(df, "c").collect()]
    assert rows == [("a", 2, 66.7), ("b", 1, 33.3)]


def test_dimension_means(spark):
    df = spark.createDataFrame([(1, 1, None, 5), (2, None, None, None)], "id long, p1 int, p2 int, p3 int")
    out = A.dimension_means(df, {"T": ["p1", "p2", "p3", "p99"]}, keep=["id"]).orderBy("id").collect()
    assert [r["T"] for r in out] == [3.0, 0.0]


@pytest.mark.parametrize("text,expected", [
    ("Soy muy creativo y apasionado", 1.0),
    ("La rutina me pone triste", -1.0),
    ("Curioso pero impaciente, impaciente", (1 - 2) / 3),
    ("Los creativos aburridos", 0.0),          # substring hits: creativo (+0.5), aburrido (-0.5)
    ("Persona empática según mi opinión", 0.0),  # accented: no hit
    ("", 0.0), ("   ", 0.0), (None, 0.0), ("Sobre esta pregunta no opino", 0.0),
    ("curiosos", 1.0),                         # substring only, positive
])
def test_polarity(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(polarity("t")).first()[0] == pytest.approx(expected)


def test_tfidf_blank_corpus_is_empty(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "   ")], "id long, t string")
    assert N.tfidf_terms(df, ["t"], ["id"]).count() == 0


def test_tfidf_hand_computed(spark):
    # docs: "aa bb", "aa", "" -> n=3, df(aa)=2, df(bb)=1
    df = spark.createDataFrame([(1, "aa bb"), (2, "aa"), (3, "")], "id long, t string")
    got = {r["term"]: r["tfidf"] for r in N.tfidf_terms(df, ["t"], ["id"], stop_words=()).collect()}
    idf_a, idf_b = math.log(4 / 3) + 1, math.log(4 / 2) + 1
    n1 = math.hypot(idf_a, idf_b)
    assert got["aa"] == pytest.approx(idf_a / n1 + 1.0)
    assert got["bb"] == pytest.approx(idf_b / n1)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 10]], "x double")
    rows = A.histogram(df, "x", bins=5).collect()
    assert [r["n"] for r in rows] == [2, 1, 0, 0, 1]  # x = max falls in the last bin
    const = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [(r["lo"], r["hi"], r["n"]) for r in A.histogram(const, "x").collect()] == [(2.0, 2.0, 2)]


def test_page_info(spark):
    from segmenta.operators import filters as P
    df = spark.range(23).withColumnRenamed("id", "id")
    r = P.page_info(df, 3, 10).first()
    assert (r["total"], r["pages"], r["row_from"], r["row_to"]) == (23, 3, 21, 23)
    assert [x["id"] for x in P.page(df, 3, 10).collect()] == [20, 21, 22]
    assert P.page_count(0, 10) == 1


def test_first_seen_mode_standalone(spark):
    df = spark.createDataFrame([(3, 5, "b"), (1, 7, "a"), (2, 5, "a"), (4, 7, None)], "id long, x int, c string")
    got = {r["question"]: r["mode"] for r in A.first_seen_mode(df, ["x"], "id").collect()}
    assert got == {"x": 7}  # 5 and 7 tie (2 each); 7 is seen first (id 1)


def test_keyset_page_and_value_count_ties(spark):
    from segmenta.operators import filters as P
    df = spark.range(1, 31)
    assert [r["id"] for r in P.page_after(df, 25, size=10).collect()] == [26, 27, 28, 29, 30]
    assert [r["id"] for r in P.page_after(df, None, size=3).collect()] == [1, 2, 3]
    vc = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("c",), (None,)], "k string")
    assert [tuple(r) for r in X.value_counts(vc, "k").collect()] == [("a", 2), ("b", 2), ("c", 1)]


def test_default_themes_cover_fifteen_questions(spark):
    cols = {f"p{i}": i % 5 + 1 for i in range(1, 16)}
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{c} int" for c in cols))
    row = A.dimension_means(df).first().asDict()
    assert len(row) == 5
    assert row["Fuego (Impulso/Liderazgo)"] == pytest.approx((2 + 3 + 4) / 3)
