"""Registered queries: each builds a DataFrame from the driver's tables with the
library's operators, paired with DuckDB SQL that states the same semantics.

Every double leaving a query is rounded to 6 digits on both sides (value-hash
hygiene); counts are bigint on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import LIKERT, OPEN, survey_view, with_survey
from ..operators import crosstabs as X
from ..operators import filters as P
from ..operators import stats as A
from ..operators._util import round_doubles
from ..tables import spread, table
from .registry import ORACLE, QUERIES, query  # noqa: F401

R6 = round_doubles


def _cols(xs):
    return ", ".join(xs)


# ============================================================ A1-A5 question stats
_P = _cols(LIKERT)

query_sql_question_stats = with_survey(f"""
, long AS (SELECT id, question, value FROM survey_view UNPIVOT (value FOR question IN ({_P})))
, mom AS (SELECT question, count(value) AS n, coalesce(avg(value), 0.0) AS mean,
                 coalesce(var_samp(value), 0.0) AS variance FROM long GROUP BY question)
, cnt AS (SELECT question, value, count(*) AS n, min(id) AS f FROM long GROUP BY question, value)
, md AS (SELECT question, value AS mode FROM (
           SELECT *, row_number() OVER (PARTITION BY question ORDER BY n DESC, f ASC) AS rn FROM cnt) WHERE rn = 1)
SELECT m.question, m.n, round(m.mean, 3) AS mean, md.mode, round(m.variance, 3) AS variance,
       round(sqrt(m.variance), 3) AS std_dev
FROM mom m LEFT JOIN md USING (question)""").replace("WITH survey_view AS", "WITH survey_view AS", 1)


@query("question_stats", query_sql_question_stats)
def q_question_stats(spark, d):
    return A.question_stats(survey_view(spark, d), LIKERT, order_col="id", digits=3)


@query("question_stats_part", """
WITH long AS (SELECT p_partkey AS id, question, value FROM
                (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part)
                UNPIVOT (value FOR question IN (p_size, p_retailprice)))
, mom AS (SELECT question, count(value) AS n, coalesce(avg(value), 0.0) AS mean,
                 coalesce(var_samp(value), 0.0) AS variance FROM long GROUP BY question)
, cnt AS (SELECT question, value, count(*) AS n, min(id) AS f FROM long GROUP BY question, value)
, md AS (SELECT question, value AS mode FROM (
           SELECT *, row_number() OVER (PARTITION BY question ORDER BY n DESC, f ASC) AS rn FROM cnt) WHERE rn = 1)
SELECT m.question, m.n, round(m.mean, 3) AS mean, md.mode, round(m.variance, 3) AS variance,
       round(sqrt(m.variance), 3) AS std_dev
FROM mom m LEFT JOIN md USING (question)""")
def q_question_stats_part(spark, d):
    part = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"),
                                          "p_retailprice")
    return A.question_stats(part, ["p_size", "p_retailprice"], order_col="p_partkey", digits=3)


# ============================================================ A6 dimension means
def _row_mean_sql(cols):
    tot = " + ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0)" for c in cols)
    cnt = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols)
    return f"CASE WHEN ({cnt}) = 0 THEN 0.0 ELSE round(({tot}) / ({cnt}), 6) END"


@query("dimension_means", with_survey("SELECT id, " + ", ".join(
    f'{_row_mean_sql(cols)} AS "{name}"' for name, cols in A.DEFAULT_THEMES.items()) + " FROM survey_view"))
def q_dimension_means(spark, d):
    return R6(A.dimension_means(survey_view(spark, d), keep=["id"]))


# ============================================================ A7 basic stats
_LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("basic_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 2) AS mean, round(stddev_samp({c}), 2) AS std, "
    f"round(CAST(min({c}) AS DOUBLE), 2) AS min, round(CAST(max({c}) AS DOUBLE), 2) AS max FROM lineitem"
    for c in _LI))
def q_basic_stats(spark, d):
    return A.basic_stats(table(spark, d, "lineitem"), _LI + ["not_a_column"], digits=2)


# ============================================================ A8-A15 numeric summary
def _summary_sql(tbl, cols):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", count(v) AS n, round(avg(v), 2) AS mean,
  round(quantile_cont(v, 0.5), 2) AS median,
  round(CASE WHEN count(v) < 2 THEN 0.0 ELSE var_pop(v) END, 2) AS variance,
  round(CASE WHEN count(v) < 2 THEN 0.0 ELSE stddev_pop(v) END, 2) AS std_dev,
  min(v) AS min, max(v) AS max, max(v) - min(v) AS range,
  round(quantile_cont(v, 0.25), 2) AS q1, round(quantile_cont(v, 0.5), 2) AS q2,
  round(quantile_cont(v, 0.75), 2) AS q3
FROM (SELECT TRY_CAST({c} AS DOUBLE) AS v FROM {tbl}) HAVING count(v) > 0""")
    modes = _multi_mode_sql(tbl, cols)
    return (f"WITH s AS ({' UNION ALL '.join(parts)}), mm AS ({modes}) "
            f"SELECT s.*, mc.mode_count FROM s LEFT JOIN "
            f'(SELECT "column", count(*) AS mode_count FROM mm GROUP BY "column") mc USING ("column")')


def _multi_mode_sql(tbl, cols):
    unions = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", TRY_CAST({c} AS DOUBLE) AS value FROM {tbl}"
                                for c in cols)
    return f"""SELECT "column", value AS mode FROM (
  SELECT "column", value, n, max(n) OVER (PARTITION BY "column") AS mx, min(n) OVER (PARTITION BY "column") AS mn
  FROM (SELECT "column", value, count(*) AS n FROM ({unions}) WHERE value IS NOT NULL GROUP BY "column", value))
WHERE n = mx AND mx > mn"""


@query("numeric_summary", _summary_sql("lineitem", _LI))
def q_numeric_summary(spark, d):
    return R6(A.numeric_summary(table(spark, d, "lineitem"), _LI))


@query("multi_mode", _multi_mode_sql("part", ["p_size", "p_retailprice"]))
def q_multi_mode(spark, d):
    return A.multi_mode(table(spark, d, "part"), ["p_size", "p_retailprice"])


@query("multi_mode_lineitem", _multi_mode_sql("lineitem", ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]))
def q_multi_mode_lineitem(spark, d):
    return A.multi_mode(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax", "l_extendedprice"])


@query("column_bounds", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"
    for c in _LI))
def q_column_bounds(spark, d):
    return R6(A.column_bounds(table(spark, d, "lineitem"), _LI))


@query("survey_age_bounds", with_survey(
    "SELECT 'edad' AS \"column\", CAST(min(edad) AS DOUBLE) AS min, CAST(max(edad) AS DOUBLE) AS max FROM survey_view"))
def q_survey_age_bounds(spark, d):
    return A.column_bounds(survey_view(spark, d), ["edad"])


# ============================================================ A16, A17 frequencies
@query("category_frequencies", """
SELECT o_orderpriority AS value, count(*) AS conteo,
       round(count(*) * 100.0 / (SELECT count(*) FROM orders WHERE o_orderpriority IS NOT NULL
                                  AND o_orderpriority <> ''), 1) AS porcentaje
FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderpriority <> '' GROUP BY o_orderpriority""")
def q_category_frequencies(spark, d):
    return A.category_frequencies(table(spark, d, "orders"), "o_orderpriority")


@query("survey_sign_frequencies", with_survey("""
SELECT signo AS value, count(*) AS conteo,
       round(count(*) * 100.0 / (SELECT count(*) FROM survey_view WHERE signo IS NOT NULL AND signo <> ''), 1)
         AS porcentaje
FROM survey_view WHERE signo IS NOT NULL AND signo <> '' GROUP BY signo"""))
def q_survey_sign_frequencies(spark, d):
    return A.category_frequencies(survey_view(spark, d), "signo")


@query("value_counts", "SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def q_value_counts(spark, d):
    return X.value_counts(table(spark, d, "events"), "event_type")


@query("sign_counts", with_survey(
    "SELECT signo, count(*) AS n FROM survey_view WHERE signo IS NOT NULL GROUP BY signo"))
def q_sign_counts(spark, d):
    return X.value_counts(survey_view(spark, d), "signo")


# ============================================================ A18-A22, A28
@query("group_pair_counts", """
SELECT event_type, CAST(user_id % 10 AS BIGINT) AS user_bucket, count(*) AS n
FROM events GROUP BY event_type, user_id % 10""")
def q_group_pair_counts(spark, d):
    ev = table(spark, d, "events").select("event_type", (F.col("user_id") % 10).alias("user_bucket"))
    return X.group_pair_counts(ev, "event_type", "user_bucket")


_COMPONENTS = [f"e{i}" for i in range(64)]  # all of an embedding


_PROFILE_SQL = f"""
SELECT label AS cluster, feature, round(mean, 6) AS mean FROM (
  SELECT label, {_cols(f"avg(CAST(embedding[{i + 1}] AS DOUBLE)) AS {c}" for i, c in enumerate(_COMPONENTS))}
  FROM embeddings WHERE label IS NOT NULL GROUP BY label)
UNPIVOT (mean FOR feature IN ({_cols(_COMPONENTS)}))"""


@query("cluster_profile_long", _PROFILE_SQL)
@query("cluster_profile_long_all", _PROFILE_SQL)
def q_cluster_profile_long_all(spark, d):
    emb = table(spark, d, "embeddings").select(
        F.col("label").alias("Cluster"), *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(_COMPONENTS)])
    return R6(X.cluster_profile_long(emb, _COMPONENTS))


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "const_one"]


def _corr_sql(base: str, cols: list[str]) -> str:
    rows = []
    for a in cols:
        for b in cols:
            if a == b:
                rows.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
                            f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0 END AS corr FROM {base}")
            else:
                rows.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
                            f"CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 "
                            f"THEN round(covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})), 6) END AS corr "
                            f"FROM {base} WHERE {a} IS NOT NULL AND {b} IS NOT NULL")
    return " UNION ALL ".join(rows)


@query("correlation_matrix", _corr_sql(
    "(SELECT CAST(l_quantity AS DOUBLE) AS l_quantity, l_extendedprice, l_discount, l_tax, "
    "CAST(l_linenumber AS DOUBLE) AS l_linenumber, 1.0 AS const_one FROM lineitem)", _CORR))
def q_correlation_matrix(spark, d):
    li = table(spark, d, "lineitem").withColumn("const_one", F.lit(1.0))
    return R6(X.correlation_matrix(li, _CORR))


@query("survey_correlation", with_survey(_corr_sql("survey_view", LIKERT)))
def q_survey_correlation(spark, d):
    return R6(X.correlation_matrix(survey_view(spark, d), LIKERT))


@query("cluster_sizes_shares", """
SELECT l_returnflag AS cluster, count(*) AS n,
       round(count(*) * 100.0 / (SELECT count(*) FROM lineitem WHERE l_returnflag IS NOT NULL), 1) AS share
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag""")
def q_cluster_sizes_shares(spark, d):
    return X.cluster_sizes_shares(table(spark, d, "lineitem"), "l_returnflag")


@query("dominant_minority", """
WITH c AS (SELECT l_returnflag AS cluster, count(*) AS n FROM lineitem WHERE l_returnflag IS NOT NULL
           GROUP BY l_returnflag)
SELECT (SELECT cluster FROM c ORDER BY n DESC, cluster LIMIT 1) AS dominant, max(n) AS dominant_n,
       round(max(n) * 100.0 / sum(n), 1) AS dominant_share,
       (SELECT cluster FROM c ORDER BY n ASC, cluster LIMIT 1) AS minority, min(n) AS minority_n,
       round(min(n) * 100.0 / sum(n), 1) AS minority_share, count(*) AS clusters
FROM c""")
def q_dominant_minority(spark, d):
    return X.dominant_minority(table(spark, d, "lineitem"), "l_returnflag")


@query("total_count", "SELECT count(*) AS n FROM lineitem")
def q_total_count(spark, d):
    return A.total_count(table(spark, d, "lineitem"))


# ============================================================ A24-A26 EDA
_EDA = ["l_quantity", "l_extendedprice", "l_discount"]


@query("eda_numeric", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean,
    round(quantile_cont({c}, 0.5), 6) AS median, round(var_pop({c}), 6) AS variance,
    round(stddev_pop({c}), 6) AS std_dev, round(max({c}) - min({c}), 6) AS range,
    round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM lineitem"""
    for c in _EDA))
def q_eda_numeric(spark, d):
    return R6(A.eda_numeric(table(spark, d, "lineitem"), _EDA))


@query("eda_categorical", """
SELECT "column", value, count(*) AS n FROM (
  SELECT 'l_returnflag' AS "column", l_returnflag AS value FROM lineitem
  UNION ALL SELECT 'l_linestatus', l_linestatus FROM lineitem) WHERE value IS NOT NULL GROUP BY "column", value""")
def q_eda_categorical(spark, d):
    return A.eda_categorical(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("histogram", """
WITH b AS (SELECT min(value) AS mn, max(value) AS mx FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
bins AS (SELECT unnest(range(0, CASE WHEN mx > mn THEN 10 ELSE 1 END)) AS bin, mn, mx FROM b),
c AS (SELECT CASE WHEN b.mx > b.mn THEN least(CAST(floor((value - b.mn) / ((b.mx - b.mn) / 10)) AS INTEGER), 9)
                  ELSE 0 END AS bin, count(*) AS n
      FROM events, b WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY 1)
SELECT CAST(bins.bin AS INTEGER) AS bin,
       round(CASE WHEN mx > mn THEN mn + bins.bin * ((mx - mn) / 10) ELSE mn END, 6) AS lo,
       round(CASE WHEN mx > mn THEN (CASE WHEN bins.bin = 9 THEN mx ELSE mn + (bins.bin + 1) * ((mx - mn) / 10) END)
                  ELSE mx END, 6) AS hi,
       coalesce(c.n, 0) AS n
FROM bins LEFT JOIN c ON c.bin = bins.bin""")
def q_histogram(spark, d):
    return R6(A.histogram(table(spark, d, "events"), "value", bins=10))


@query("relative_profile", """
WITH m AS (SELECT avg(l_quantity) AS l_quantity, avg(l_discount) AS l_discount, avg(l_tax) AS l_tax FROM lineitem),
t AS (SELECT *, CASE WHEN greatest(l_quantity, l_discount, l_tax) = 0 THEN 1.0
                     ELSE greatest(l_quantity, l_discount, l_tax) END AS top FROM m)
SELECT 'l_quantity' AS "column", round(l_quantity, 6) AS mean, round(l_quantity / top * 100.0, 6) AS relative FROM t
UNION ALL SELECT 'l_discount', round(l_discount, 6), round(l_discount / top * 100.0, 6) FROM t
UNION ALL SELECT 'l_tax', round(l_tax, 6), round(l_tax / top * 100.0, 6) FROM t""")
def q_relative_profile(spark, d):
    return R6(A.relative_profile(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"]))


# ============================================================ P filters, pickers, pages
@query("filter_range_category", with_survey("""
SELECT id, edad, genero, signo FROM survey_view
WHERE edad BETWEEN 25 AND 60 AND genero = 'AUTOMOBILE'"""))
def q_filter_range_category(spark, d):
    df = P.filter_survey(survey_view(spark, d), edad=(25, 60), genero="AUTOMOBILE", signo=P.ALL)
    return df.select("id", "edad", "genero", "signo")


@query("filter_sign", with_survey("""
SELECT id, edad, genero, signo FROM survey_view WHERE signo = 'Leo'"""))
def q_filter_sign(spark, d):
    return P.filter_survey(survey_view(spark, d), signo="Leo").select("id", "edad", "genero", "signo")


@query("category_filter", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def q_category_filter(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return P.filter_equals(o, "o_orderstatus", "F")


@query("category_filter_absent", "SELECT o_orderkey, o_orderstatus FROM orders WHERE false")
def q_category_filter_absent(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return P.filter_equals(o, "elemento", "Fuego")


@query("distinct_first_seen", with_survey(
    "SELECT signo AS value, min(id) AS first_seen FROM survey_view GROUP BY signo"))
def q_distinct_first_seen(spark, d):
    return P.distinct_first_seen(survey_view(spark, d), "signo", "id")


@query("distinct_first_seen_age", with_survey(
    "SELECT edad AS value, min(id) AS first_seen FROM survey_view GROUP BY edad"))
def q_distinct_first_seen_age(spark, d):
    return P.distinct_first_seen(survey_view(spark, d), "edad", "id")


@query("distinct_sorted", """
SELECT DISTINCT o_orderpriority AS value FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderpriority <> ''""")
def q_distinct_sorted(spark, d):
    return P.distinct_sorted(table(spark, d, "orders"), "o_orderpriority")


@query("page_of_records", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 25 OFFSET 50""")
def q_page_of_records(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return P.page(o, page_no=3, size=25, order_col="o_orderkey")


@query("page_keyset", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 100""")
def q_page_keyset(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return P.page_after(o, 1000, size=100, order_col="o_orderkey")


@query("page_info", """
SELECT count(*) AS total, CAST(greatest(1, ceil(count(*) / 50.0)) AS BIGINT) AS pages,
       CAST(CASE WHEN count(*) = 0 THEN 0 ELSE least(count(*), 101) END AS BIGINT) AS row_from,
       CAST(least(count(*), 150) AS BIGINT) AS row_to FROM orders""")
def q_page_info(spark, d):
    return P.page_info(table(spark, d, "orders"), page_no=3, size=50)


@query("numeric_matrix", with_survey(
    f"SELECT id, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in LIKERT)} FROM survey_view "
    f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in LIKERT)}"))
def q_numeric_matrix(spark, d):
    return P.numeric_matrix(survey_view(spark, d), LIKERT, key="id")


@query("scatter_series", """
SELECT label AS cluster, round(coalesce(CAST(embedding[1] AS DOUBLE), 0.0), 6) AS x,
       round(coalesce(CAST(embedding[2] AS DOUBLE), 0.0), 6) AS y FROM embeddings""")
def q_scatter_series(spark, d):
    emb = table(spark, d, "embeddings").select(F.col("label").alias("Cluster"),
                                               F.col("embedding")[0].alias("e0"), F.col("embedding")[1].alias("e1"))
    return R6(P.scatter_series(emb, ["e0", "e1"]))


@query("rendered_table", with_survey(
    "SELECT coalesce(CAST(id AS VARCHAR), '-') AS id, coalesce(CAST(edad AS VARCHAR), '-') AS edad, "
    "coalesce(signo, '-') AS signo, coalesce(p1a, '-') AS p1a FROM survey_view"))
def q_rendered_table(spark, d):
    return P.rendered(survey_view(spark, d), ["id", "edad", "signo", "p1a"])


@query("quantitative_export", with_survey(f"SELECT id, edad, {_P} FROM survey_view"))
def q_quantitative_export(spark, d):
    return P.select_present(survey_view(spark, d), ["id", "edad"] + LIKERT + ["Cluster"])


# ============================================================ U1, N1-N5 text
from ..functions.lexicon import NEGATIVE_TEST, POSITIVE_TEST, STOP_WORDS_ES  # noqa: E402
from ..functions.text import polarity_sql  # noqa: E402
from ..operators import text as N  # noqa: E402

_OPEN = _cols(OPEN)


@query("corpus_union", with_survey(
    f"SELECT id, field, text FROM survey_view UNPIVOT (text FOR field IN ({_OPEN}))"))
def q_corpus_union(spark, d):
    return N.corpus(survey_view(spark, d), OPEN, ["id"])


@query("sentiment_rows", with_survey(
    "SELECT id, " + ", ".join(f"round({polarity_sql(c)}, 6) AS {c}_polaridad" for c in OPEN)
    + ", round((" + " + ".join(polarity_sql(c) for c in OPEN) + f") / {len(OPEN)}, 6) AS sentimiento_promedio "
    "FROM survey_view"))
def q_sentiment_rows(spark, d):
    return R6(N.sentiment_rows(survey_view(spark, d, dealt=True), OPEN, keep=["id"]))


@query("sentiment_by_group", with_survey(
    "SELECT signo, round(avg(s), 6) AS polaridad_media, count(*) AS n FROM (SELECT signo, ("
    + " + ".join(polarity_sql(c) for c in OPEN) + f") / {len(OPEN)} AS s FROM survey_view) "
    "WHERE signo IS NOT NULL GROUP BY signo"))
def q_sentiment_by_group(spark, d):
    scored = N.sentiment_rows(survey_view(spark, d, dealt=True), OPEN, keep=["signo"])
    return R6(N.sentiment_by_group(scored, "signo"))


_PT, _NT = list(POSITIVE_TEST), list(NEGATIVE_TEST)


@query("sentiment_documents",
       f"SELECT doc_id, lang, round({polarity_sql('text', _PT, _NT)}, 6) AS text_polaridad FROM documents")
def q_sentiment_documents(spark, d):
    docs = table(spark, d, "documents")
    return R6(N.sentiment_rows(docs, ["text"], keep=["doc_id", "lang"], positive=_PT, negative=_NT)
              .drop("sentimiento_promedio"))


@query("sentiment_by_lang",
       f"SELECT lang, round(avg({polarity_sql('text', _PT, _NT)}), 6) AS polaridad_media, count(*) AS n "
       "FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def q_sentiment_by_lang(spark, d):
    scored = N.sentiment_rows(table(spark, d, "documents"), ["text"], keep=["lang"], positive=_PT, negative=_NT)
    return R6(N.sentiment_by_group(scored, "lang"))


def _tfidf_sql(docs_sql: str, k: int = 10, stop=STOP_WORDS_ES) -> str:
    sw = ", ".join(f"'{w}'" for w in stop)
    stop_clause = f"WHERE term NOT IN ({sw})" if stop else ""
    return f"""WITH docs AS ({docs_sql}),
nd AS (SELECT count(*) AS n FROM docs),
toks AS (SELECT doc, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM docs),
tf AS (SELECT doc, term, count(*) AS tf FROM toks {stop_clause} GROUP BY doc, term),
vocab AS (SELECT term FROM tf GROUP BY term ORDER BY sum(tf) DESC, term LIMIT {k}),
tfv AS (SELECT tf.* FROM tf JOIN vocab USING (term)),
dfq AS (SELECT term, count(*) AS df FROM tfv GROUP BY term),
w AS (SELECT doc, term, tf * (ln((1 + nd.n) / (1 + df)) + 1) AS w FROM tfv JOIN dfq USING (term), nd),
wn AS (SELECT term, w / sqrt(sum(w * w) OVER (PARTITION BY doc)) AS wn FROM w)
SELECT term, round(sum(wn), 6) AS tfidf FROM wn GROUP BY term"""


@query("tfidf_terms", with_survey(_tfidf_sql(
    f"SELECT id || ':' || field AS doc, text FROM survey_view UNPIVOT (text FOR field IN ({_OPEN}))")))
def q_tfidf_terms(spark, d):
    return R6(N.tfidf_terms(survey_view(spark, d, dealt=True), OPEN, ["id"], max_features=10))


@query("tfidf_documents", _tfidf_sql("SELECT CAST(doc_id AS VARCHAR) AS doc, text FROM documents "
                                     "WHERE text IS NOT NULL", k=10, stop=()))
def q_tfidf_documents(spark, d):
    return R6(N.tfidf_terms(table(spark, d, "documents"), ["text"], ["doc_id"], max_features=10, stop_words=()))


@query("tfidf_conversations", _tfidf_sql(
    "SELECT conv_id || ':' || turn AS doc, text FROM conversations WHERE text IS NOT NULL", k=10))
def q_tfidf_conversations(spark, d):
    return R6(N.tfidf_terms(table(spark, d, "conversations"), ["text"], ["conv_id", "turn"], max_features=10))


# ============================================================ M1, M2, M9, M15, M8
from ..operators import evaluate as EV  # noqa: E402
from ..operators import scaling as SC  # noqa: E402
from ..operators.cluster import assign as AS  # noqa: E402


def _minmax_sql(src: str, keys: list[str], cols: list[str]) -> str:
    b = ", ".join(f"CAST(min({c}) AS DOUBLE) AS {c}__lo, CAST(max({c}) AS DOUBLE) AS {c}__hi" for c in cols)
    sel = ", ".join(
        f"CASE WHEN b.{c}__lo IS NULL THEN {c} WHEN b.{c}__hi = b.{c}__lo THEN 0.0 WHEN {c} IS NULL THEN 0.0 "
        f"ELSE (CAST({c} AS DOUBLE) - b.{c}__lo) / (b.{c}__hi - b.{c}__lo) END AS {c}" for c in cols)
    return f"SELECT {', '.join(keys)}, {sel} FROM ({src}) s, (SELECT {b} FROM ({src})) b"


_PART_XY = ["p_size", "p_retailprice"]
_PART_SRC = "SELECT p_partkey, p_size, p_retailprice FROM part"
# Fixed test centroids in min-max units of (p_size, p_retailprice).
_CENTROIDS = [(0.2, 0.2), (0.5, 0.8), (0.8, 0.3)]


def _part_minmax(spark, d):
    part = table(spark, d, "part").select("p_partkey", *_PART_XY)
    return SC.minmax(part, _PART_XY)


@query("minmax_survey", with_survey(
    "SELECT id, " + ", ".join(f"round({c}, 6) AS {c}" for c in LIKERT) + " FROM ("
    + _minmax_sql("SELECT * FROM survey_view", ["id"], LIKERT) + ")"))
def q_minmax_survey(spark, d):
    return R6(SC.minmax(survey_view(spark, d).select("id", *LIKERT), LIKERT))


@query("minmax_part", "SELECT p_partkey, round(p_size, 6) AS p_size, round(p_retailprice, 6) AS p_retailprice FROM ("
       + _minmax_sql(_PART_SRC, ["p_partkey"], _PART_XY) + ")")
def q_minmax_part(spark, d):
    return R6(_part_minmax(spark, d))


_STD = ["l_quantity", "l_discount", "l_tax"]


@query("standardise", "WITH m AS (SELECT " + ", ".join(
    f"avg({c}) AS {c}__mu, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS {c}__sd" for c in _STD)
    + " FROM lineitem) SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round((CAST({c} AS DOUBLE) - m.{c}__mu) / m.{c}__sd, 6) AS {c}" for c in _STD) + " FROM lineitem, m")
def q_standardise(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *_STD)
    return R6(SC.standardise(li, _STD))


def _dist_sql(cols, cents):
    ds = []
    for c in cents:
        ds.append(" + ".join(f"(CAST({f} AS DOUBLE) - {float(v)!r}) * (CAST({f} AS DOUBLE) - {float(v)!r})"
                             for f, v in zip(cols, c)))
    return ds


def _assign_sql(src, key, cols, cents):
    ds = _dist_sql(cols, cents)
    dl = ", ".join(f"{e} AS d{i}" for i, e in enumerate(ds))
    least = "least(" + ", ".join(f"d{i}" for i in range(len(ds))) + ")"
    case = "CASE " + " ".join(f"WHEN d{i} = {least} THEN {i}" for i in range(len(ds))) + " END"
    return f"SELECT {key}, {', '.join(cols)}, {case} AS Cluster, {least} AS d2 FROM (SELECT *, {dl} FROM ({src}))"


_PART_MM_SQL = _minmax_sql(_PART_SRC, ["p_partkey"], _PART_XY)


@query("assign_nearest", f"SELECT p_partkey, CAST(Cluster AS INTEGER) AS Cluster, round(d2, 6) AS d2 FROM ("
       + _assign_sql(_PART_MM_SQL, "p_partkey", _PART_XY, _CENTROIDS) + ")")
def q_assign_nearest(spark, d):
    out = AS.assign_nearest(_part_minmax(spark, d), _PART_XY, _CENTROIDS, distance_col="d2")
    return R6(out.select("p_partkey", "Cluster", "d2"))


@query("inertia_given_centroids", "SELECT round(sum(d2), 6) AS inertia FROM ("
       + _assign_sql(_PART_MM_SQL, "p_partkey", _PART_XY, _CENTROIDS) + ")")
def q_inertia_given_centroids(spark, d):
    return R6(AS.inertia(_part_minmax(spark, d), _PART_XY, _CENTROIDS))


def _silhouette_sql(points_sql: str, cols: list[str], mode: str = "exact") -> str:
    dist = ("sqrt(" if mode == "exact" else "(") + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in cols) + ")"
    keys = ", ".join(f"a.{c}" for c in cols)
    return f"""WITH pts AS (SELECT {', '.join(cols)}, label, count(*) AS w FROM ({points_sql}) GROUP BY ALL),
sizes AS (SELECT label, sum(w) AS n FROM pts GROUP BY label),
s AS (SELECT {keys}, a.label AS own, a.w AS w, b.label AS other, sum(b.w * {dist}) AS sd
      FROM pts a, pts b GROUP BY {keys}, a.label, a.w, b.label),
p AS (SELECT s.*, z.n AS n_other, zo.n AS n_own FROM s JOIN sizes z ON z.label = s.other
      JOIN sizes zo ON zo.label = s.own),
per AS (SELECT {', '.join(cols)}, own, w, n_own,
          max(CASE WHEN other = own THEN sd / greatest(n_own - 1, 1) END) AS a,
          min(CASE WHEN other <> own THEN sd / n_other END) AS b FROM p GROUP BY ALL),
sc AS (SELECT w, CASE WHEN n_own > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0.0 END AS s
       FROM per)
SELECT 'silhouette_{mode}' AS metric,
       round(CASE WHEN (SELECT count(*) FROM sizes) > 1 THEN sum(s * w) / sum(w) ELSE 0.0 END, 6) AS value FROM sc"""


_PART_LABELS_SQL = ("SELECT p_size, p_retailprice, Cluster AS label FROM ("
                    + _assign_sql(_PART_MM_SQL, "p_partkey", _PART_XY, _CENTROIDS) + ")")


@query("silhouette_exact", _silhouette_sql(_PART_LABELS_SQL, _PART_XY))
def q_silhouette_exact(spark, d):
    labelled = AS.assign_nearest(_part_minmax(spark, d), _PART_XY, _CENTROIDS)
    return R6(EV.silhouette(labelled, _PART_XY, "Cluster", mode="exact"))


# ============================================================ M4 DBSCAN, A28
from ..operators.cluster import dbscan as DB  # noqa: E402

_DB_EPS, _DB_MIN = 0.025, 4


def _dbscan_sql(points_sql: str, key: str, cols: list[str], eps: float, min_samples: int) -> str:
    dist = "sqrt(" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in cols) + ")"
    on = " AND ".join(f"p.{c} = v.{c}" for c in cols)
    return f"""WITH RECURSIVE pts AS ({points_sql}),
vec AS (SELECT {', '.join(cols)}, count(*) AS w, min({key}) AS vid FROM pts GROUP BY {', '.join(cols)}),
pairs AS (SELECT a.vid AS i, b.vid AS j, b.w AS wj FROM vec a JOIN vec b ON {dist} <= {eps!r}),
core AS (SELECT i AS vid FROM pairs GROUP BY i HAVING sum(wj) >= {min_samples}),
cedges AS (SELECT p.i, p.j FROM pairs p JOIN core c1 ON c1.vid = p.i JOIN core c2 ON c2.vid = p.j WHERE p.i <> p.j),
cc(vid, lab) AS (SELECT vid, vid FROM core UNION SELECT e.j, cc.lab FROM cc JOIN cedges e ON e.i = cc.vid),
comp AS (SELECT vid, min(lab) AS comp FROM cc GROUP BY vid),
num AS (SELECT comp, CAST(dense_rank() OVER (ORDER BY comp) - 1 AS BIGINT) AS cl FROM (SELECT DISTINCT comp FROM comp)),
corelab AS (SELECT c.vid, n.cl FROM comp c JOIN num n USING (comp)),
border AS (SELECT p.i AS vid, min(l.cl) AS cl FROM pairs p JOIN corelab l ON l.vid = p.j
           WHERE p.i NOT IN (SELECT vid FROM core) GROUP BY p.i),
lab AS (SELECT vid, cl FROM corelab UNION ALL SELECT vid, cl FROM border)
SELECT p.{key}, CAST(coalesce(l.cl, -1) AS BIGINT) AS Cluster
FROM pts p JOIN vec v ON {on} LEFT JOIN lab l ON l.vid = v.vid"""


_DB_SQL = _dbscan_sql(_PART_MM_SQL, "p_partkey", _PART_XY, _DB_EPS, _DB_MIN)


def _part_dbscan(spark, d):
    return DB.dbscan(_part_minmax(spark, d), _PART_XY, eps=_DB_EPS, min_samples=_DB_MIN, key="p_partkey")


@query("dbscan_labels", _DB_SQL)
def q_dbscan_labels(spark, d):
    return _part_dbscan(spark, d)


_SURVEY_MM_SQL = with_survey("SELECT * FROM (" + _minmax_sql(f"SELECT id, {_P} FROM survey_view", ["id"], LIKERT)
                             + ") WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in LIKERT))


@query("dbscan_survey", _dbscan_sql(_SURVEY_MM_SQL, "id", LIKERT, 1.5, 5))
def q_dbscan_survey(spark, d):
    """The batch setting: 15 answers, eps wider than any single dimension."""
    return DB.dbscan(SC.minmax(survey_view(spark, d).select("id", *LIKERT), LIKERT), LIKERT, eps=1.5, min_samples=5)


@query("noise_count", "SELECT CAST(count_if(Cluster = -1) AS BIGINT) AS noise_points FROM (" + _DB_SQL.replace(
    "WITH RECURSIVE", "WITH RECURSIVE", 1) + ")")
def q_noise_count(spark, d):
    return X.noise_count(_part_dbscan(spark, d))


@query("dbscan_cluster_sizes", "SELECT Cluster AS cluster, count(*) AS n, "
       "round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS share FROM (" + _DB_SQL + ") GROUP BY Cluster")
def q_dbscan_cluster_sizes(spark, d):
    return X.cluster_sizes_shares(_part_dbscan(spark, d), "Cluster")


# ============================================================ M3, M5, M6, M7, M12-M14, M17, M18 (rows-only)
import uuid  # noqa: E402

from ..operators import pca as PC  # noqa: E402
from ..operators import registry as RG  # noqa: E402
from ..operators.cluster import agglomerative as AG  # noqa: E402
from ..operators.cluster import gmm as GM  # noqa: E402
from ..operators.cluster import kmeans as KM  # noqa: E402
from ..session import checkpoint_dir  # noqa: E402


def _survey_minmax(spark, d):
    return SC.minmax(survey_view(spark, d).select("id", *LIKERT), LIKERT)


@query("kmeans_fit")
def q_kmeans_fit(spark, d):
    labelled, _ = KM.kmeans(_survey_minmax(spark, d), LIKERT, k=4, seed=42)
    return labelled.select("id", "Cluster")


@query("kmeans_restarts")
def q_kmeans_restarts(spark, d):
    """G1: standardised features, 10 seeded restarts, lowest cost kept."""
    part = table(spark, d, "part").select("p_partkey", *_PART_XY)
    labelled, _ = KM.kmeans(SC.standardise(part, _PART_XY), _PART_XY, k=4, seed=42, restarts=10)
    return labelled.select("p_partkey", "Cluster")


@query("kmeans_centroids")
def q_kmeans_centroids(spark, d):
    """Centres in original units (rounded to 2) with the fit's inertia."""
    part = table(spark, d, "part").select("p_partkey", *_PART_XY)
    scaler = SC.standard_fit(part, _PART_XY)
    res = KM.kmeans_fit(scaler.transform(part), _PART_XY, k=4, seed=42, restarts=10)
    rows = [(i, *[round(v, 2) for v in c], round(res.cost, 2))
            for i, c in enumerate(scaler.inverse(_PART_XY, res.centroids))]
    return spark.createDataFrame(rows, "cluster int, p_size double, p_retailprice double, inertia double")


@query("gmm_fit")
def q_gmm_fit(spark, d):
    part = _part_minmax(spark, d)
    res = GM.gmm_fit(part, _PART_XY, k=4, seed=42, restarts=3)
    return res.transform(part).select("p_partkey", "Cluster")


@query("gmm_metrics")
def q_gmm_metrics(spark, d):
    res = GM.gmm_fit(_part_minmax(spark, d), _PART_XY, k=4, seed=42, restarts=3)
    return spark.createDataFrame([("BIC", res.bic), ("AIC", res.aic), ("log_likelihood", res.log_likelihood)],
                                 "metric string, value double")


@query("pca_scores")
def q_pca_scores(spark, d):
    scores, _ = PC.pca(survey_view(spark, d), LIKERT, n_components=3, keep=["id", "signo", "genero", "edad"])
    return scores


@query("pca_variance")
def q_pca_variance(spark, d):
    _, res = PC.pca(survey_view(spark, d), LIKERT, n_components=3)
    return res.variance_table(spark)


@query("covariance_matrix", "SELECT a.col_a, a.col_b, round(a.cov, 6) AS cov FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, covar_samp(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS cov "
    "FROM lineitem" for a in _STD for b in _STD) + ") a")
def q_covariance_matrix(spark, d):
    return R6(PC.covariance_matrix(table(spark, d, "lineitem"), _STD))


_SUP_XY = ["s_acctbal", "s_nationkey"]
_SUP_MM_SQL = _minmax_sql("SELECT s_suppkey, s_acctbal, s_nationkey FROM supplier", ["s_suppkey"], _SUP_XY)
_SL_CUT = 0.05


def _sup_minmax(spark, d):
    return SC.minmax(table(spark, d, "supplier").select("s_suppkey", *_SUP_XY), _SUP_XY)


@query("single_linkage", _dbscan_sql(_SUP_MM_SQL, "s_suppkey", _SUP_XY, _SL_CUT, 1))
def q_single_linkage(spark, d):
    return AG.single_linkage_cut(_sup_minmax(spark, d), _SUP_XY, _SL_CUT, key="s_suppkey")


@query("single_linkage_clusters")
def q_single_linkage_clusters(spark, d):
    """M6 with a number of clusters; its oracle is in ``hierarchies``."""
    return AG.single_linkage(_sup_minmax(spark, d), _SUP_XY, n_clusters=4, key="s_suppkey")


@query("single_linkage_merges")
def q_single_linkage_merges(spark, d):
    """M7; its oracle is in ``hierarchies``."""
    return R6(AG.merge_table(_sup_minmax(spark, d), _SUP_XY, last=19, key="s_suppkey"))


@query("train_batch")
def q_train_batch(spark, d):
    return RG.train_batch(survey_view(spark, d), LIKERT, key="id")


@query("model_roundtrip")
def q_model_roundtrip(spark, d):
    """M17 + M15: fit on scaled part, save, load, classify the raw rows with the saved scaler."""
    part = table(spark, d, "part").select("p_partkey", *_PART_XY)
    scaler = SC.standard_fit(part, _PART_XY)
    res = KM.kmeans_fit(scaler.transform(part), _PART_XY, k=4, seed=42)
    path = f"{checkpoint_dir(spark)}/models/{uuid.uuid4().hex}"
    RG.save_model(spark, res, "kmeans", path, _PART_XY, scaler=scaler)
    return RG.classify(spark, path, part).select("p_partkey", "Cluster")


# ============================================================ S10-S15, P1, P15, streaming
from ..fixtures import survey_select_list  # noqa: E402
from ..schema import quality_table  # noqa: E402
from ..sources import files as FS  # noqa: E402
from ..sources import pages as PG  # noqa: E402
from ..streaming import scoring as ST  # noqa: E402

_POL_SQL = "(" + " + ".join(polarity_sql(c) for c in OPEN) + f") / {len(OPEN)}"


@query("qualitative_export", with_survey(
    f"SELECT id, genero, signo, {_OPEN}, round({_POL_SQL}, 6) AS Polaridad_Sentimiento_Promedio FROM survey_view"))
def q_qualitative_export(spark, d):
    sv = survey_view(spark, d, dealt=True)
    scored = N.sentiment_rows(sv, OPEN, keep=sv.columns).withColumnRenamed(
        "sentimiento_promedio", "Polaridad_Sentimiento_Promedio")
    return R6(FS.qualitative_export(scored))


@query("record_cards", with_survey(
    f"SELECT id, signo, p1a, p2a, round({_POL_SQL}, 6) AS Polaridad_Sentimiento_Promedio FROM survey_view "
    "ORDER BY id LIMIT 15"))
def q_record_cards(spark, d):
    first = P.head_by(survey_view(spark, d), "id", 15, ["id", "signo", *OPEN])
    scored = N.sentiment_rows(first, OPEN, keep=["id", "signo", "p1a", "p2a"]).withColumnRenamed(
        "sentimiento_promedio", "Polaridad_Sentimiento_Promedio")
    return R6(scored.select("id", "signo", "p1a", "p2a", "Polaridad_Sentimiento_Promedio"))


@query("dict_rows_export", with_survey(
    "SELECT coalesce(CAST(id AS VARCHAR), '') AS id, coalesce(signo, '') AS signo, coalesce(p1a, '') AS p1a, "
    "'' AS elemento, coalesce(CAST(p3 AS VARCHAR), '') AS p3 FROM survey_view"))
def q_dict_rows_export(spark, d):
    return FS.dict_rows_export(survey_view(spark, d), ["id", "signo", "p1a", "elemento", "p3"])


@query("load_profile", with_survey(
    "SELECT count(*) AS total_registros, [" + ", ".join(
        f"'{c}'" for c in ["id", "edad", "genero", "signo"] + LIKERT + OPEN) + "] AS columnas FROM survey_view"))
def q_load_profile(spark, d):
    return FS.load_profile(survey_view(spark, d))


@query("quality_table", with_survey(" UNION ALL ".join(
    [f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS nulls, "
     f"CAST(count_if({c} IS NOT NULL AND TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE) IS NULL) AS BIGINT) AS invalid "
     "FROM survey_view"
     for c in ["edad"] + LIKERT]
    + [f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS nulls, "
       f"CAST(count_if({c} IS NOT NULL AND trim({c}) = '') AS BIGINT) AS invalid FROM survey_view" for c in OPEN])))
def q_quality_table(spark, d):
    return quality_table(survey_view(spark, d), ["edad"] + LIKERT, OPEN)


# as SQL text: a value ends at the first semicolon outside quotes
_SCRIPT_RE = r"""(?s)<script>\s*var\s+(\w+)\s*=\s*((?:[^;"''`]|"(?:[^"\\\n]|\\.)*"|''(?:[^''\\\n]|\\.)*''|`(?:[^`\\]|\\.)*`|["''`])*);"""


@query("page_script_vars", f"""
SELECT page_id, unnest(regexp_extract_all(html, '{_SCRIPT_RE}', 1)) AS name,
       unnest(regexp_extract_all(html, '{_SCRIPT_RE}', 2)) AS value FROM pages""")
def q_page_script_vars(spark, d):
    return PG.script_vars(table(spark, d, "pages"))


_PARAGRAPH = r"""<p>([^<"\\\n\r\t]+)"""


@query("page_form_questions", f"""
SELECT page_id, CAST(position - 1 AS INTEGER) AS position, regexp_replace(texts[position], '[^\\x00-\\x7F]', '', 'g') AS title
FROM (SELECT page_id, texts, unnest(range(1, len(texts) + 1)) AS position FROM (SELECT page_id, regexp_extract_all(html, '{_PARAGRAPH}', 1) AS texts FROM pages))""")
def q_page_form_questions(spark, d):
    """Each page with a form put in whose questions are the page's own paragraphs: the given pages hold no form variable."""
    texts = F.regexp_extract_all("html", F.lit(_PARAGRAPH), F.lit(1))
    asked = F.transform(texts, lambda t, i: F.concat(F.lit("["), i.cast("string"), F.lit(',"'), t, F.lit('",null,0]')))
    form = F.concat(F.lit("<script>var FB_PUBLIC_LOAD_DATA_ = [null,[\"form\",["), F.array_join(asked, ","), F.lit("]]];</script></head>"))
    pages = table(spark, d, "pages").select("page_id", F.replace("html", F.lit("</head>"), form).alias("html"))
    return PG.form_questions(pages)


_FORM_SQL = r"""'<html><script>var FB_PUBLIC_LOAD_DATA_ = [null,["Encuesta",[[11,"¿Qué página? ' || url || '",null,0],[12,"Tamaño; ' || """ \
            r"""CAST(length(html) AS VARCHAR(20)) || '",null,2]]]];</script></html>'"""


@query("page_form_titles", rf"""
WITH form AS (SELECT page_id, CAST(regexp_extract({_FORM_SQL}, '(?s)var FB_PUBLIC_LOAD_DATA_ = (\[.*?\]);\s*</script>', 1) AS JSON) AS doc
              FROM pages WHERE html IS NOT NULL AND url IS NOT NULL)
, q AS (SELECT page_id, doc, unnest(range(CAST(json_array_length(doc, '$[1][1]') AS BIGINT))) AS position FROM form)
SELECT page_id, CAST(position AS INTEGER) AS position,
       regexp_replace(json_extract_string(doc, '$[1][1][' || position || '][1]'), '[^\x00-\x7F]', '', 'g') AS title FROM q""")
def q_page_form_titles(spark, d):
    """Form pages made of every page's address and size: the given pages hold no form variable."""
    return PG.form_questions(table(spark, d, "pages").selectExpr("page_id", f"{_FORM_SQL} AS html"))


@query("stream_scoring")
def q_stream_scoring(spark, d):
    """Customer files as a stream -> survey rows -> min-max + nearest centre + polarity + theme means."""
    cust = table(spark, d, "customer")
    mm = SC.minmax_fit(survey_view(spark, d), LIKERT)
    centroids = [[0.25] * len(LIKERT), [0.5] * len(LIKERT), [0.75] * len(LIKERT)]
    stream = (spark.readStream.schema(cust.schema).option("pathGlobFilter", "customer.parquet")
              .parquet(d.rstrip("/") + "/"))
    scored = ST.score(spread(stream).selectExpr(*survey_select_list()), LIKERT, centroids, scaler=mm, text_cols=OPEN,
                      keep=["id"])
    base = f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    q = ST.start_scoring(scored, f"{base}/out", f"{base}/chk", trigger_once=True)
    q.awaitTermination()
    return R6(spark.read.parquet(f"{base}/out"))


# ============================================================ R1, R2
from ..operators import reports as RP  # noqa: E402


def _report_sql() -> str:
    lab = _assign_sql(_PART_MM_SQL, "p_partkey", _PART_XY, _CENTROIDS)
    return f"""WITH lab AS ({lab}),
c AS (SELECT Cluster AS cluster, count(*) AS n FROM lab GROUP BY Cluster),
t AS (SELECT sum(n) AS total FROM c)
SELECT 'algorithm' AS section, 'name' AS item, 'KMEANS' AS value
UNION ALL SELECT 'metric', 'Inertia', printf('%.4f', (SELECT sum(d2) FROM lab))
UNION ALL SELECT 'size', CAST(cluster AS VARCHAR), CAST(n AS VARCHAR) FROM c
UNION ALL SELECT 'share', CAST(cluster AS VARCHAR), printf('%.1f', round(n * 100.0 / total, 1)) FROM c, t
UNION ALL SELECT 'dominant', CAST((SELECT cluster FROM c ORDER BY n DESC, cluster LIMIT 1) AS VARCHAR),
                 printf('%.1f', round((SELECT max(n) FROM c) * 100.0 / (SELECT total FROM t), 1))
UNION ALL SELECT 'minority', CAST((SELECT cluster FROM c ORDER BY n ASC, cluster LIMIT 1) AS VARCHAR),
                 printf('%.1f', round((SELECT min(n) FROM c) * 100.0 / (SELECT total FROM t), 1))"""


@query("report_summary", _report_sql())
def q_report_summary(spark, d):
    part = _part_minmax(spark, d)
    labelled = AS.assign_nearest(part, _PART_XY, _CENTROIDS)
    inertia = AS.inertia(part, _PART_XY, _CENTROIDS).first()["inertia"]
    return RP.executive_summary(labelled, "kmeans", {"Inertia": inertia})


_LEVELS = [(1.0,) * len(LIKERT), (3.0,) * len(LIKERT), (5.0,) * len(LIKERT)]


_SIGNS_SQL = with_survey(
    "SELECT Cluster, signo, count(*) AS n FROM (" + _assign_sql(
        f"SELECT id, signo, {_cols(f'coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}' for c in LIKERT)} FROM survey_view",
        "id, signo", LIKERT, _LEVELS)
    + ") WHERE signo IS NOT NULL GROUP BY Cluster, signo")


@query("report_sign_by_cluster", _SIGNS_SQL)
@query("report_sign_by_cluster_all", _SIGNS_SQL)
def q_report_sign_by_cluster_all(spark, d):
    sv = survey_view(spark, d).select("id", "signo", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in LIKERT])
    labelled = AS.assign_nearest(sv, LIKERT, _LEVELS)
    return RP.chart_tables(labelled, LIKERT)["sign_by_cluster"]


@query("silhouette_squared", _silhouette_sql(_PART_LABELS_SQL, _PART_XY, "squared"))
def q_silhouette_squared(spark, d):
    """M8 scalable mode: MLlib squared-Euclidean silhouette, O(n*k), reported under its own name."""
    labelled = AS.assign_nearest(_part_minmax(spark, d), _PART_XY, _CENTROIDS)
    return R6(EV.silhouette(labelled, _PART_XY, "Cluster", mode="squared"))


@query("first_seen_mode", """
WITH long AS (SELECT o_orderkey, question, value FROM
                (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders)
                UNPIVOT (value FOR question IN (o_orderstatus, o_orderpriority))),
cnt AS (SELECT question, value, count(*) AS n, min(o_orderkey) AS f FROM long GROUP BY question, value)
SELECT question, value AS mode FROM (
  SELECT *, row_number() OVER (PARTITION BY question ORDER BY n DESC, f ASC) AS rn FROM cnt) WHERE rn = 1""")
def q_first_seen_mode(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return A.first_seen_mode(o, ["o_orderstatus", "o_orderpriority"], order_col="o_orderkey")
