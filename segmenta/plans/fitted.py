"""Queries of fitted models whose results SQL can state: rounds from given starts, and equations that a fitted model fulfils."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..fixtures import LIKERT, survey_view, with_survey
from ..operators import pca as PC
from ..operators import scaling as SC
from ..operators._util import round_doubles as R6
from ..operators.cluster import gmm as GM
from ..operators.cluster import kmeans as KM
from ..operators.cluster.assign import assign_nearest
from ..operators.cluster.lloyd import lloyd, seeded_starts, weighted_vectors
from ..session import materialize
from ..operators.stats import DEFAULT_THEMES
from .catalog import _CENTROIDS, _PART_MM_SQL, _PART_XY, _POL_SQL, _assign_sql, _minmax_sql, _part_minmax, _row_mean_sql, _survey_minmax
from .registry import ORACLE, query

_STARTS = [_CENTROIDS, [(0.1, 0.9), (0.4, 0.4), (0.9, 0.6)]]


def _rounds_sql(rounds: int) -> str:
    starts = ", ".join(f"({r}, {k}, {x!r}, {y!r})" for r, c in enumerate(_STARTS) for k, (x, y) in enumerate(c))
    ctes = [f"pts AS ({_PART_MM_SQL})", f"c0 AS (SELECT * FROM (VALUES {starts}) t(run, cluster, x, y))"]
    near = """SELECT run, p_partkey, any_value(px) AS px, any_value(py) AS py, min(d) AS d, arg_min(cluster, (d, cluster)) AS cluster FROM (
      SELECT run, p_partkey, p_size AS px, p_retailprice AS py, cluster, (p_size - x) * (p_size - x) + (p_retailprice - y) * (p_retailprice - y) AS d
      FROM pts, c{k}) GROUP BY run, p_partkey"""
    for k in range(rounds):
        ctes += [f"a{k} AS ({near.format(k=k)})", f"""c{k + 1} AS (SELECT c.run, c.cluster, coalesce(m.x, c.x) AS x, coalesce(m.y, c.y) AS y FROM c{k} c LEFT JOIN (
          SELECT run, cluster, avg(px) AS x, avg(py) AS y FROM a{k} GROUP BY run, cluster) m USING (run, cluster))"""]
    ctes.append(f"a AS ({near.format(k=rounds)})")
    return f"""WITH {', '.join(ctes)}
SELECT CAST(c.run AS INTEGER) AS run, CAST(c.cluster AS INTEGER) AS cluster, round(x, 6) AS x, round(y, 6) AS y, coalesce(n, 0) AS n, round(cost, 6) AS cost
FROM c{rounds} c LEFT JOIN (SELECT run, cluster, count(*) AS n FROM a GROUP BY run, cluster) USING (run, cluster) JOIN (SELECT run, sum(d) AS cost FROM a GROUP BY run) USING (run)"""


@query("kmeans_two_rounds", _rounds_sql(2))
def q_kmeans_two_rounds(spark, d):
    """Two starts, two rounds each, in the same scans."""
    runs = lloyd(weighted_vectors(_part_minmax(spark, d), _PART_XY), _STARTS, max_iter=2, tol=0.0)
    rows = [(r, k, *map(float, c), int(n)) + (cost,) for r, (centers, cost, ns) in enumerate(runs) for k, (c, n) in enumerate(zip(centers, ns, strict=True))]
    return R6(spark.createDataFrame(rows, "run int, cluster int, x double, y double, n long, cost double"))


@query("kmeans_fixed_point", with_survey("SELECT count(*) AS rows, CAST(4 AS BIGINT) AS clusters, true AS centres_are_means, true AS cost_is_inertia FROM survey_view"))
def q_kmeans_fixed_point(spark, d):
    """M3 on all answers: each centre is the mean of its rows, and the cost is the rows' squared distance to their nearest centre."""
    df = _survey_minmax(spark, d)
    res = KM.kmeans_fit(df, LIKERT, k=4, seed=42, restarts=3, tol=0.0)
    labelled = materialize(assign_nearest(df, LIKERT, res.centroids, "Cluster", "d2").select("Cluster", "d2", *LIKERT), "labelled")
    means = labelled.groupBy("Cluster").agg(*[F.avg(c).alias(c) for c in LIKERT])
    centres = spark.createDataFrame([(i, *c) for i, c in enumerate(res.centroids)], "Cluster int, " + ", ".join(f"m_{c} double" for c in LIKERT))
    off = F.greatest(*[F.abs(F.col(c) - F.col(f"m_{c}")) for c in LIKERT])
    near = means.join(centres, "Cluster").agg(F.count(F.lit(1)).alias("clusters"), (F.max(off) < 1e-9).alias("centres_are_means"))
    cost = labelled.agg(F.count(F.lit(1)).alias("rows"), (F.abs(F.sum("d2") - F.lit(res.cost)) < 1e-6 * res.cost).alias("cost_is_inertia"))
    return cost.join(near).select("rows", "clusters", "centres_are_means", "cost_is_inertia")


@query("kmeans_lowest_of_starts", "SELECT count(*) AS rows, CAST(10 AS BIGINT) AS starts, true AS lowest_kept FROM part")
def q_kmeans_lowest_of_starts(spark, d):
    """The fit's cost is the least of its ten starts', each run by itself."""
    df = SC.standardise(_part_minmax(spark, d), _PART_XY)
    res = KM.kmeans_fit(df, _PART_XY, k=4, seed=42, restarts=10)
    vec = weighted_vectors(df, _PART_XY)
    alone = [lloyd(vec, [start])[0][1] for start in seeded_starts(vec, 4, 10, 42)]
    return df.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.lit(len(alone)).cast("long").alias("starts"),
                                                          F.lit(abs(min(alone) - res.cost) <= 1e-9 * res.cost).alias("lowest_kept"))


@query("pca_equations", with_survey("SELECT concat('PC', k) AS component, true AS unit_length, true AS is_axis, true AS share_is_variance "
                                    "FROM (SELECT unnest([1, 2, 3]) AS k), (SELECT count(*) AS n FROM survey_view) WHERE n > 0"))
def q_pca_equations(spark, d):
    """Covariance times loadings equals eigenvalue times loadings, and the shares are the eigenvalues' of the trace."""
    df = survey_view(spark, d)
    res = PC.pca_fit(df, LIKERT, 3)
    cov = {(r["col_a"], r["col_b"]): r["cov"] for r in PC.covariance_matrix(df, LIKERT).collect()}
    cov = np.array([[cov[a, b] for b in LIKERT] for a in LIKERT])
    rows = []
    for k in range(3):
        w = res.loadings[:, k]
        value = float(w @ cov @ w)
        rows.append((f"PC{k + 1}", bool(abs(w @ w - 1) < 1e-9), bool(np.abs(cov @ w - value * w).max() < 1e-6),
                     bool(abs(value / np.trace(cov) - res.explained_variance_ratio[k]) < 1e-6)))
    return spark.createDataFrame(rows, "component string, unit_length boolean, is_axis boolean, share_is_variance boolean")


@query("gmm_equations", "SELECT count(*) AS rows, true AS weights_sum_to_one, true AS likelihood_holds, true AS bic_holds, true AS aic_holds FROM part")
def q_gmm_equations(spark, d):
    """Over all rows, the fitted weights, means and covariances are at least as likely as the fit reports (which is before
    its last update) and by less than 1 in 100; BIC and AIC follow from the reported value."""
    df = _part_minmax(spark, d)
    res = GM.gmm_fit(df, _PART_XY, k=4, seed=42, restarts=3)
    model = res.model
    terms = []
    for w, row in zip(model.weights, model.gaussiansDF.collect(), strict=True):
        mean, cov = row["mean"].toArray(), row["cov"].toArray()
        inv, (_, logdet) = np.linalg.inv(cov), np.linalg.slogdet(cov)
        x = [F.col(c) - F.lit(float(m)) for c, m in zip(_PART_XY, mean, strict=True)]
        form = sum((x[i] * x[j] * float(inv[i, j]) for i in range(2) for j in range(2)), F.lit(0.0))
        terms.append(F.lit(float(w)) * F.exp(-0.5 * (form + float(logdet) + 2 * float(np.log(2 * np.pi)))))
    total = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.log(sum(terms[1:], terms[0]))).alias("ll"))
    k, dims, n = 4, 2, res.n
    free = k * dims * (dims + 1) // 2 + k * dims + k - 1
    return total.select(
        "rows", F.lit(abs(sum(model.weights) - 1) < 1e-9).alias("weights_sum_to_one"),
        (F.col("ll") - res.log_likelihood).between(-1e-6, abs(res.log_likelihood) * 0.01).alias("likelihood_holds"),
        F.lit(abs(res.bic - (free * np.log(n) - 2 * res.log_likelihood)) < 1e-6).alias("bic_holds"),
        F.lit(abs(res.aic - (2 * free - 2 * res.log_likelihood)) < 1e-6).alias("aic_holds"))


#: the stream's records, scored as one batch
ORACLE["stream_scoring"] = with_survey("SELECT v.id, CAST(a.Cluster AS INTEGER) AS \"Cluster\", round(" + _POL_SQL + ", 6) AS sentimiento_promedio, " + ", ".join(
    f'{_row_mean_sql([f"v.{c}" for c in cols])} AS "{name}"' for name, cols in DEFAULT_THEMES.items()) + " FROM survey_view v JOIN ("
    + _assign_sql(_minmax_sql("SELECT * FROM survey_view", ["id"], LIKERT), "id", LIKERT, [(x,) * len(LIKERT) for x in (0.25, 0.5, 0.75)]) + ") a ON a.id = v.id")
