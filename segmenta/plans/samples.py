"""Queries of seeded samples and of pages deep in a table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import evaluate as EV
from ..operators import filters as P
from ..operators import pages as PI
from ..operators._util import round_doubles as R6
from ..operators.cluster import assign as AS
from ..session import checkpoint_dir
from ..tables import table
from .catalog import _CENTROIDS, _PART_MM_SQL, _PART_XY, _assign_sql, _part_minmax
from .registry import query

_SEEDED = "md5(concat('{seed}:', CAST({key} AS VARCHAR)))"


def _sampled_sql(fraction: float) -> str:
    gap = "sqrt(" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _PART_XY) + ")"
    drawn = f"CAST(concat('0x', substr({_SEEDED.format(seed=0, key='p_partkey')}, 1, 8)) AS BIGINT) < {fraction * 2.0 ** 32!r}"
    keys = ", ".join(_PART_XY)
    return f"""WITH pts AS (SELECT p_partkey, {keys}, Cluster AS label, {drawn} AS drawn FROM ({_assign_sql(_PART_MM_SQL, "p_partkey", _PART_XY, _CENTROIDS)}))
, b AS (SELECT {keys}, label, count(*) AS w FROM pts GROUP BY ALL)
, sizes AS (SELECT label, count(*) AS n FROM pts GROUP BY label)
, sd AS (SELECT a.p_partkey, a.label AS own, b.label AS other, sum(b.w * {gap}) AS sd FROM pts a, b WHERE a.drawn GROUP BY ALL)
, per AS (SELECT p_partkey, max(CASE WHEN own = other THEN n END) AS n_own, max(CASE WHEN own = other THEN sd / greatest(n - 1, 1) END) AS a,
            min(CASE WHEN own <> other THEN sd / n END) AS b FROM sd JOIN sizes z ON z.label = sd.other GROUP BY p_partkey)
, sc AS (SELECT CASE WHEN n_own > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0.0 END AS s FROM per)
SELECT 'silhouette_sampled' AS metric, round(avg(s), 6) AS value,
       round(sqrt(greatest(avg(s * s) - avg(s) * avg(s), 0) / greatest(count(*) - 1, 1) * greatest(1 - count(*) / (SELECT count(*) FROM pts)::DOUBLE, 0)), 6) AS standard_error,
       count(*) AS rows FROM sc"""


def _sampled(spark, d, fraction):
    labelled = AS.assign_nearest(_part_minmax(spark, d), _PART_XY, _CENTROIDS)
    return R6(EV.silhouette_sampled(labelled, _PART_XY, "Cluster", "p_partkey", fraction))


@query("silhouette_sampled", _sampled_sql(0.25))
def q_silhouette_sampled(spark, d):
    return _sampled(spark, d, 0.25)


@query("silhouette_sample_of_all", _sampled_sql(1.0))
def q_silhouette_sample_of_all(spark, d):
    return _sampled(spark, d, 1.0)


@query("scatter_capped", f"""
SELECT label AS cluster, round(coalesce(CAST(embedding[1] AS DOUBLE), 0.0), 6) AS x, round(coalesce(CAST(embedding[2] AS DOUBLE), 0.0), 6) AS y
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_SEEDED.format(seed=7, key='vec_id')}, vec_id) AS r FROM embeddings) WHERE r <= 20""")
def q_scatter_capped(spark, d):
    emb = table(spark, d, "embeddings").select("vec_id", F.col("label").alias("Cluster"), F.col("embedding")[0].alias("e0"), F.col("embedding")[1].alias("e1"))
    return R6(P.scatter_series(emb, ["e0", "e1"], cap=20, key="vec_id", seed=7))


@query("page_deep", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 100 OFFSET 4400""")
def q_page_deep(spark, d):
    order = ["l_orderkey", "l_linenumber"]
    rows = table(spark, d, "lineitem").select(*order, "l_quantity", "l_extendedprice")
    path = PI.build_page_index(rows, order, f"{checkpoint_dir(spark).rstrip('/')}/page-index-{uuid.uuid4().hex}")
    return PI.page_of_index(spark, path, order, 45, 100)
