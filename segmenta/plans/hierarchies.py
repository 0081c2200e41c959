"""Queries of agglomerative clustering, with the oracle that merges the nearest two clusters over and over."""

from __future__ import annotations

from ..operators.cluster import agglomerative as AG
from .catalog import _SUP_MM_SQL, _SUP_XY, R6, _sup_minmax
from .registry import ORACLE, query

_GAP = "sqrt(" + " + ".join(f"(x.{c} - y.{c}) * (x.{c} - y.{c})" for c in _SUP_XY) + ")"
_MEANS = " + ".join(f"(x.m_{c} - y.m_{c}) * (x.m_{c} - y.m_{c})" for c in _SUP_XY)

#: distance of the clusters ``lo`` and ``hi``, from their members' distances
_LINKED = {"single": "min(g.gap)", "complete": "max(g.gap)", "average": "sum(g.gap * x.w * y.w) / sum(x.w * y.w)"}


def _tree_sql(linkage: str) -> str:
    """CTEs: ``vec`` (distinct vectors) and ``tree``, every vector's cluster after each step and the merge that made it."""
    if linkage == "ward":
        cl = ", ".join(f"sum(w * {c}) / sum(w) AS m_{c}" for c in _SUP_XY)
        pairs = f"""SELECT x.cid AS lo, y.cid AS hi, sqrt(2.0 * x.n * y.n / (x.n + y.n) * ({_MEANS})) AS gap
        FROM (SELECT cid, sum(w) AS n, {cl} FROM tree GROUP BY cid) x JOIN (SELECT cid, sum(w) AS n, {cl} FROM tree GROUP BY cid) y ON x.cid < y.cid"""
    else:
        pairs = f"""SELECT x.cid AS lo, y.cid AS hi, {_LINKED[linkage]} AS gap
        FROM tree x JOIN gaps g ON g.i = x.vid JOIN tree y ON y.vid = g.j AND x.cid < y.cid GROUP BY x.cid, y.cid"""
    return f"""WITH RECURSIVE pts AS ({_SUP_MM_SQL}),
vec AS (SELECT {', '.join(_SUP_XY)}, count(*) AS w, min(s_suppkey) AS vid FROM pts GROUP BY {', '.join(_SUP_XY)}),
gaps AS (SELECT x.vid AS i, y.vid AS j, {_GAP} AS gap FROM vec x JOIN vec y ON x.vid <> y.vid),
tree AS (
  SELECT 0 AS step, vid, w, {', '.join(_SUP_XY)}, vid AS cid, CAST(NULL AS BIGINT) AS lo, CAST(NULL AS BIGINT) AS hi, CAST(0 AS DOUBLE) AS distance FROM vec
  UNION ALL
  SELECT t.step + 1, t.vid, t.w, {', '.join('t.' + c for c in _SUP_XY)}, CASE WHEN t.cid = b.hi THEN b.lo ELSE t.cid END, b.lo, b.hi, b.gap
  FROM tree t, (SELECT lo, hi, gap FROM ({pairs}) ORDER BY round(gap, 12), lo, hi LIMIT 1) b)"""


def _merges_sql(linkage: str, last: int) -> str:
    return f"""{_tree_sql(linkage)}
SELECT CAST(step - 1 AS INTEGER) AS step, lo AS "left", hi AS "right", round(max(distance), 6) AS distance, CAST(sum(w) AS BIGINT) AS size
FROM tree WHERE step > (SELECT max(step) FROM tree) - {last} AND step > 0 AND cid = lo GROUP BY step, lo, hi"""


def _labels_sql(linkage: str, n_clusters: int) -> str:
    on = " AND ".join(f"p.{c} = k.{c}" for c in _SUP_XY)
    return f"""{_tree_sql(linkage)}
, cut AS (SELECT * FROM tree WHERE step = (SELECT max(step) FROM tree) - {n_clusters - 1})
, num AS (SELECT cid, row_number() OVER (ORDER BY cid) - 1 AS cl FROM (SELECT DISTINCT cid FROM cut))
SELECT p.s_suppkey, CAST(n.cl AS BIGINT) AS "Cluster" FROM pts p JOIN cut k ON {on} JOIN num n ON n.cid = k.cid"""


def _register(linkage: str) -> None:
    @query(f"{linkage}_linkage_clusters", _labels_sql(linkage, 4))
    def labels(spark, d):
        return AG.agglomerative(_sup_minmax(spark, d), _SUP_XY, 4, linkage, key="s_suppkey")

    @query(f"{linkage}_linkage_merges", _merges_sql(linkage, 19))
    def merges(spark, d):
        return R6(AG.merge_table(_sup_minmax(spark, d), _SUP_XY, last=19, key="s_suppkey", linkage=linkage))


for _linkage in ("ward", "average", "complete"):
    _register(_linkage)

ORACLE["single_linkage_clusters"] = _labels_sql("single", 4)
ORACLE["single_linkage_merges"] = _merges_sql("single", 19)
