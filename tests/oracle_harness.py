"""Local stand-in for the driver's correctness gate: Spark result vs DuckDB SQL."""

from __future__ import annotations

import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


def compare(spark, data_dir: str, name: str, fn, sql: str, con=None) -> dict:
    con = con or duck(data_dir)
    sdf = fn(spark, data_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    res = {
        "name": name,
        "rows": (len(s_rows), len(d_rows)),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "hash_match": sorted(s_cols) == sorted(d_cols) and digest(s_cols, s_rows) == digest(d_cols, d_rows),
        "spark_types": dict(sdf.dtypes),
        "duck_types": dict(zip(d_cols, [str(t) for t in rel.types])),
    }
    if not res["hash_match"]:
        res["spark_cols"] = s_cols
        res["duck_cols"] = d_cols
        res["spark_sample"] = sorted(s_rows, key=str)[:3]
        res["duck_sample"] = sorted(d_rows, key=str)[:3]
    return res
