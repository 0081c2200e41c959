"""Small helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame, cols) -> list[str]:
    """Columns of ``cols`` that exist in ``df`` (reference: absent columns are skipped)."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def stack_rows(wide: DataFrame, rows: list[dict[str, Column]]) -> DataFrame:
    """Turn a (one-row) wide aggregate into long rows via ``inline(array(struct…))``."""
    return wide.select(F.inline(F.array(*[F.struct(*[v.alias(k) for k, v in r.items()]) for r in rows])))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (value-hash hygiene for oracle comparison)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def order_by_position(df: DataFrame, col: str, names: list[str]) -> DataFrame:
    """Sort a small result by the position of ``col`` in ``names``."""
    return df.orderBy(F.array_position(F.array(*[F.lit(n) for n in names]), F.col(col)))


def nan_as_null(df: DataFrame, cols) -> DataFrame:
    """``df`` with NaN read as null in those of ``cols`` that are floating point (as ``pd.notnull`` does)."""
    kinds = dict(df.dtypes)
    floats = [c for c in present(df, cols) if kinds[c] in ("float", "double")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df
