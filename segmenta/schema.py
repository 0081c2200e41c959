"""Survey schema, column validation (P1, U2) and column roles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIKERT = [f"p{i}" for i in range(1, 16)]
OPEN = [f"p{i}a" for i in range(1, 16)]
REQUIRED = ["id", "edad", "genero", "signo"]

SURVEY_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("edad", T.IntegerType()),
     T.StructField("genero", T.StringType()), T.StructField("signo", T.StringType())]
    + [T.StructField(c, T.IntegerType()) for c in LIKERT]
    + [T.StructField(c, T.StringType()) for c in OPEN])

# Validation messages, one per column group, joined with " | ".
MSG_REQUIRED = "Faltan columnas de identificación/demografía obligatorias: "
MSG_LIKERT = "Faltan preguntas Likert obligatorias (p1 a p15): "
MSG_OPEN = "Faltan preguntas abiertas obligatorias (p1a a p15a): "
MSG_OK = "Validación exitosa"


def missing_columns(columns: list[str], required: list[str]) -> list[str]:
    """Required minus present, in required order."""
    have = set(columns)
    return [c for c in required if c not in have]


def validate_columns(columns: list[str]) -> tuple[bool, str]:
    """Presence check in three groups; metadata only (no data is read)."""
    errors = []
    for msg, group in ((MSG_REQUIRED, REQUIRED), (MSG_LIKERT, LIKERT), (MSG_OPEN, OPEN)):
        miss = missing_columns(columns, group)
        if miss:
            errors.append(msg + ", ".join(miss))
    return (False, " | ".join(errors)) if errors else (True, MSG_OK)


def quality_table(df: DataFrame, numeric: list[str], text: list[str] | None = None) -> DataFrame:
    """P1 data side: per column (nulls, unparsable) from ONE aggregate.

    ``unparsable`` counts non-null values that do not parse as a number (numeric
    columns stored as text); text columns report blanks instead.
    """
    text = text or []
    aggs, rows = [], []
    for i, c in enumerate(numeric):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"n{i}"),
                 F.count_if(F.col(c).isNotNull() & F.col(c).cast("string").try_cast("double").isNull())
                 .alias(f"u{i}")]
        rows.append((c, f"n{i}", f"u{i}"))
    for j, c in enumerate(text):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"tn{j}"),
                 F.count_if(F.col(c).isNotNull() & (F.trim(F.col(c)) == "")).alias(f"tb{j}")]
        rows.append((c, f"tn{j}", f"tb{j}"))
    wide = df.agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(n).alias("nulls"), F.col(u).alias("invalid"))
        for c, n, u in rows])))


def column_roles(df: DataFrame, max_categories: int | None = None) -> dict[str, list[str]]:
    """Split columns into numeric features and category candidates from the schema."""
    numeric, category = [], []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            numeric.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            category.append(f.name)
    return {"numeric": numeric, "category": category}
