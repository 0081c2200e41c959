"""The survey-shaped view derived from ``customer`` (FIXTURES.md section 3).

The same SQL text runs in Spark (as ``selectExpr`` over the customer scan) and in
DuckDB (as a CTE in the oracle), so both engines see identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import spread, table

# The twelve sign names used by the survey fixture, in order.
SIGNS = "Aries,Tauro,Geminis,Cancer,Leo,Virgo,Libra,Escorpio,Sagitario,Capricornio,Acuario,Piscis"

# The open-answer texts of the fixture, by (c_custkey + i) % 8.
OPEN_ANSWERS = (
    "'Soy muy creativo y apasionado'",
    "'La rutina me pone triste'",
    "'Curioso pero impaciente, impaciente'",
    "'Los creativos aburridos'",
    "'Persona empática según mi opinión'",
    "''",
    "NULL",
    "'Sobre esta pregunta no opino'",
)

LIKERT = [f"p{i}" for i in range(1, 16)]
OPEN = [f"p{i}a" for i in range(1, 16)]


def survey_select_list() -> list[str]:
    """Select-list expressions of the survey view over ``customer``."""
    exprs = [
        "c_custkey + 1 AS id",
        "CAST(CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE 18 + c_custkey % 63 END AS INT) AS edad",
        "c_mktsegment AS genero",
        f"split_part('{SIGNS}', ',', CAST(c_nationkey % 12 + 1 AS INT)) AS signo",
    ]
    for i in range(1, 16):
        exprs.append(
            f"CAST(CASE WHEN (c_custkey + {i}) % 17 = 0 THEN NULL "
            f"ELSE 1 + (c_custkey * {2 * i + 1} + c_nationkey * {i}) % 5 END AS INT) AS p{i}"
        )
    for i in range(1, 16):
        whens = " ".join(f"WHEN {k} THEN {OPEN_ANSWERS[k]}" for k in range(7))
        exprs.append(f"CASE (c_custkey + {i}) % 8 {whens} ELSE {OPEN_ANSWERS[7]} END AS p{i}a")
    return exprs


def survey_view(spark: SparkSession, data_dir: str, dealt: bool = False) -> DataFrame:
    """34-column survey frame: id, edad, genero, signo, p1..p15, p1a..p15a; ``dealt`` over all cores for work on its texts."""
    rows = table(spark, data_dir, "customer")
    return (spread(rows) if dealt else rows).selectExpr(*survey_select_list())


def survey_view_sql() -> str:
    """The same view as SQL text over a ``customer`` relation."""
    return "SELECT " + ",\n       ".join(survey_select_list()) + "\nFROM customer"


def with_survey(sql: str) -> str:
    """Prefix an oracle query with the survey view as a CTE."""
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        body = ", " + body[5:]
    return f"WITH survey_view AS ({survey_view_sql()})\n{body}"
