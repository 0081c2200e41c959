"""File sources and sinks.

Readers use an explicit schema (no inference pass over the data) and PERMISSIVE
mode with a corrupt-record column; writers produce a directory of part files,
one per task, never funnelled through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LIKERT, OPEN, SURVEY_SCHEMA, validate_columns
from .csv_split import parse_records, split_records

CORRUPT = "_corrupt_record"
#: Quoted cells may hold commas and doubled quotes.
FORMAT = {"header": True, "quote": '"', "escape": '"'}


def check_upload(path: str | None) -> None:
    """A path must be given; a file (a name with an extension) must end in .csv, a folder holds such files."""
    if not path:
        raise ValueError("no CSV file was given")
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    if "." in name and not name.endswith(".csv"):
        raise ValueError("the file must have the .csv extension")


def read_survey_csv(spark: SparkSession, path: str, schema: T.StructType = SURVEY_SCHEMA,
                    validate: bool = True, multi_line: bool | str = True) -> DataFrame:
    """CSV with header, typed by ``schema``; malformed rows kept with ``_corrupt_record``.

    ``multi_line``: quoted cells may hold line breaks, and each file is one task; ``"split"``: they may, and large files are
    split all the same (``csv_split``); False: they do not, and Spark splits large files.
    The header is validated against the survey contract (P1) before any data is read.
    """
    check_upload(path)
    read = spark.read.options(**FORMAT, multiLine=bool(multi_line), pathGlobFilter="*.csv")
    header = read.csv(path)
    if validate:
        ok, msg = validate_columns(header.columns)
        if not ok:
            raise ValueError(msg)
    names = set(header.columns)
    fields = [f for f in schema.fields if f.name in names]
    extra = [T.StructField(c, T.StringType()) for c in header.columns if c not in {f.name for f in fields}]
    by_name = {f.name: f for f in fields + extra}
    ordered = T.StructType([by_name[c] for c in header.columns] + [T.StructField(CORRUPT, T.StringType())])
    if multi_line == "split":
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.fields)
        return parse_records(split_records(spark, path), ddl, FORMAT | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}, True)
    return read.schema(ordered).options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema=False).csv(path)


def malformed_rows(df: DataFrame) -> DataFrame:
    """Rows the CSV parser could not type, with their raw text.  The parser types the columns that are asked for, so all of them
    are read: the second condition, which always holds, needs them."""
    cells = [c for c in df.columns if c != CORRUPT]
    return df.where(F.col(CORRUPT).isNotNull() & (F.xxhash64(*cells) % 2 < 2)).select(cells[0], CORRUPT)


def malformed_count(df: DataFrame) -> int:
    """Number of malformed rows, in one aggregate that reads all columns."""
    cells = [c for c in df.columns if c != CORRUPT]
    return df.agg(F.count_if(F.col(CORRUPT).isNotNull()).alias("bad"), *[F.count(c) for c in cells]).first()["bad"]


def read_csv_strings(spark: SparkSession, path: str, multi_line: bool | str = True) -> DataFrame:
    """Every column as a string (no inference); parse later per value with ``try_cast``.

    ``multi_line``: as in ``read_survey_csv``.
    """
    check_upload(path)
    read = spark.read.options(**FORMAT, multiLine=bool(multi_line), inferSchema=False)
    if multi_line == "split":
        ddl = ", ".join(f"`{c}` string" for c in read.csv(path).columns)
        return parse_records(split_records(spark, path), ddl, FORMAT, True)
    return read.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Header + one part file per task."""
    df.write.mode(mode).options(header=True, quote='"', escape='"').csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def quantitative_export(df: DataFrame) -> DataFrame:
    """Id, edad, p1..p15 and Cluster, whichever exist."""
    want = ["id", "edad"] + LIKERT + ["Cluster"]
    return df.select(*[c for c in want if c in df.columns])


def qualitative_export(df: DataFrame, polarity_col: str = "Polaridad_Sentimiento_Promedio") -> DataFrame:
    """Id, genero, signo, p1a..p15a, polarity and Cluster, whichever exist."""
    want = ["id", "genero", "signo"] + OPEN + [polarity_col, "Cluster"]
    return df.select(*[c for c in want if c in df.columns])


def dict_rows_export(df: DataFrame, columns: list[str]) -> DataFrame:
    """Explicit column order, every cell text, missing column or null -> ''."""
    have = set(df.columns)
    return df.select(*[(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit(""))
                     .alias(c) for c in columns])


def load_profile(df: DataFrame) -> DataFrame:
    """One row with the record count and the column list."""
    return df.agg(F.count(F.lit(1)).alias("total_registros")).select(
        "total_registros", F.array(*[F.lit(c) for c in df.columns]).alias("columnas"))
