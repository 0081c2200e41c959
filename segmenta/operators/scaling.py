"""Feature scaling (M1, M2) as fit/transform pairs.

``fit`` is one aggregate over all columns whose single result row (2 numbers per
column) is the model; ``transform`` is a narrow projection with those numbers as
literals, so it also runs on a streaming DataFrame.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import nan_as_null, present


@dataclass
class MinMaxModel:
    """M1 parameters: per column (min, max); columns with no value are left untouched."""
    bounds: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        """(x - min) / (max - min); null -> 0.0; constant column -> 0.0 on every row."""
        out = []
        df = nan_as_null(df, self.bounds)
        for c in df.columns:
            if c in self.bounds and self.bounds[c][0] is not None:
                lo, hi = self.bounds[c]
                if hi == lo:
                    e = F.lit(0.0)
                else:
                    e = F.when(F.col(c).isNull(), F.lit(0.0)).otherwise(
                        (F.col(c).cast("double") - F.lit(float(lo))) / F.lit(float(hi - lo)))
                out.append(e.alias(c))
            else:
                out.append(F.col(c))
        return df.select(*out)

    def to_json(self) -> str:
        return json.dumps({"kind": "minmax", "bounds": self.bounds})


@dataclass
class StandardModel:
    """M2 parameters: per column (mean, population sd); sd 0 scales by 1."""
    moments: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        out = []
        df = nan_as_null(df, self.moments)
        for c in df.columns:
            if c in self.moments and self.moments[c][0] is not None:
                mu, sd = self.moments[c]
                sd = sd if sd else 1.0
                out.append(((F.col(c).cast("double") - F.lit(float(mu))) / F.lit(float(sd))).alias(c))
            else:
                out.append(F.col(c))
        return df.select(*out)

    def inverse(self, cols: list[str], rows: list[list[float]]) -> list[list[float]]:
        """Map scaled vectors (e.g. centroids) back to original units."""
        res = []
        for r in rows:
            res.append([v * (self.moments[c][1] or 1.0) + self.moments[c][0] for c, v in zip(cols, r)])
        return res

    def to_json(self) -> str:
        return json.dumps({"kind": "standard", "moments": self.moments})


def minmax_fit(df: DataFrame, cols: list[str]) -> MinMaxModel:
    cols = present(df, cols)
    df = nan_as_null(df, cols)
    row = df.agg(*[F.min(c).cast("double").alias(f"a{i}") for i, c in enumerate(cols)],
                 *[F.max(c).cast("double").alias(f"b{i}") for i, c in enumerate(cols)]).first()
    return MinMaxModel({c: (row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(cols)})


def minmax(df: DataFrame, cols: list[str]) -> DataFrame:
    """M1: fit on ``df`` and transform it."""
    return minmax_fit(df, cols).transform(df)


def standard_fit(df: DataFrame, cols: list[str]) -> StandardModel:
    cols = present(df, cols)
    df = nan_as_null(df, cols)
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    return StandardModel({c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)})


def standardise(df: DataFrame, cols: list[str]) -> DataFrame:
    """M2: (x - mean) / population sd, fitted on ``df``."""
    return standard_fit(df, cols).transform(df)


def model_from_json(text: str):
    d = json.loads(text)
    if d["kind"] == "minmax":
        return MinMaxModel({k: tuple(v) for k, v in d["bounds"].items()})
    return StandardModel({k: tuple(v) for k, v in d["moments"].items()})
