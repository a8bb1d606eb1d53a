"""Column selection helpers (N16, N17, N19, U3).  Driver-side work on the
schema only; no data moves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numeric import rnd

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def columns_like(df: DataFrame, prefix: str | None = None, contains: str | None = None) -> list[str]:
    """Column names by prefix and/or substring."""
    out = df.columns
    if prefix is not None:
        out = [c for c in out if c.startswith(prefix)]
    if contains is not None:
        out = [c for c in out if contains in c]
    return out


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Numeric columns by schema type (booleans excluded)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)
            and f.name not in exclude]


def round_columns(df: DataFrame, cols: list[str], digits: int = 2) -> DataFrame:
    """Round the given columns."""
    return df.select(*[rnd(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def column_difference(expected: list[str], df: DataFrame) -> dict[str, list[str]]:
    """Missing and extra column names."""
    have = set(df.columns)
    return {"missing": [c for c in expected if c not in have],
            "extra": [c for c in df.columns if c not in set(expected)]}
