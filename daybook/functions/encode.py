"""Categorical encodings (F35-F38, N18).  Level lists are fixed
parameters, never discovered from the data, so every split gets the same
columns in the same order (reference defect handled by N18)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_map(key, mapping: dict, default: str = "Unknown") -> Column:
    """id to name, ``default`` when the id is unknown."""
    k = F.col(key) if isinstance(key, str) else key
    m = F.create_map(*[x for a, b in mapping.items() for x in (F.lit(a), F.lit(b))])
    return F.coalesce(F.try_element_at(m, k), F.lit(default))


def one_hot(col, levels: list, prefix: str, drop_first: bool = False) -> dict[str, Column]:
    """F36 (all levels) / F37 (first level dropped; unknown values give all
    zeros).  ``OneHotEncoder(dropLast=True)`` drops the last level instead,
    so the columns are built directly."""
    c = F.col(col) if isinstance(col, str) else col
    lv = list(levels)[1:] if drop_first else list(levels)
    return {f"{prefix}_{v}": F.coalesce((c == F.lit(v)), F.lit(False)).cast("int") for v in lv}


def substring_flags(col, conditions: dict[str, str]) -> dict[str, Column]:
    """flag per selected condition: description contains the text."""
    c = F.col(col) if isinstance(col, str) else col
    return {name: F.coalesce(c.contains(text), F.lit(False)).cast("int")
            for name, text in conditions.items()}


def align_columns(df: DataFrame, columns: list[str], fill=0) -> DataFrame:
    """Add missing columns (constant ``fill``) and fix the order."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in columns])
