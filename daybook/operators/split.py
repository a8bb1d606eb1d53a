"""Splits (N1-N4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_window(df: DataFrame, start: str, end: str, day: str = "day") -> DataFrame:
    """Closed date range (pushed to the scan when ``day`` is a column
    of the source)."""
    return df.where(F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def before(df: DataFrame, cut: str, day: str = "day") -> DataFrame:
    """Strictly before the cut-off."""
    return df.where(F.col(day) < F.lit(cut).cast("date"))


def outside_window(df: DataFrame, start: str, end: str, day: str = "day") -> DataFrame:
    """Complement of the closed window."""
    return df.where(~F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def hash_bucket(day: str = "day", key: str = "grp", buckets: int = 100, seed: int = 42) -> Column:
    """Deterministic pseudo-random bucket 0..buckets-1 of (day, key).

    A multiplicative hash of the day number and the key (seeded), so the
    split is reproducible whatever the partitioning (``randomSplit`` is
    not) and can be written in any SQL dialect.
    """
    dn = F.datediff(F.col(day), F.lit("1970-01-01").cast("date")).cast("long")
    k = F.col(key).cast("long")
    h = (dn * 2654435761 + k * 40503 + seed * 9973) % 1000003
    return (h % buckets).cast("int")


def random_split(df: DataFrame, train_pct: int = 80, day: str = "day", key: str = "grp",
                 seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Seeded 80/20 split by ``hash_bucket``."""
    b = hash_bucket(day, key, 100, seed)
    return df.where(b < train_pct), df.where(b >= train_pct)
