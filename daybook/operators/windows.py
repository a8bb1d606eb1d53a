"""Window, ordering and set operators (W1-W9, U1-U4).  Every window is
partitioned by the panel group and ordered by day, so a partition is one
group's series (bounded by the number of days)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def rolling_mean(value: str, group: str = "grp", day: str = "day", rows: int = 7,
                 include_current: bool = True) -> Column:
    """Trailing mean over ``rows`` rows per group, at least one row.
    ``include_current=False`` gives the leak-free feature version
    (rows -rows..-1, reference defect D6)."""
    w = W.partitionBy(group).orderBy(day)
    frame = w.rowsBetween(-(rows - 1), 0) if include_current else w.rowsBetween(-rows, -1)
    return F.avg(value).over(frame)


def rolling_mean_days(value: str, group: str = "grp", day: str = "day", days: int = 7) -> Column:
    """W1 variant: trailing mean over calendar days (range frame on the day
    number), for gap-aware smoothing."""
    dn = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    w = W.partitionBy(group).orderBy(dn).rangeBetween(-(days - 1), 0)
    return F.avg(value).over(w)


def next_value(value: str, group: str = "grp", day: str = "day") -> Column:
    """Next row's value within the group (never across groups, D5)."""
    return F.lead(value).over(W.partitionBy(group).orderBy(day))


def time_index(group: str = "grp", day: str = "day") -> Column:
    """0..n-1 position inside the group."""
    return F.row_number().over(W.partitionBy(group).orderBy(day)) - 1


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Global top-k; Spark plans this as per-partition top-k and a
    final merge (no full sort of the input)."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: str, order: list[Column], k: int,
                    rank: str = "rank") -> DataFrame:
    """Top-k rows per group with a deterministic tie-break (callers
    pass one in ``order``)."""
    w = W.partitionBy(group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def distinct_union(df: DataFrame, a: str, b: str, name: str = "node") -> DataFrame:
    """Distinct values of two key columns together."""
    return df.select(F.col(a).alias(name)).union(df.select(F.col(b).alias(name))).distinct()


def distinct_days(df: DataFrame, day: str = "day") -> DataFrame:
    """U4."""
    return df.select(day).distinct()
