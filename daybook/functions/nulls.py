"""Null handling, clipping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.quantiles import Selection, selected


def fill_constant(df: DataFrame, cols: list[str], value) -> DataFrame:
    """N6 (flags to 0) / N7 (code sentinel -1) / N10 (constant)."""
    return df.fillna(value, subset=cols)


def mean_impute(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Fill with the mean of ``fit_on`` (the train split; reference
    defect D4 fills each split with its own mean).  Means are scalar
    subqueries of one aggregate pass."""
    src = fit_on if fit_on is not None else df
    stats = src.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)])
    out = df
    for i, c in enumerate(cols):
        out = out.withColumn(c, F.coalesce(F.col(c), stats.select(f"m_{i}").scalar()))
    return out


def median_impute(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None,
                  select: bool | Selection = False) -> DataFrame:
    """Fill with the exact median of ``fit_on`` (``Imputer('median')``
    is approximate); by distributed selection where ``select`` is set (or
    a ``Selection`` of that frame), for frames of any size."""
    src = fit_on if fit_on is not None else df
    if select:
        medians = selected(src, cols, [0.5], select)
        return df.withColumns({c: F.coalesce(F.col(c), m) for c, [m] in medians.items()})
    stats = src.agg(*[F.median(c).alias(f"m_{i}") for i, c in enumerate(cols)])
    out = df
    for i, c in enumerate(cols):
        out = out.withColumn(c, F.coalesce(F.col(c), stats.select(f"m_{i}").scalar()))
    return out


def ffill_bfill(df: DataFrame, cols: list[str], partition: list[str], order: str = "day") -> DataFrame:
    """Forward fill then backward fill within each partition
    (never across group borders, reference defect D5).  The backward fill is
    a forward fill over the reversed order: its frame grows by one row at a
    time, so either pass is linear in the rows."""
    fw = W.partitionBy(*partition).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    bw = W.partitionBy(*partition).orderBy(F.desc(order)).rowsBetween(W.unboundedPreceding, 0)
    out = df
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.last(c, ignorenulls=True).over(fw),
                                           F.last(c, ignorenulls=True).over(bw)))
    return out


def null_indicators(df: DataFrame, cols: list[str], prefix: str = "isnull_") -> DataFrame:
    """0/1 null indicator per column (taken before any fill)."""
    return df.select("*", *[F.col(c).isNull().cast("int").alias(prefix + c) for c in cols])


def presence_flag(c) -> Column:
    """1 where a nullable joined column is present."""
    col = F.col(c) if isinstance(c, str) else c
    return col.isNotNull().cast("int")


def clip_min(c, lo: float = 0.0) -> Column:
    """Clip at ``lo`` (null stays null)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isNull(), col).otherwise(F.greatest(col, F.lit(lo)))


def clip_unit(c) -> Column:
    """Clip to [0, 1]."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isNull(), col).otherwise(F.least(F.greatest(col, F.lit(0.0)), F.lit(1.0)))
