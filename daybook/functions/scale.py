"""Scaling fitted on one frame and applied to others.

Fitted statistics are scalar subqueries over the fitting frame: Spark runs
each once, keeps the value as a literal and applies it anywhere, with no
join and nothing collected by hand.  Population standard deviation is
used, like the reference's scaler (MLlib's ``StandardScaler`` uses the
sample deviation, so it is not used here).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.quantiles import Selection, selected


def fit_standard(train: DataFrame, cols: list[str]) -> dict[str, tuple[Column, Column]]:
    """F39 fit: per column (mean, population std) over ``train``.  One
    aggregate pass; each statistic is read as a scalar subquery of it."""
    stats = train.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                      *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)])
    return {c: (stats.select(f"m_{i}").scalar(), stats.select(f"s_{i}").scalar())
            for i, c in enumerate(cols)}


def apply_standard(df: DataFrame, fitted: dict[str, tuple[Column, Column]],
                   suffix: str = "") -> DataFrame:
    """F39 apply: (x - mean) / std (std 0 maps to 0, like sklearn)."""
    out = df
    for c, (m, s) in fitted.items():
        z = F.when(s == 0, F.lit(0.0)).otherwise((F.col(c) - m) / s)
        out = out.withColumn(c + suffix, z)
    return out


def fit_robust(train: DataFrame, cols: list[str], select: bool | Selection = False) -> dict[str, tuple[Column, Column]]:
    """F40 fit: (median, IQR) per column, exact linear-interpolated
    quantiles (``RobustScaler`` in MLlib is approximate); by distributed
    selection where ``select`` is set (or a ``Selection`` of ``train``), for a
    train frame of any size."""
    if select:
        found = selected(train, cols, [0.25, 0.5, 0.75], select)
        return {c: (median, high - low) for c, (low, median, high) in found.items()}
    out = {}
    for c in cols:
        q = train.select(F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
        out[c] = (q.select(F.col("q")[1]).scalar(),
                  q.select(F.col("q")[2] - F.col("q")[0]).scalar())
    return out


def apply_robust(df: DataFrame, fitted, suffix: str = "") -> DataFrame:
    """F40 apply: (x - median) / IQR (IQR 0 maps to 1)."""
    out = df
    for c, (med, iqr) in fitted.items():
        den = F.when(iqr == 0, F.lit(1.0)).otherwise(iqr)
        out = out.withColumn(c + suffix, (F.col(c) - med) / den)
    return out


def double_standardize(train: DataFrame, others: list[DataFrame], numeric: list[str],
                       all_cols: list[str]) -> list[DataFrame]:
    """standardise the numeric columns, then the whole matrix again,
    both passes fitted on the (once-scaled) train frame."""
    f1 = fit_standard(train, numeric)
    tr1 = apply_standard(train, f1)
    f2 = fit_standard(tr1, all_cols)
    return [apply_standard(apply_standard(d, f1), f2) for d in [train, *others]]


def target_normalizer(train: DataFrame, target: str) -> tuple[Column, Column]:
    """F42 fit: train mean and population std of the target."""
    return fit_standard(train, [target])[target]


def normalize_target(x: Column, fitted: tuple[Column, Column]) -> Column:
    m, s = fitted
    return (x - m) / s


def denormalize_target(z: Column, fitted: tuple[Column, Column]) -> Column:
    m, s = fitted
    return z * s + m
