"""Evaluation (V1-V12).  Errors are computed row-wise on joined
(key, actual, prediction) rows, never by position (reference defects D1,
D11, D22).  All metrics are single aggregate passes: sums of squares and
counts combine map-side, so a hot group costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import rnd
from .profile import histogram


def _e(actual: str, pred: str) -> Column:
    return F.col(actual) - F.col(pred)


def metric_aggs(actual: str = "actual", pred: str = "pred", digits: int | None = 6) -> list[Column]:
    """V1/V4 aggregate columns: n, MAE, RMSE, R^2, MAPE over non-zero
    actuals and its sample size.

    R^2 = 1 - SSE / SST with SST = sum(y^2) - sum(y)^2 / n (exact for
    integral actuals).
    """
    y, e = F.col(actual), _e(actual, pred)
    n = F.count(y)
    sse = F.sum(e * e)
    sst = F.sum(y * y) - F.sum(y) * F.sum(y) / n
    r = (lambda c: rnd(c, digits)) if digits is not None else (lambda c: c)
    nz = y != 0
    return [
        n.alias("n"),
        r(F.avg(F.abs(e))).alias("mae"),
        r(F.sqrt(F.avg(e * e))).alias("rmse"),
        r(F.lit(1.0) - sse / sst).alias("r2"),
        r(F.avg(F.when(nz, F.abs(e) / F.abs(y))) * 100).alias("mape"),
        F.count(F.when(nz, 1)).alias("mape_n"),
    ]


def error_metrics(df: DataFrame, actual: str = "actual", pred: str = "pred",
                  by: list[str] | None = None, digits: int | None = 6) -> DataFrame:
    """V1 (overall) / V2 (per key, e.g. group or split and group)."""
    aggs = metric_aggs(actual, pred, digits)
    return df.groupBy(*(by or [])).agg(*aggs)


def mape_eps(actual: str = "actual", pred: str = "pred", eps: float = 1e-7) -> Column:
    """V5: mean |(y - p) / (y + eps)| * 100; zero actuals blow up by design."""
    return F.avg(F.abs(_e(actual, pred) / (F.col(actual) + F.lit(eps)))) * 100


def asymmetric_huber(actual: str = "actual", pred: str = "pred", under: float = 2.5,
                     over: float = 0.7, scale: float = 0.2) -> Column:
    """V6: weighted Huber cost (delta 1), under-prediction weighted
    ``under``, over-prediction ``over``, minus ``scale`` x mean prediction."""
    e = _e(actual, pred)
    base = F.when(F.abs(e) <= 1, 0.5 * e * e).otherwise(F.abs(e) - 0.5)
    w = F.when(e > 0, F.lit(under)).otherwise(F.lit(over))
    return F.avg(w * base) - F.lit(scale) * F.avg(F.col(pred))


def signed_errors(frames: dict[str, DataFrame], keys: list[str], actual: str = "actual",
                  pred: str = "pred") -> DataFrame:
    """Union of labelled (split) error rows."""
    out = None
    for label, df in frames.items():
        part = df.select(F.lit(label).alias("split"), *keys, actual, pred,
                         _e(actual, pred).alias("error"))
        out = part if out is None else out.unionByName(part)
    return out


def mean_group_mae(df: DataFrame, group: str = "grp", actual: str = "actual",
                   pred: str = "pred") -> DataFrame:
    """V8: average of the per-group MAE (groups weigh equally)."""
    per = df.groupBy(group).agg(F.avg(F.abs(_e(actual, pred))).alias("mae"))
    return per.agg(rnd(F.avg("mae"), 6).alias("mean_group_mae"),
                   F.count(F.lit(1)).alias("n_groups"))


def error_histogram(df: DataFrame, actual: str = "actual", pred: str = "pred",
                    bins: int = 20) -> DataFrame:
    """V9: histogram of prediction minus actual."""
    return histogram(df.select((F.col(pred) - F.col(actual)).alias("err")), "err", bins)


def adjusted_r2(r2: Column, n: Column, p: Column) -> Column:
    """1 - (1 - R^2)(n - 1)/(n - p - 1)."""
    return F.lit(1.0) - (F.lit(1.0) - r2) * (n - 1) / (n - p - 1)


def split_comparison(df: DataFrame, split: str = "split", group: str = "grp",
                     actual: str = "actual", pred: str = "pred",
                     splits: tuple[str, ...] = ("train", "validation")) -> DataFrame:
    """V3: per group, MAE and RMSE of each split side by side."""
    e = _e(actual, pred)
    aggs = []
    for s in splits:
        m = F.col(split) == s
        aggs += [rnd(F.avg(F.when(m, F.abs(e))), 6).alias(f"mae_{s}"),
                 rnd(F.sqrt(F.avg(F.when(m, e * e))), 6).alias(f"rmse_{s}"),
                 F.count(F.when(m, 1)).alias(f"n_{s}")]
    return df.groupBy(group).agg(*aggs)


def aligned_daily_totals(a: DataFrame, b: DataFrame, day: str = "day", value: str = "value",
                         label_a: str = "a", label_b: str = "b") -> DataFrame:
    """Daily totals of two periods aligned by day offset from each
    period's first day (F22), outer-joined on the offset."""
    def totals(df, label):
        t = df.groupBy(day).agg(F.sum(value).alias(f"total_{label}"))
        start = t.select(F.min(day)).scalar()
        return t.select(F.datediff(F.col(day), start).alias("offset"), f"total_{label}")
    return totals(a, label_a).join(totals(b, label_b), "offset", "full")


def prediction_series(rows: DataFrame, later: DataFrame, day: str = "day", actual: str = "actual",
                      pred: str = "pred", value: str = "value") -> DataFrame:
    """Daily totals of a scored period (actual and predicted) and of a later
    period on one axis, ``offset`` days from the scored period's first day.  One
    aggregate over the tagged union; a series without rows on a day, or with
    nulls only, is null there."""
    none = F.lit(None).cast("double")
    both = rows.select(day, F.col(actual).cast("double").alias("__a"), F.col(pred).cast("double").alias("__p"), none.alias("__l"))
    both = both.unionByName(later.select(day, none.alias("__a"), none.alias("__p"), F.col(value).cast("double").alias("__l")))
    start = rows.select(F.min(day)).scalar()
    return both.groupBy(F.datediff(F.col(day), start).alias("offset")).agg(
        F.sum("__a").alias("total_actual"), F.sum("__p").alias("total_pred"), F.sum("__l").alias("total_later"))


def prediction_summary(df: DataFrame, pred: str = "pred", day: str = "day",
                       by: list[str] | None = None) -> DataFrame:
    """Distinct days, zeros, negatives, mean, min, max of predictions."""
    p = F.col(pred)
    return df.groupBy(*(by or [])).agg(
        F.count(p).alias("n"),
        F.countDistinct(day).alias("n_days"),
        F.count(F.when(p == 0, 1)).alias("n_zero"),
        F.count(F.when(p < 0, 1)).alias("n_negative"),
        rnd(F.avg(p), 6).alias("mean"),
        F.min(p).alias("min"),
        F.max(p).alias("max"),
    )
