"""Aggregations and profiling.

Every operator is one or two aggregate passes.  Plain aggregates (count,
sum, avg, stddev, corr, min, max) combine map-side, so hot keys are cheap.
Exact quantiles (``percentile``) keep a value-count map per group; they run
on the daily panel, whose groups are bounded by the number of days.  For raw
fact-sized inputs there is distributed selection (``quantiles.py``), or
``approx=True``.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import rnd
from ..sizing import checked_broadcast
from .quantiles import quantile_columns

DESCRIBE_STATS = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def _quantile(c: Column, p: float, approx: bool) -> Column:
    if approx:
        return F.percentile_approx(c, p, 100000)
    return F.percentile(c, F.lit(p))


def _describe_aggs(col: str, approx: bool, digits: int | None) -> list[Column]:
    c = F.col(col).cast("double")
    r = (lambda x: rnd(x, digits)) if digits is not None else (lambda x: x)
    return [
        F.count(c).alias(f"{col}__count"),
        r(F.avg(c)).alias(f"{col}__mean"),
        r(F.stddev_samp(c)).alias(f"{col}__std"),
        F.min(c).alias(f"{col}__min"),
        r(_quantile(c, 0.25, approx)).alias(f"{col}__p25"),
        r(_quantile(c, 0.5, approx)).alias(f"{col}__p50"),
        r(_quantile(c, 0.75, approx)).alias(f"{col}__p75"),
        F.max(c).alias(f"{col}__max"),
    ]


def describe(df: DataFrame, cols: list[str], by: list[str] | None = None,
             approx: bool = False, digits: int | None = 6) -> DataFrame:
    """A1 (whole frame) / A2 (per key): one aggregate pass over all
    columns, then one row per (key, column) with count, mean, sample std,
    min, quartiles (linear interpolation, like pandas) and max."""
    by = by or []
    aggs = [a for c in cols for a in _describe_aggs(c, approx, digits)]
    wide = df.groupBy(*by).agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"),
                 *[F.col(f"{c}__{s}").cast("double").alias(s) for s in DESCRIBE_STATS])
        for c in cols]))
    return wide.select(*by, rows.alias("r")).select(*by, "r.*").withColumn(
        "count", F.col("count").cast("long"))


def mean_by(df: DataFrame, keys: list[str], value: str, std: bool = False,
            digits: int | None = None, name: str = "mean") -> DataFrame:
    """A3 (mean by key) / A4 (mean and sample std, rounded)."""
    r = (lambda x: rnd(x, digits)) if digits is not None else (lambda x: x)
    aggs = [r(F.avg(value)).alias(name)]
    if std:
        aggs.append(r(F.stddev_samp(value)).alias("std"))
    return df.groupBy(*keys).agg(*aggs)


def split_side_by_side(df: DataFrame, group: str, split: str, value: str,
                       splits: tuple[str, ...], digits: int = 6) -> DataFrame:
    """A5: mean, std and count per group for every split, side by side
    (conditional aggregates over a fixed split list = a pivot)."""
    aggs = []
    v = F.col(value)
    for s in splits:
        m = F.col(split) == s
        aggs += [rnd(F.avg(F.when(m, v)), digits).alias(f"mean_{s}"),
                 rnd(F.stddev_samp(F.when(m, v)), digits).alias(f"std_{s}"),
                 F.count(F.when(m, v)).alias(f"count_{s}")]
    return df.groupBy(group).agg(*aggs)


def basic_stats(df: DataFrame, keys: list[str], value: str, digits: int = 6) -> DataFrame:
    """Count, mean, std, min, max by key."""
    v = F.col(value)
    return df.groupBy(*keys).agg(
        F.count(v).alias("count"), rnd(F.avg(v), digits).alias("mean"),
        rnd(F.stddev_samp(v), digits).alias("std"), F.min(v).alias("min"),
        F.max(v).alias("max"))


def daily_total(df: DataFrame, value: str, day: str = "day", name: str = "total") -> DataFrame:
    """Total over groups per day."""
    return df.groupBy(day).agg(F.sum(value).alias(name))


def monthly_mean(df: DataFrame, value: str, day: str = "day", keys: list[str] | None = None,
                 digits: int = 6) -> DataFrame:
    """Monthly mean trend (month bucket = first day of month, F17)."""
    return df.groupBy(F.trunc(day, "MM").alias("month"), *(keys or [])).agg(
        rnd(F.avg(value), digits).alias("mean"), F.count(value).alias("n"))


def actual_pred_by(df: DataFrame, keys: list[str], actual: str = "actual",
                   pred: str = "pred", digits: int = 6) -> DataFrame:
    """Actual and predicted mean (and std) per key."""
    r = lambda x: rnd(x, digits)
    return df.groupBy(*keys).agg(
        F.count(actual).alias("n"),
        r(F.avg(actual)).alias("actual_mean"), r(F.stddev_samp(actual)).alias("actual_std"),
        r(F.avg(pred)).alias("pred_mean"), r(F.stddev_samp(pred)).alias("pred_std"))


def pivot_sum(df: DataFrame, row: str, col: str, value: str, levels: list,
              agg: str = "sum", prefix: str = "") -> DataFrame:
    """Pivot with a fixed level list (no extra job to find
    the levels, stable column order)."""
    g = df.groupBy(row).pivot(col, levels)
    out = g.sum(value) if agg == "sum" else g.avg(value)
    if prefix:
        for lv in levels:
            out = out.withColumnRenamed(str(lv), f"{prefix}{lv}")
    return out


def melt(df: DataFrame, ids: list[str], values: list[str], var: str = "series",
         value: str = "value") -> DataFrame:
    """Wide to long."""
    return df.unpivot(ids, values, var, value)


def percent_difference(df: DataFrame, keys: list[str], actual: str = "actual",
                       pred: str = "pred", digits: int = 6) -> DataFrame:
    """(mean pred - mean actual) / mean actual * 100 per key."""
    a, p = F.avg(actual), F.avg(pred)
    return df.groupBy(*keys).agg(rnd((p - a) / a * 100, digits).alias("pct_diff"))


def safe_corr(a: str, b: str) -> Column:
    """Pearson correlation over the rows where both sides are present; null
    when either side is constant (``corr`` raises a division error under
    ANSI mode there)."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x = F.when(both, F.col(a).cast("double"))
    y = F.when(both, F.col(b).cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlation_pairs(df: DataFrame, cols: list[str], digits: int = 6,
                      upper: bool = True) -> DataFrame:
    """Every pair's Pearson correlation in one aggregate pass;
    rows ``(a, b, corr)``.  ``upper`` keeps a < b only (A20); otherwise the
    full matrix including the diagonal (A18).  Nulls drop per pair."""
    pairs = (list(itertools.combinations(cols, 2)) if upper
             else list(itertools.product(cols, cols)))
    aggs = [safe_corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                 rnd(F.col(f"c{i}"), digits).alias("corr"))
        for i, (a, b) in enumerate(pairs)]))
    return wide.select(rows.alias("r")).select("r.*")


def target_correlation(df: DataFrame, target: str, cols: list[str], digits: int = 6) -> DataFrame:
    """Correlation of each column to ``target`` (one aggregate pass),
    ordered by absolute value with the target itself first."""
    wide = df.agg(*[safe_corr(target, c).alias(f"c{i}") for i, c in enumerate(cols)])
    rows = F.explode(F.array(
        F.struct(F.lit(target).alias("column"), F.lit(1.0).alias("corr")),
        *[F.struct(F.lit(c).alias("column"), rnd(F.col(f"c{i}"), digits).alias("corr"))
          for i, c in enumerate(cols)]))
    out = wide.select(rows.alias("r")).select("r.*")
    return out.orderBy(F.when(F.col("column") == target, 0).otherwise(1),
                       F.abs("corr").desc_nulls_last(), "column")


def missing_summary(df: DataFrame, cols: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Missing count and percentage per column, only columns with
    missing values."""
    cols = cols or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"m{i}") for i, c in enumerate(cols)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing"))
                               for i, c in enumerate(cols)]))
    return (wide.select("__n", rows.alias("r")).select("__n", "r.*")
            .where(F.col("missing") > 0)
            .select("column", "missing",
                    rnd(F.col("missing") / F.col("__n") * 100, digits).alias("pct")))


def missing_by(df: DataFrame, keys: list[Column], cols: list[str]) -> DataFrame:
    """A22 (by year / month) / A24 (by day): null counts per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"),
                                 *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}")
                                   for c in cols])


def nullity_correlation(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Correlation of the null indicators; a constant indicator gives
    null."""
    ind = df.select(*[F.col(c).isNull().cast("int").alias(c) for c in cols])
    return correlation_pairs(ind, cols, digits, upper=True)


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max] (the max falls in the last
    bin); rows ``(bin, lo, hi, count)``.  min/max arrive as scalar
    subqueries."""
    lo = df.select(F.min(col)).scalar()
    hi = df.select(F.max(col)).scalar()
    width = (hi - lo) / bins
    b = F.least(F.floor((F.col(col) - lo) / width).cast("int") + 1, F.lit(bins))
    b = F.when(width == 0, F.lit(1)).otherwise(b)
    return (df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
            .select("bin", (lo + (F.col("bin") - 1) * width).alias("lo"),
                    (lo + F.col("bin") * width).alias("hi"), "count"))


def box_stats(df: DataFrame, keys: list[str], value: str, approx: bool = False,
              digits: int = 6, select: bool = False) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (most extreme values inside the
    fences) and outlier count per key.  Two passes: quartiles per key, then
    conditional min/max/count against the joined fences.  ``select`` takes the
    quartiles by distributed selection, for groups of any size."""
    v = F.col(value)
    if select:
        q = quantile_columns(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys)
    else:
        q = df.groupBy(*keys).agg(
            _quantile(v, 0.25, approx).alias("q1"), _quantile(v, 0.5, approx).alias("median"),
            _quantile(v, 0.75, approx).alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    if not keys:  # one fence row: join on a constant key, broadcast
        df, q, keys = df.withColumn("__all", F.lit(1)), q.withColumn("__all", F.lit(1)), ["__all"]
    j = df.join(checked_broadcast(q), keys)
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    inside = (v >= lo_f) & (v <= hi_f)
    return j.groupBy(*keys, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, v)).alias("whisker_lo"), F.max(F.when(inside, v)).alias("whisker_hi"),
        F.count(F.when(~inside, 1)).alias("n_outliers")).select(
        *keys, *[rnd(c, digits).alias(c) for c in ("q1", "median", "q3", "iqr")],
        "whisker_lo", "whisker_hi", "n_outliers").drop("__all")


def kde_grid(df: DataFrame, value: str, by: str, grid: int = 200, cut: float = 3.0,
             digits: int = 9) -> DataFrame:
    """Gaussian kernel density per key on ``grid`` points from
    min - cut*bw to max + cut*bw, bandwidth by Scott's rule
    (sample std x n^(-1/5)).

    Each value is expanded over the grid with a generator (bounded fan-out
    ``grid``), and the kernel sums combine map-side per (key, point)."""
    v = F.col(value)
    st = df.groupBy(by).agg(F.count(v).alias("n"), F.stddev_samp(v).alias("sd"),
                            F.min(v).alias("lo"), F.max(v).alias("hi"))
    st = st.withColumn("bw", F.col("sd") * F.pow(F.col("n"), -0.2))
    st = st.withColumn("g0", F.col("lo") - cut * F.col("bw")).withColumn(
        "step", (F.col("hi") - F.col("lo") + 2 * cut * F.col("bw")) / (grid - 1))
    j = df.select(by, value).join(checked_broadcast(st), by)  # one row per key
    x = (F.col("g0") + F.col("k") * F.col("step"))
    u = (x - v) / F.col("bw")
    e = j.select(by, "n", "bw", "g0", "step", value,
                 F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("k"))
    dens = e.groupBy(by, "k", "n", "bw", "g0", "step").agg(F.sum(F.exp(-0.5 * u * u)).alias("s"))
    return dens.select(by, "k", rnd(x, digits).alias("x"),
                       rnd(F.col("s") / (F.col("n") * F.col("bw") * math.sqrt(2 * math.pi)),
                               digits).alias("density"))


def global_range(frames: list[DataFrame], value: str, pad: float = 0.1) -> DataFrame:
    """Min and max over several series, padded by ``pad`` x range, the
    lower end not below 0."""
    u = frames[0].select(value)
    for f in frames[1:]:
        u = u.unionByName(f.select(value))
    r = u.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    p = (F.col("hi") - F.col("lo")) * pad
    return r.select("lo", "hi", F.greatest(F.lit(0.0), F.col("lo") - p).alias("axis_lo"),
                    (F.col("hi") + p).alias("axis_hi"))


def availability_ratio(fit_on: DataFrame, rows: DataFrame, group: str = "grp", day: str = "day") -> DataFrame:
    """Rows per (month of the year, group) over distinct days per month
    of the year, fitted on ``fit_on`` and joined to ``rows`` on (month, group),
    so later rows find their ratio too."""
    m, df = F.month(day), fit_on
    per_g = df.groupBy(m.alias("month"), group).agg(F.count(F.lit(1)).alias("g_days"))
    per_m = df.groupBy(m.alias("month")).agg(F.countDistinct(day).alias("m_days"))
    ratio = per_g.join(per_m, "month").select(
        "month", group, (F.col("g_days") / F.col("m_days")).alias("availability"))
    return rows.withColumn("month", m).join(checked_broadcast(ratio), ["month", group], "left")


def business_year(day: Column, start_month: int = 8) -> Column:
    """Business year starting in ``start_month`` (Aug-Jul by default),
    named by its first calendar year."""
    return F.year(F.add_months(day, -(start_month - 1)))


def group_mean_spread(df: DataFrame, group: str, value: str, scale: float = 10.0) -> DataFrame:
    """Standard deviation of the group means, times ``scale``."""
    means = df.groupBy(group).agg(F.avg(value).alias("m"))
    return means.agg((F.stddev_samp("m") * scale).alias("score"))


def integrity_profile(df: DataFrame, required: list[str], day: str = "day",
                      pred: str | None = None) -> dict:
    """Schema diff in the driver (column names only) plus one
    aggregate row: row count, date range and negative predictions."""
    missing = sorted(set(required) - set(df.columns))
    aggs = [F.count(F.lit(1)).alias("rows"), F.min(day).alias("first_day"),
            F.max(day).alias("last_day")]
    if pred:
        aggs.append(F.count(F.when(F.col(pred) < 0, 1)).alias("negative_predictions"))
    return {"missing_columns": missing, "summary": df.agg(*aggs)}


def bad_value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null / NaN / infinite counts per column of a feature matrix."""
    rows = []
    for c in cols:
        x = F.col(c).cast("double")
        rows.append(F.struct(
            F.lit(c).alias("column"),
            F.count(F.when(x.isNull(), 1)).alias("n_null"),
            F.count(F.when(F.isnan(x), 1)).alias("n_nan"),
            F.count(F.when(F.abs(x) == float("inf"), 1)).alias("n_inf")))
    return df.agg(F.array(*rows).alias("a")).select(F.explode("a").alias("r")).select("r.*")


def split_span(df: DataFrame, split: str = "split", day: str = "day") -> DataFrame:
    """Row count and date span per split."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("rows"), F.min(day).alias("first_day"),
                                 F.max(day).alias("last_day"),
                                 F.countDistinct(day).alias("days"))
