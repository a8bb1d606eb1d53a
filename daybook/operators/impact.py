"""Event impact analysis (E1-E8): conditional aggregates over an event
flag; every statistic is one aggregate pass that combines map-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import rnd
from ..sizing import checked_broadcast
from .profile import describe

# Student t quantiles t(0.975, df) for df = 1..30 (two-sided
# 95% interval), from standard tables.
T975 = [12.7062047362, 4.30265272975, 3.18244630528, 2.7764451052, 2.57058183661,
        2.44691184879, 2.36462425101, 2.30600413503, 2.2621571628, 2.22813885196,
        2.20098516008, 2.17881282966, 2.16036865646, 2.14478668792, 2.13144954556,
        2.11990529922, 2.10981557783, 2.10092204024, 2.09302405441, 2.08596344727,
        2.07961384473, 2.0738730679, 2.06865761042, 2.06389856163, 2.05953855275,
        2.05552943864, 2.05183051648, 2.0484071418, 2.04522964213, 2.0422724563]
Z975 = 1.959963984540054


def t975(df: Column) -> Column:
    """t(0.975, df): table for df <= 30, Cornish-Fisher series in 1/df
    beyond (error below 1e-5 there); null for df < 1."""
    table = F.array(*[F.lit(v) for v in T975])
    z = Z975
    v = df.cast("double")
    series = (z + (z ** 3 + z) / (4 * v) + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / (96 * v * v)
              + (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / (384 * v * v * v))
    return (F.when(df < 1, F.lit(None).cast("double"))
            .when(df <= 30, F.element_at(table, df.cast("int")))
            .otherwise(series))


def flag_describe(df: DataFrame, flag: str, value: str, digits: int = 6) -> DataFrame:
    """Describe of ``value`` for event vs non-event rows."""
    return describe(df, [value], by=[flag], digits=digits)


def uplift(df: DataFrame, flag: str, value: str, by: list[str] | None = None,
           digits: int = 6) -> DataFrame:
    """(mean on event rows / mean on other rows - 1) x 100, per key;
    keys without event rows give no row (skipped like the reference)."""
    f = F.col(flag).cast("boolean")
    v = F.col(value)
    g = df.groupBy(*(by or [])).agg(
        F.avg(F.when(f, v)).alias("event_mean"), F.avg(F.when(~f, v)).alias("base_mean"),
        F.count(F.when(f, v)).alias("event_n"), F.count(F.when(~f, v)).alias("base_n"))
    return (g.where(F.col("event_n") > 0)
            .withColumn("uplift_pct", rnd((F.col("event_mean") / F.col("base_mean") - 1) * 100,
                                              digits))
            .withColumn("event_mean", rnd("event_mean", digits))
            .withColumn("base_mean", rnd("base_mean", digits)))


def event_intervals(df: DataFrame, event: str, value: str, by: list[str] | None = None,
                    min_samples: int = 2, warn_below: int = 5, digits: int = 6) -> DataFrame:
    """Mean, 95% t-interval half width (sem x t(0.975, n-1)) and sample
    count per event (and key); events below ``min_samples`` are dropped,
    ``small_sample`` marks counts below ``warn_below``."""
    v = F.col(value)
    g = df.groupBy(*(by or []), event).agg(F.count(v).alias("samples"), F.avg(v).alias("mean"),
                                           F.stddev_samp(v).alias("sd"))
    sem = F.col("sd") / F.sqrt(F.col("samples"))
    return (g.where(F.col("samples") >= min_samples)
            .select(*(by or []), event, "samples", rnd("mean", digits).alias("mean"),
                    rnd(sem * t975(F.col("samples") - 1), digits).alias("ci"),
                    (F.col("samples") < warn_below).alias("small_sample")))


def event_history(df: DataFrame, event_days: DataFrame, value: str, group: str = "grp",
                  day: str = "day", digits: int = 6) -> DataFrame:
    """E5: mean, std, min, max of ``value`` on event days, per group
    (semi join: filter only, the day set adds no columns)."""
    ev = df.join(checked_broadcast(event_days.select(day).distinct()), day, "left_semi")
    v = F.col(value)
    return ev.groupBy(group).agg(F.count(v).alias("n"), rnd(F.avg(v), digits).alias("mean"),
                                 rnd(F.stddev_samp(v), digits).alias("std"),
                                 F.min(v).alias("min"), F.max(v).alias("max"))


def event_rows(df: DataFrame, event_days: DataFrame, day: str = "day",
               order: list[str] | None = None) -> DataFrame:
    """Rows on event days, sorted."""
    ev = df.join(checked_broadcast(event_days.select(day).distinct()), day, "left_semi")
    return ev.orderBy(*(order or [day]))


def event_split_stats(df: DataFrame, flag: str, value: str, keys: list[str],
                      digits: int = 6) -> DataFrame:
    """E7 (keys = split) / E8 (keys = split, group): mean, max, min of event
    rows."""
    v = F.when(F.col(flag).cast("boolean"), F.col(value))
    return df.groupBy(*keys).agg(F.count(v).alias("n"), rnd(F.avg(v), digits).alias("mean"),
                                 F.max(v).alias("max"), F.min(v).alias("min"))
