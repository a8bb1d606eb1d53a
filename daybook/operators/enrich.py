"""Enrichment joins (J1-J10).  The fact side (the panel or raw rows) is
never shuffled for a daily side table: side tables hold one row per day (or
per code / state) and go out as size-checked broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sizing import checked_broadcast


def left_enrich(fact: DataFrame, sides: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Chained left joins of daily side tables on their keys.  Each
    side is projected to its key and value columns by the caller (J6)."""
    out = fact
    for side, keys in sides:
        out = out.join(checked_broadcast(side), keys, "left")
    return out


def lookup(fact: DataFrame, table: DataFrame, left_key: str, right_key: str,
           keep: list[str]) -> DataFrame:
    """Left lookup on differently named keys; only ``keep`` columns of
    the table come along."""
    t = table.select(F.col(right_key).alias("__lk"), *keep)
    return fact.join(checked_broadcast(t), F.col(left_key) == F.col("__lk"), "left").drop("__lk")


def month_day_profile(fact: DataFrame, history: DataFrame, value: str, day: str = "day",
                      name: str = "md_mean") -> DataFrame:
    """Join on (month, day of month) across years; the history side is
    reduced to one row per key first (the reference fans out, defect D8)."""
    prof = history.groupBy(F.month(day).alias("__m"), F.dayofmonth(day).alias("__d")).agg(
        F.avg(value).alias(name))
    f = fact.withColumn("__m", F.month(day)).withColumn("__d", F.dayofmonth(day))
    return f.join(checked_broadcast(prof), ["__m", "__d"], "left").drop("__m", "__d")


def within_range_of(events: DataFrame, fact: DataFrame, day: str = "day") -> DataFrame:
    """Keep events inside the fact's first..last day; the bounds are
    scalar subqueries (no cross join)."""
    lo = fact.select(F.min(day)).scalar()
    hi = fact.select(F.max(day)).scalar()
    return events.where(F.col(day).between(lo, hi))


def pivot_states(dense: DataFrame, state: str, day: str, flag: str, states: list[str],
                 prefix: str = "") -> DataFrame:
    """Dense per-state flags to one column per state (a single pivot),
    ready for one join on ``day`` instead of one join per state."""
    p = dense.groupBy(day).pivot(state, states).agg(F.max(flag))
    for s in states:
        p = p.withColumnRenamed(s, f"{prefix}{s}")
    return p
