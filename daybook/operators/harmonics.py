"""Harmonic model (M9-M13): per-group discrete Fourier spectrum, top-k
harmonics, reconstruction / forecast and harmonic features.

The spectrum is one aggregate: a generator gives every row the frequencies
0..n/2 of its series, and the sums of y cos and y sin per (group, k) combine
map-side; the upper half mirrors the lower.  A series holds one value per day,
so the fan-out is bounded by the calendar, not by the fact volume.  Everything
after it (top-k, reconstruction, features) is joins and aggregates on
(group, harmonic) rows.  Convention: X_k = sum_t y_t exp(-2 pi i k t / n),
frequency k/n (negative from n/2 on), amplitude |X_k|, phase angle(X_k).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sizing import checked_broadcast
from .windows import time_index


def spectrum(series: DataFrame, group: str = "grp", day: str = "day",
             value: str = "value") -> DataFrame:
    """M9: ``(group, k, n, freq, amp, phase, re, im)`` for k = 0..n-1 of each
    group's series in day order (rows are treated as evenly spaced, like the
    reference; fill a day spine first for a gap-aware spectrum)."""
    n = F.count(F.lit(1)).over(W.partitionBy(group))
    y = series.select(group, F.col(value).cast("double").alias("__y"), time_index(group, day).alias("__t"), n.alias("n"))
    half = F.floor(F.col("n") / 2)
    turned = y.select(group, "n", "__y", "__t", F.explode(F.sequence(F.lit(0).cast("long"), half)).alias("k"))
    angle = F.lit(2 * math.pi) * F.col("k") * F.col("__t") / F.col("n")
    low = turned.groupBy(group, "k", "n").agg(F.sum(F.col("__y") * F.cos(angle)).alias("re"),
                                              (-F.sum(F.col("__y") * F.sin(angle))).alias("im"))
    both = F.when((F.col("k") > 0) & (2 * F.col("k") < F.col("n")), F.array(F.lit(1), F.lit(-1))).otherwise(F.array(F.lit(1)))
    full = low.withColumn("__side", F.explode(both)).select(
        group, F.when(F.col("__side") > 0, F.col("k")).otherwise(F.col("n") - F.col("k")).alias("k"), "n",
        "re", (F.col("im") * F.col("__side")).alias("im"))
    freq = F.when(2 * F.col("k") < F.col("n"), F.col("k")).otherwise(F.col("k") - F.col("n")) / F.col("n")
    return full.select(group, "k", "n", freq.alias("freq"), F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im")).alias("amp"),
                       F.atan2("im", "re").alias("phase"), "re", "im")


def dominant(spec: DataFrame, k: int = 4, group: str = "grp", one_sided: bool = True) -> DataFrame:
    """The ``k`` largest amplitudes per group, excluding k = 0.
    ``one_sided`` keeps frequencies 1..n/2 only; ``one_sided=False`` keeps
    the reference's behaviour where both members of a mirror pair can be
    picked (ties broken by the higher index)."""
    s = spec.where(F.col("k") > 0)
    if one_sided:
        s = s.where(F.col("k") <= F.floor(F.col("n") / 2))
    w = W.partitionBy(group).orderBy(F.col("amp").desc(), F.col("k").desc())
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def reconstruct(rows: DataFrame, spec: DataFrame, top: DataFrame, group: str = "grp",
                t: str = "t", with_mean: bool = True, scale: bool = True,
                name: str = "pred") -> DataFrame:
    """Mean + sum over the top harmonics of
    2 * amp/n * cos(2 pi freq t + phase) for every row's time index ``t``
    ((group, t) is unique per row).
    ``with_mean=False, scale=False`` gives the variant without the mean and
    the 1/n factor (off by default, reference defect D7).

    Rows join the (group, harmonic) table, a fan-out of k per row, and sum
    back per row: no Python."""
    dc = spec.where(F.col("k") == 0).select(group, (F.col("re") / F.col("n")).alias("__mean"))
    h = top.select(group, "freq", "amp", "phase", "n")
    j = rows.select(group, t).distinct().join(checked_broadcast(h), group)
    amp = F.col("amp") / F.col("n") if scale else F.col("amp")
    term = 2 * amp * F.cos(2 * math.pi * F.col("freq") * F.col(t) + F.col("phase"))
    s = j.groupBy(group, t).agg(F.sum(term).alias("__h"))
    out = rows.join(s, [group, t], "left").join(checked_broadcast(dc), group, "left")
    total = F.coalesce(F.col("__h"), F.lit(0.0))
    if with_mean:
        total = total + F.col("__mean")
    return out.withColumn(name, total).drop("__h", "__mean")


def continue_index(train: DataFrame, rows: DataFrame, group: str = "grp", day: str = "day",
                   restart: bool = False) -> DataFrame:
    """Time index for scored rows: continues after the training series
    (t = n_train + position), or restarts at 0 with ``restart`` (the
    reference's behaviour, defect D7)."""
    pos = rows.withColumn("t", time_index(group, day))
    if restart:
        return pos
    n = train.groupBy(group).agg(F.count(F.lit(1)).alias("__n"))
    return (pos.join(checked_broadcast(n), group, "left")
            .withColumn("t", F.col("t") + F.coalesce("__n", F.lit(0))).drop("__n"))


def harmonic_features(rows: DataFrame, spec: DataFrame, group: str = "grp", t: str = "t",
                      k: int = 5) -> DataFrame:
    """For each of the ``k`` largest amplitudes of the lower half (k = 0
    counts), the columns re * cos(2 pi freq t) and im * sin(2 pi freq t), from
    harmonics fitted on train only (defect D9); pivot over the fixed rank list,
    joined by key."""
    w = W.partitionBy(group).orderBy(F.col("amp").desc(), F.col("k").desc())
    lower = spec.where(F.col("k") < F.floor(F.col("n") / 2))
    h = lower.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(group, "rank", "freq", "re", "im")
    j = rows.select(group, t).distinct().join(checked_broadcast(h), group)
    angle = F.lit(2 * math.pi) * F.col("freq") * F.col(t)
    p = j.groupBy(group, t).pivot("rank", list(range(1, k + 1))).agg(
        F.first(F.col("re") * F.cos(angle)).alias("cos"), F.first(F.col("im") * F.sin(angle)).alias("sin"))
    for r in range(1, k + 1):
        p = p.withColumnRenamed(f"{r}_cos", f"harm_{r}_cos").withColumnRenamed(f"{r}_sin", f"harm_{r}_sin")
    return rows.join(p, [group, t], "left")
