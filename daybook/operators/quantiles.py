"""Exact quantiles of large groups (A1, A2, A26, N9, F27, F40) by distributed selection.

``percentile`` keeps every distinct value of a group in one aggregation buffer.
Here no buffer grows with a group: pivots from a bounded sketch cut a group's
values into intervals, one aggregate counts the rows between the pivots and at
each of them, and only the interval that holds a wanted rank is cut again, all
groups and columns at once.  The counts are exact, so the sketch decides how many
rounds there are, never the result.  An interval of at most ``bound`` rows is
sorted in one buffer.  The first round reads all rows, the next ones only those
of the intervals that are still wanted, which each round stores.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ..sizing import checked_broadcast

BOUND = 10_000  # rows of one interval that a buffer may hold
SKETCH = 10_000  # accuracy of the pivots' sketch: ranks are off by n / SKETCH
PIVOTS = 255  # cuts of an interval after the first round
FEW = 40  # cuts that are compared one by one in generated code


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", small: bool = True) -> DataFrame:
    """Null-safe join on ``keys``, which are kept once."""
    right = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(checked_broadcast(right) if small else right, on, how).drop(*[f"__r_{k}" for k in keys])


def _first_cuts(probs: list[float]) -> list[float]:
    """Two cuts around every wanted probability, outside the sketch's error."""
    return sorted({min(1.0, max(0.0, p + s * 2 / SKETCH)) for p in probs for s in (-1, 1)})


def _rows_of(values: DataFrame, intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Every value with the open interval it lies in; intervals do not overlap."""
    v = F.col("__v")
    inside = (F.col("__lo").isNull() | (v > F.col("__lo"))) & (F.col("__hi").isNull() | (v < F.col("__hi")))
    return _same(values.where(v.isNotNull()), intervals, keys).where(inside)


def _cut(values: DataFrame, open_: DataFrame, keys: list[str], cuts: list[float]) -> tuple[DataFrame, DataFrame]:
    """One round: (ranks found at a pivot, intervals that hold the other ranks)."""
    ids = [*keys, "__i"]
    bounds = open_.select(*ids, "__lo", "__hi")
    pivots = _rows_of(values, bounds, keys).groupBy(*ids).agg(
        F.percentile_approx("__v", cuts, SKETCH).alias("__p"))
    pivots = materialize(_same(bounds, pivots.withColumn("__p", F.array_sort(F.array_distinct("__p"))), ids))
    v, p = F.col("__v"), F.col("__p")
    # even bins lie between two pivots, odd ones are the rows equal to a pivot
    if len(cuts) <= FEW:
        below = reduce(lambda a, b: a + b, [F.coalesce((F.get(p, F.lit(i)) < v).cast("int"), F.lit(0)) for i in range(len(cuts))])
    else:
        below = F.size(F.filter(p, lambda x: x < v))
    place = 2 * below + F.array_contains(p, v).cast("int")
    bins = _rows_of(values, pivots, keys).groupBy(*ids, place.alias("__bin")).agg(F.count(F.lit(1)).alias("__n"))
    # at most 2 * cuts + 1 bins of an interval
    bins = bins.groupBy(*ids).agg(F.sort_array(F.collect_list(F.struct("__bin", "__n"))).alias("__bins"))
    each = _same(_same(open_.select(*ids, F.explode("__ranks").alias("__r")), pivots, ids), bins, ids)
    start = F.struct(F.lit(0).alias("bin"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("before"), F.lit(False).alias("hit"))
    seek = F.aggregate("__bins", start, lambda a, b: F.when(a["hit"], a).otherwise(F.struct(
        b["__bin"].alias("bin"), b["__n"].alias("n"),
        (a["before"] + a["n"]).alias("before"),
        (F.col("__r.at") < a["before"] + a["n"] + b["__n"]).alias("hit"))))
    each = materialize(each.withColumn("__s", seek).select(
        *keys, "__lo", "__hi", "__p", "__r", F.col("__s.bin").alias("__bin"), F.col("__s.n").alias("__n"),
        (F.col("__r.at") - F.col("__s.before")).alias("__at"), (F.col("__s.bin") / 2).cast("int").alias("__j")))
    odd = F.col("__bin") % 2 == 1
    found = each.where(odd).select(*keys, F.col("__r.rank").alias("rank"), F.get("__p", F.col("__j")).alias("value"))
    left = each.where(~odd).select(
        *keys, "__n", F.struct(F.col("__r.rank").alias("rank"), F.col("__at").alias("at")).alias("__x"),
        F.coalesce(F.get("__p", F.col("__j") - 1), "__lo").alias("__lo"),
        F.coalesce(F.get("__p", F.col("__j")), "__hi").alias("__hi"))
    left = left.groupBy(*keys, "__lo", "__hi", "__n").agg(F.sort_array(F.collect_list("__x")).alias("__ranks"))
    return found, left.withColumn("__i", F.col("__ranks")[0]["rank"])


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], by: list[str] | None = None,
                    bound: int = BOUND) -> DataFrame:
    """Rows ``(by..., column, p, value)``: the exact quantiles of every column,
    linear between neighbouring ranks as by ``percentile``.

    Nulls do not count, a null key is a group of its own, NaN is the largest
    value, a column without any value has null quantiles, and an empty table has
    no rows.
    """
    by = by or []
    names = [f"__g{i}" for i in range(len(by))]  # so that no key clashes with a column made here
    keys = [*names, "__c"]
    # 0.0 is added so that the two zeros are one value
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), (F.col(c).cast("double") + F.lit(0.0)).alias("v"))
                                for i, c in enumerate(cols)]))
    values = df.select(*[F.col(b).alias(n) for b, n in zip(by, names)], pairs.alias("__e")).select(
        *names, F.col("__e.c").alias("__c"), F.col("__e.v").alias("__v"))
    sizes = materialize(values.groupBy(*keys).agg(F.count("__v").alias("__n")))

    def position(p: Column) -> Column:
        return (F.col("__n") - 1) * p

    def ends(p: Column) -> Column:
        return F.array(F.floor(position(p)).cast("long"), F.ceil(position(p)).cast("long"))

    wanted = F.array(*[F.lit(float(p)) for p in probs])
    ranks = F.array_sort(F.array_distinct(F.flatten(F.transform(wanted, ends))))
    none = F.lit(None).cast("double")
    state = sizes.where(F.col("__n") > 0).select(
        *keys, "__n", none.alias("__lo"), none.alias("__hi"), F.lit(0).cast("long").alias("__i"),
        F.transform(ranks, lambda r: F.struct(r.alias("rank"), r.alias("at"))).alias("__ranks"))
    found, cuts = [], _first_cuts([float(p) for p in probs])
    while not (large := state.where(F.col("__n") > bound)).isEmpty():
        points, parts = _cut(values, large, keys, cuts)
        found.append(points)
        state = materialize(state.where(F.col("__n") <= bound).unionByName(parts))
        values = materialize(_rows_of(values, state.select(*keys, "__lo", "__hi"), keys).select(*keys, "__v"))
        cuts = [(i + 1) / (PIVOTS + 1) for i in range(PIVOTS)]
    buffers = _rows_of(values, state.select(*keys, "__i", "__lo", "__hi"), keys).groupBy(*keys, "__i").agg(
        F.sort_array(F.collect_list("__v")).alias("__vs"))
    found.append(_same(state.select(*keys, "__i", F.explode("__ranks").alias("__r")), buffers, [*keys, "__i"]).select(
        *keys, F.col("__r.rank").alias("rank"), F.get("__vs", F.col("__r.at").cast("int")).alias("value")))
    at_rank = reduce(DataFrame.unionByName, found).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("__m"))
    out = _same(sizes.select(*keys, "__n", F.explode(wanted).alias("p")), at_rank, keys, "left")
    pos, low, high = position(F.col("p")), F.floor(position(F.col("p"))).cast("long"), F.ceil(position(F.col("p"))).cast("long")
    a, b = F.element_at("__m", low), F.element_at("__m", high)
    value = F.when((low == high) | (a == b), a).otherwise((high - pos) * a + (pos - low) * b)
    column = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("__c") + 1)
    return out.select(*[F.col(n).alias(b) for b, n in zip(by, names)], column.alias("column"), "p",
                      F.when(F.col("__n") > 0, value).alias("value"))


def quantile_columns(df: DataFrame, col: str, named: dict[str, float], by: list[str] | None = None,
                     bound: int = BOUND) -> DataFrame:
    """The quantiles of one column side by side: one row per key, a column per
    name in ``named``."""
    rows = exact_quantiles(df, [col], list(named.values()), by, bound)
    return rows.groupBy(*(by or [])).agg(*[F.max(F.when(F.col("p") == float(p), F.col("value"))).alias(n)
                                          for n, p in named.items()])


def quantile_scalars(df: DataFrame, cols: list[str], probs: list[float], bound: int = BOUND) -> dict[str, list[Column]]:
    """Per column the quantiles of a whole frame as scalar subqueries of one
    stored table of cols x probs rows; null on an empty frame."""
    stored = materialize(exact_quantiles(df, cols, probs, bound=bound))
    return {c: [stored.where((F.col("column") == c) & (F.col("p") == float(p))).select(F.max("value")).scalar()
                for p in probs] for c in cols}


class Selection:
    """Quantiles of several columns of one frame, selected together: what would
    be a selection for every step that fits a column's quantiles is one."""

    def __init__(self, df: DataFrame, cols: list[str], probs: list[float], bound: int = BOUND):
        self.probs = [float(p) for p in probs]
        self.found = quantile_scalars(df, cols, self.probs, bound)

    def scalars(self, cols: list[str], probs: list[float]) -> dict[str, list[Column]]:
        return {c: [self.found[c][self.probs.index(float(p))] for p in probs] for c in cols}


def selected(df: DataFrame, cols: list[str], probs: list[float], select: bool | Selection) -> dict[str, list[Column]]:
    """The quantiles from a ``Selection`` on the same frame, else selected now."""
    return select.scalars(cols, probs) if isinstance(select, Selection) else quantile_scalars(df, cols, probs)
