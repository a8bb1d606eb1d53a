"""Calendar generation (C1-C15): dates are data, built with column
expressions, generators and equi-joins; no Python per day.

Every calendar table holds at most one row per day (or per day and state),
so its size is bounded by the date range; joins against it go through
``checked_broadcast``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sizing import checked_broadcast

# Nationwide public holidays used by the reference calendar.
# Fixed-date holidays as (month, day): New Year, Labour Day, Unity Day,
# Christmas Day, Boxing Day.
FIXED_HOLIDAYS = [(1, 1), (5, 1), (10, 3), (12, 25), (12, 26)]
# Easter-relative holidays as day offsets from Easter Sunday: Good Friday,
# Easter Monday, Ascension Day, Whit Monday.
EASTER_OFFSETS = [-2, 1, 39, 50]


def _as_date(x) -> Column:
    if isinstance(x, Column):
        return F.to_date(x)
    return F.to_date(F.lit(str(x)))


def day_spine(spark: SparkSession, start, end, col: str = "day") -> DataFrame:
    """One row per day, ``start`` to ``end`` inclusive.

    ``start``/``end`` are date strings or Columns (e.g. scalar subqueries
    such as ``panel.select(F.min('day')).scalar()``).
    """
    return spark.range(1).select(
        F.explode(F.sequence(_as_date(start), _as_date(end), F.expr("INTERVAL 1 DAY"))).alias(col)
    )


def year_table(spark: SparkSession, first, last, col: str = "year") -> DataFrame:
    """Years ``first``..``last`` (ints or int Columns) as rows."""
    f = first if isinstance(first, Column) else F.lit(int(first))
    l_ = last if isinstance(last, Column) else F.lit(int(last))
    return spark.range(1).select(F.explode(F.sequence(f.cast("int"), l_.cast("int"))).alias(col))


def years_of(df: DataFrame, day_col: str = "day", col: str = "year") -> DataFrame:
    """Years spanned by ``df[day_col]``: one global aggregate (partial per
    task, one row out) expanded by a generator; nothing passes through the
    driver."""
    b = df.agg(F.min(F.year(day_col)).alias("lo"), F.max(F.year(day_col)).alias("hi"))
    return b.select(F.explode(F.sequence("lo", "hi")).alias(col))


def spine_of(df: DataFrame, day_col: str = "day", col: str = "day") -> DataFrame:
    """C1 over the first..last day of ``df`` (one aggregate + generator)."""
    b = df.agg(F.min(day_col).alias("lo"), F.max(day_col).alias("hi"))
    return b.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias(col))


# Anonymous Gregorian computus, one integer step per column.  Staged
# projections keep every intermediate computed once (a single nested
# expression would repeat the shared terms at every level).
_COMPUTUS = [
    ("_a", "year % 19"), ("_b", "year div 100"), ("_c", "year % 100"),
    ("_d", "_b div 4"), ("_e", "_b % 4"), ("_f", "(_b + 8) div 25"),
    ("_g", "(_b - _f + 1) div 3"), ("_h", "(19 * _a + _b - _d - _g + 15) % 30"),
    ("_i", "_c div 4"), ("_k", "_c % 4"), ("_l", "(32 + 2 * _e + 2 * _i - _h - _k) % 7"),
    ("_m", "(_a + 11 * _h + 22 * _l) div 451"), ("_t", "_h + _l - 7 * _m + 114"),
]


def easter_table(years: DataFrame, year_col: str = "year") -> DataFrame:
    """C2 + C4: Easter Sunday and Easter Saturday per year."""
    df = years.select(F.col(year_col).cast("int").alias("year"))
    for name, expr in _COMPUTUS:
        df = df.withColumn(name, F.expr(expr))
    e = F.make_date("year", F.expr("CAST(_t div 31 AS INT)"), F.expr("CAST(_t % 31 + 1 AS INT)"))
    return df.select("year", e.alias("easter_sunday"), F.date_sub(e, 1).alias("easter_saturday"))


def national_holidays(years: DataFrame, year_col: str = "year") -> DataFrame:
    """Holiday dates per year: the fixed dates plus Easter offsets.

    Output ``(day, year)``, one row per distinct holiday date.
    """
    e = easter_table(years, year_col)
    y = F.col("year")
    fixed = [F.make_date(y, F.lit(m), F.lit(d)) for m, d in FIXED_HOLIDAYS]
    moving = [F.date_add("easter_sunday", off) for off in EASTER_OFFSETS]
    return (e.select("year", F.explode(F.array(*fixed, *moving)).alias("day"))
            .select("day", "year").dropDuplicates(["day"]))


def workday(day: Column, is_holiday: Column) -> Column:
    """Monday-Friday and not a holiday."""
    return (F.weekday(day) < 5) & ~F.coalesce(is_holiday, F.lit(False))


def flag_days(df: DataFrame, days: DataFrame, flag: str, day_col: str = "day",
              shift: int = 0) -> DataFrame:
    """Add boolean ``flag`` = (``day_col`` + ``shift``) is in ``days``.

    Equi-join on the shifted key: a holiday on d+shift marks d.  The day set
    is a calendar (bounded by the date range), broadcast after a size check.
    """
    keys = days.select(F.date_sub(F.col(day_col), shift).alias("__k")).distinct()
    keys = keys.withColumn(flag, F.lit(True))
    out = df.join(checked_broadcast(keys), F.col(day_col) == F.col("__k"), "left").drop("__k")
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def holiday_calendar(spine: DataFrame, holidays: DataFrame) -> DataFrame:
    """Spine plus ``is_holiday``, ``prev_holiday``, ``next_holiday``,
    ``weekday`` and ``is_workday`` (C15)."""
    out = flag_days(spine, holidays, "is_holiday")
    out = flag_days(out, holidays, "prev_holiday", shift=-1)
    out = flag_days(out, holidays, "next_holiday", shift=1)
    return (out.withColumn("weekday", F.weekday("day"))
            .withColumn("is_workday", workday(F.col("day"), F.col("is_holiday"))))


def _weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def bridge_day_strict(cal: DataFrame) -> Column:
    """A weekday whose previous day is a holiday and next day a weekend
    day, or whose previous day is a weekend day and next day a holiday."""
    d = F.col("day")
    return ((F.weekday(d) < 5)
            & ((F.col("prev_holiday") & _weekend(F.date_add(d, 1)))
               | (_weekend(F.date_sub(d, 1)) & F.col("next_holiday"))))


def bridge_day_loose(cal: DataFrame) -> Column:
    """A Monday or Friday with a holiday on either side."""
    wd = F.weekday(F.col("day"))
    return wd.isin(0, 4) & (F.col("prev_holiday") | F.col("next_holiday"))


def day_before_holiday(cal: DataFrame, end=None) -> Column:
    """The next day is a holiday; the last day of the range is never
    flagged (clipped at range end) when ``end`` is given."""
    cond = F.col("next_holiday")
    if end is not None:
        cond = cond & (F.date_add(F.col("day"), 1) <= _as_date(end))
    return cond


def paydays(cal: DataFrame) -> DataFrame:
    """Per month the last working day, and the 15th and 25th rolled back
    to the nearest working day on or before them within the month.

    For every day the latest working day so far in its month is carried
    with a window partitioned by month (at most 31 rows each); the targets
    then read it off.  Output ``(day, kind)`` where kind is ``month_end``,
    ``d15`` or ``d25``.
    """
    month = F.trunc("day", "MM")
    w = W.partitionBy(month).orderBy("day").rowsBetween(W.unboundedPreceding, 0)
    carried = cal.select(
        "day",
        F.last(F.when(F.col("is_workday"), F.col("day")), ignorenulls=True).over(w).alias("pay"),
    )
    kind = (F.when(F.col("day") == F.last_day("day"), F.lit("month_end"))
            .when(F.dayofmonth("day") == 15, F.lit("d15"))
            .when(F.dayofmonth("day") == 25, F.lit("d25")))
    return (carried.where(kind.isNotNull() & F.col("pay").isNotNull())
            .select(F.col("pay").alias("day"), kind.alias("kind")))


def payday_window(day: Column) -> Column:
    """Day of month >= 25 or <= 3."""
    dom = F.dayofmonth(day)
    return (dom >= 25) | (dom <= 3)


def ranges_to_days(df: DataFrame, start: str, end: str, out: str = "day") -> DataFrame:
    """One row per day of each inclusive range (other columns kept)."""
    keep = [c for c in df.columns if c not in (start, end)]
    return df.select(*keep, F.explode(F.sequence(F.col(start), F.col(end))).alias(out))


def distinct_days(df: DataFrame, key: str, day: str = "day") -> DataFrame:
    """C11: distinct (key, day) pairs."""
    return df.select(key, day).distinct()


def merged_ranges(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Overlapping and adjoining inclusive ranges of a key as one:
    ``(key, start, end)``, disjoint, in place of one row per range and day.

    Ranges that begin on one day are combined map-side first (the longest
    counts), so the window over a key sees at most one row per day however
    many ranges there are.  A range begins an island when it starts after the
    running maximum of all earlier ends.  Ranges without a start or an end, or
    that end before they start, hold no day.
    """
    by_start = (df.where(F.col(start).isNotNull() & (F.col(end) >= F.col(start)))
                .groupBy(key, F.col(start).alias("__s")).agg(F.max(end).alias("__e")))
    w = W.partitionBy(key).orderBy("__s")
    reach = F.max("__e").over(w.rowsBetween(W.unboundedPreceding, -1))
    begins = F.when(reach.isNull() | (F.col("__s") > F.date_add(reach, 1)), 1).otherwise(0)
    islands = by_start.withColumn("__b", begins).withColumn("__i", F.sum("__b").over(w))
    return (islands.groupBy(key, "__i").agg(F.min("__s").alias(start), F.max("__e").alias(end))
            .select(key, start, end))


def dense_coverage(ranges: DataFrame, key: str, start, end, range_start: str = "start", range_end: str = "end",
                   day: str = "day") -> DataFrame:
    """``(key, day, depth)`` for start..end of every key: how many of its
    ranges hold the day.

    Each range adds 1 on its first day and takes 1 off after its last; these
    steps combine map-side to one row per key and day, and their running sum
    over the key's days is the depth.  No range is expanded.
    """
    lo, hi = _as_date(start), _as_date(end)
    steps = ranges.where(F.col(range_end) >= F.col(range_start)).select(key, F.explode(F.array(
        F.struct(F.greatest(F.col(range_start), lo).alias(day), F.lit(1).alias("__d")),
        F.struct(F.greatest(F.date_add(range_end, 1), lo).alias(day), F.lit(-1).alias("__d")))).alias("__x"))
    steps = steps.select(key, "__x.*").groupBy(key, day).agg(F.sum("__d").alias("__d"))
    grid = ranges.select(key).distinct().select(key, F.explode(F.sequence(lo, hi)).alias(day))
    w = W.partitionBy(key).orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    return (grid.join(steps, [key, day], "left")
            .select(key, day, F.sum(F.coalesce("__d", F.lit(0))).over(w).alias("depth")))


def dense_flag_calendar(flags: DataFrame, key: str, start, end, day: str = "day",
                        flag: str = "flag") -> DataFrame:
    """One row per (key, day) for start..end with a 0/1 ``flag``.

    The dense grid is generated per key with ``sequence`` (a generator, not
    a join), then the sparse flagged days are equi-joined in.
    """
    keys = flags.select(key).distinct()
    grid = keys.select(key, F.explode(F.sequence(_as_date(start), _as_date(end))).alias(day))
    marks = flags.select(key, day).distinct().withColumn("__m", F.lit(1))
    return (grid.join(marks, [key, day], "left")
            .select(key, day, F.coalesce("__m", F.lit(0)).alias(flag)))


# Transliteration of German letters for file-name slugs.
TRANSLITERATION = [("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"),
                   ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue")]


def slug(c: Column) -> Column:
    """Lower-case, umlauts transliterated, spaces and dashes to ``_``."""
    out = c
    for a, b in TRANSLITERATION:
        out = F.replace(out, F.lit(a), F.lit(b))
    out = F.lower(out)
    return F.regexp_replace(F.regexp_replace(out, r"[\s\-]+", "_"), r"[^a-z0-9_]", "")


def nth_weekday(days: DataFrame, n: int = 2, weekday: int = 5, day_col: str = "day",
                group: Column | None = None) -> DataFrame:
    """The ``n``-th day with the given weekday (Monday = 0) inside
    each group (default: the year); groups with fewer such days give no row.
    """
    g = group if group is not None else F.year(day_col)
    w = W.partitionBy(g.alias("__g")).orderBy(day_col)
    return (days.where(F.weekday(day_col) == weekday)
            .withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") == n).drop("__rn"))


def festival_days(years: DataFrame, year_col: str = "year", month: int = 6,
                  length: int = 9) -> DataFrame:
    """A recurring festival: the ``length`` days ending on the last Sunday of
    ``month`` (Saturday to Sunday for length 9)."""
    y = F.col(year_col).cast("int")
    last = F.last_day(F.make_date(y, F.lit(month), F.lit(1)))
    last_sunday = F.date_sub(last, (F.weekday(last) + 1) % 7)
    return years.select(
        y.alias("year"),
        F.explode(F.sequence(F.date_sub(last_sunday, length - 1), last_sunday)).alias("day"),
    )
