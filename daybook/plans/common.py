"""Building blocks shared by the queries: the panel, its calendars and the
enriched panel, each with its DuckDB twin as a CTE string."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import calendar as C
from ..operators import enrich as J
from ..session import materialize
from ..sizing import checked_broadcast
from ..sources import panel as P

# ---------------------------------------------------------------- Spark side


def years(panel: DataFrame) -> DataFrame:
    return C.years_of(panel, "day")


def holidays(panel: DataFrame) -> DataFrame:
    return C.national_holidays(years(panel))


def spine(spark: SparkSession, panel: DataFrame) -> DataFrame:
    return C.spine_of(panel)


def festival(panel: DataFrame) -> DataFrame:
    return C.festival_days(years(panel)).select("day")


def parade(panel: DataFrame) -> DataFrame:
    return C.nth_weekday(festival(panel), n=2, weekday=5).select("day")


def easter_saturdays(panel: DataFrame) -> DataFrame:
    return C.easter_table(years(panel)).select(F.col("easter_saturday").alias("day"))


EVENT_FLAGS = ["is_holiday", "prev_holiday", "next_holiday", "is_festival", "is_parade",
               "before_parade", "after_parade", "is_easter_saturday"]


def day_flags(panel: DataFrame) -> DataFrame:
    """All event flags of the panel's days in one table keyed by day.

    Every event set (holidays, festival, parade, Easter Saturday and the
    +-1 day shifts, J7/J8) is tagged, unioned and pivoted once over a fixed
    tag list, so the panel needs one join instead of one per flag.  The
    table has at most one row per calendar day of the panel's years; it is
    checkpointed, which also runs the calendar arithmetic only once.
    """
    def tags(df: DataFrame, shifts: list[tuple[int, str]]) -> DataFrame:
        # one pass over the event set emits every shifted tag
        arr = F.array(*[F.struct(F.date_add("day", k).alias("day"), F.lit(t).alias("tag"))
                        for k, t in shifts])
        return df.select(F.explode(arr).alias("e")).select("e.day", "e.tag")

    u = (tags(holidays(panel), [(0, "is_holiday"), (1, "prev_holiday"), (-1, "next_holiday")])
         .unionByName(tags(festival(panel), [(0, "is_festival")]))
         .unionByName(tags(parade(panel), [(0, "is_parade"), (-1, "before_parade"),
                                           (1, "after_parade")]))
         .unionByName(tags(easter_saturdays(panel), [(0, "is_easter_saturday")])))
    wide = u.groupBy("day").pivot("tag", EVENT_FLAGS).agg(F.max(F.lit(True)))
    return materialize(wide.select("day", *[F.coalesce(F.col(c), F.lit(False)).alias(c)
                                            for c in EVENT_FLAGS]))


def with_day_flags(df: DataFrame, flags: DataFrame, day: str = "day") -> DataFrame:
    """Left join of the day flags (size-checked broadcast); days without an
    event get false everywhere."""
    out = df.join(checked_broadcast(flags), day, "left")
    for c in EVENT_FLAGS:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(False)))
    return out


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel + daily measures (J1) + code text (J2) + event flags."""
    panel = P.panel_table(spark, sf_dir)
    daily = P.daily_table(spark, sf_dir)
    codes = P.code_dictionary(spark, sf_dir)
    out = J.left_enrich(panel, [(daily.select("day", "n_orders", "temp", "wind", "cloud", "code"),
                                 ["day"])])
    out = J.lookup(out, codes, "code", "prio_code", ["description"])
    out = with_day_flags(out, day_flags(panel))
    return out.withColumn("is_nye", D.is_new_years_eve("day"))


# ---------------------------------------------------------------- SQL side

YEARS = """years AS (
  SELECT CAST(unnest(range(lo, hi + 1)) AS INTEGER) AS year
  FROM (SELECT min(year(day)) AS lo, max(year(day)) AS hi FROM panel) b)"""

EASTER = """easter AS (
  SELECT year, make_date(year, CAST((h + l - 7 * m + 114) // 31 AS INTEGER),
                         CAST(((h + l - 7 * m + 114) % 31) + 1 AS INTEGER)) AS easter_sunday
  FROM (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM (
    SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM (
      SELECT *, (19 * a + b - d - g + 15) % 30 AS h FROM (
        SELECT year, year % 19 AS a, year // 100 AS b, year % 100 AS c, (year // 100) // 4 AS d,
               (year // 100) % 4 AS e, ((year // 100) + 8) // 25 AS f,
               ((year // 100) - ((year // 100) + 8) // 25 + 1) // 3 AS g,
               (year % 100) // 4 AS i, (year % 100) % 4 AS k
        FROM years) s1) s2) s3) s4)"""

HOLIDAYS = """holidays AS (
  SELECT DISTINCT day, year FROM (
    SELECT make_date(year, 1, 1) AS day, year FROM years
    UNION ALL SELECT make_date(year, 5, 1), year FROM years
    UNION ALL SELECT make_date(year, 10, 3), year FROM years
    UNION ALL SELECT make_date(year, 12, 25), year FROM years
    UNION ALL SELECT make_date(year, 12, 26), year FROM years
    UNION ALL SELECT CAST(easter_sunday - INTERVAL 2 DAY AS DATE), year FROM easter
    UNION ALL SELECT CAST(easter_sunday + INTERVAL 1 DAY AS DATE), year FROM easter
    UNION ALL SELECT CAST(easter_sunday + INTERVAL 39 DAY AS DATE), year FROM easter
    UNION ALL SELECT CAST(easter_sunday + INTERVAL 50 DAY AS DATE), year FROM easter) u)"""

SPINE = """spine AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day
  FROM (SELECT min(day) AS lo, max(day) AS hi FROM panel) b)"""

FESTIVAL = """festival AS (
  SELECT CAST(unnest(generate_series(ls - INTERVAL 8 DAY, ls, INTERVAL 1 DAY)) AS DATE) AS day
  FROM (SELECT CAST(make_date(year, 6, 30) - INTERVAL (isodow(make_date(year, 6, 30)) % 7) DAY AS DATE) AS ls
        FROM years) f)"""

PARADE = """parade AS (
  SELECT day FROM (
    SELECT day, row_number() OVER (PARTITION BY year(day) ORDER BY day) AS rn
    FROM festival WHERE isodow(day) = 6) p WHERE rn = 2)"""

EASTER_SAT = """easter_sat AS (SELECT CAST(easter_sunday - INTERVAL 1 DAY AS DATE) AS day FROM easter)"""


def calendar_ctes() -> str:
    return ",\n".join([YEARS, EASTER, HOLIDAYS, FESTIVAL, PARADE, EASTER_SAT])


ENRICHED = """enriched AS (
  SELECT p.day, p.grp, p.units, p.lines, d.n_orders, d.temp, d.wind, d.cloud, d.code,
         c.description,
         p.day IN (SELECT day FROM holidays) AS is_holiday,
         p.day IN (SELECT day FROM festival) AS is_festival,
         p.day IN (SELECT day FROM parade) AS is_parade,
         p.day IN (SELECT CAST(day - INTERVAL 1 DAY AS DATE) FROM parade) AS before_parade,
         p.day IN (SELECT CAST(day + INTERVAL 1 DAY AS DATE) FROM parade) AS after_parade,
         p.day IN (SELECT day FROM easter_sat) AS is_easter_saturday,
         (month(p.day) = 12 AND day(p.day) = 31) AS is_nye
  FROM panel p LEFT JOIN daily d ON p.day = d.day
  LEFT JOIN codes c ON d.code = c.prio_code)"""
