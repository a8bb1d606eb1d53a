"""Calendar queries (C1-C15, J9, J10) over the years and days the panel
spans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calendar as C
from ..operators import enrich as J
from ..sources import panel as P
from ..session import materialize
from ..sizing import checked_broadcast
from ..sources.tables import read_table
from . import common as Q
from . import sqlparts as S
from .registry import query

CAL = f"WITH {S.PANEL},\n{Q.calendar_ctes()}"


def calendar_spine(spark, sf_dir):
    """C1, C3, C5, C6, C7, C9, C15 over the panel's day range."""
    panel = P.panel_table(spark, sf_dir)
    hi = panel.select(F.max("day")).scalar()
    cal = Q.with_day_flags(Q.spine(spark, panel), Q.day_flags(panel))
    cal = cal.withColumn("weekday", F.weekday("day")).withColumn(
        "is_workday", C.workday(F.col("day"), F.col("is_holiday")))
    return cal.select(
        "day", "weekday", "is_holiday", "is_workday",
        C.bridge_day_strict(cal).alias("bridge_strict"),
        C.bridge_day_loose(cal).alias("bridge_loose"),
        C.day_before_holiday(cal, hi).alias("day_before_holiday"),
        C.payday_window(F.col("day")).alias("payday_window"))


query("c01_calendar_spine", f"""{CAL},
{Q.SPINE},
cal AS (
  SELECT day, {S.wd('day')} AS weekday,
         day IN (SELECT day FROM holidays) AS is_holiday,
         CAST(day - INTERVAL 1 DAY AS DATE) IN (SELECT day FROM holidays) AS prev_holiday,
         CAST(day + INTERVAL 1 DAY AS DATE) IN (SELECT day FROM holidays) AS next_holiday
  FROM spine)
SELECT day, weekday, is_holiday,
       (weekday < 5 AND NOT is_holiday) AS is_workday,
       (weekday < 5 AND ((prev_holiday AND isodow(day + INTERVAL 1 DAY) >= 6)
                         OR (isodow(day - INTERVAL 1 DAY) >= 6 AND next_holiday))) AS bridge_strict,
       (weekday IN (0, 4) AND (prev_holiday OR next_holiday)) AS bridge_loose,
       (next_holiday AND day + INTERVAL 1 DAY <= (SELECT max(day) FROM panel)) AS day_before_holiday,
       (day(day) >= 25 OR day(day) <= 3) AS payday_window
FROM cal
""")(calendar_spine)


def easter_dates(spark, sf_dir):
    """C2 + C4: Easter Sunday and Saturday per panel year."""
    return C.easter_table(Q.years(P.panel_days(spark, sf_dir)))


query("c02_easter_dates", f"""{CAL}
SELECT year, easter_sunday, CAST(easter_sunday - INTERVAL 1 DAY AS DATE) AS easter_saturday FROM easter
""")(easter_dates)


def holiday_dates(spark, sf_dir):
    """Holiday dates per panel year."""
    return Q.holidays(P.panel_days(spark, sf_dir))


query("c03_holiday_dates", f"""{CAL}
SELECT day, year FROM holidays
""")(holiday_dates)


def paydays(spark, sf_dir):
    """Last working day, 15th and 25th rolled back, per month."""
    panel = P.panel_days(spark, sf_dir)
    cal = Q.with_day_flags(Q.spine(spark, panel), Q.day_flags(panel))
    return C.paydays(cal.withColumn("is_workday", C.workday(F.col("day"), F.col("is_holiday"))))


query("c08_paydays", f"""{CAL},
{Q.SPINE},
cal AS (SELECT day, (isodow(day) <= 5 AND day NOT IN (SELECT day FROM holidays)) AS is_workday FROM spine),
carried AS (
  SELECT day, max(CASE WHEN is_workday THEN day END) OVER (
           PARTITION BY date_trunc('month', day) ORDER BY day
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pay
  FROM cal),
kinds AS (
  SELECT pay, CASE WHEN day = last_day(day) THEN 'month_end'
                   WHEN day(day) = 15 THEN 'd15' WHEN day(day) = 25 THEN 'd25' END AS kind
  FROM carried)
SELECT pay AS day, kind FROM kinds WHERE kind IS NOT NULL AND pay IS NOT NULL
""")(paydays)


def _order_windows(spark, sf_dir):
    """Per-order activity windows keyed by the customer's region ("state"):
    [order day, order day + priority number]."""
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate", "o_orderpriority"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", F.col("r_name").alias("state"))
    start = F.to_date("o_orderdate")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(checked_broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("state", start.alias("start"),
                    F.date_add(start, P.priority_code(F.col("o_orderpriority"))).alias("end")))


def _state_flags(spark, sf_dir):
    """(state, day, flag) over the panel's days."""
    lo, hi = P.panel_bounds(spark, sf_dir)
    islands = materialize(C.merged_ranges(_order_windows(spark, sf_dir), "state", "start", "end"))
    return (C.dense_coverage(islands, "state", lo, hi)
            .select("state", "day", (F.col("depth") > 0).cast("int").alias("flag")))


def state_calendar(spark, sf_dir):
    """Ranges merged per state, dense 0/1 calendar per state over the
    panel range, summarised per state with its slug."""
    dense = _state_flags(spark, sf_dir)
    return dense.groupBy("state").agg(F.count(F.lit(1)).alias("days"),
                                      F.sum("flag").alias("flagged")).select(
        "state", C.slug(F.col("state")).alias("slug"), "days", "flagged")


_WINDOWS_SQL = """windows AS (
  SELECT r.r_name AS state, CAST(o.o_orderdate AS DATE) AS start,
         CAST(CAST(o.o_orderdate AS DATE) + TRY_CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS DATE) AS "end"
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
state_days AS (
  SELECT DISTINCT state, CAST(unnest(generate_series(start, "end", INTERVAL 1 DAY)) AS DATE) AS day
  FROM windows),
dense AS (
  SELECT s.state, g.day, CASE WHEN d.day IS NULL THEN 0 ELSE 1 END AS flag
  FROM (SELECT DISTINCT state FROM state_days) s
  JOIN spine g ON TRUE
  LEFT JOIN state_days d ON d.state = s.state AND d.day = g.day)"""

query("c10_state_calendar", f"""WITH {S.PANEL},
{Q.SPINE},
{_WINDOWS_SQL}
SELECT state, regexp_replace(regexp_replace(lower(state), '[\\s\\-]+', '_', 'g'), '[^a-z0-9_]', '', 'g') AS slug,
       COUNT(*) AS days, CAST(SUM(flag) AS BIGINT) AS flagged
FROM dense GROUP BY state
""")(state_calendar)


def state_pivot_join(spark, sf_dir):
    """Dense state flags pivoted to one column per state (one pivot),
    then one join to the daily totals of the panel."""
    panel = P.panel_table(spark, sf_dir)
    dense = _state_flags(spark, sf_dir)
    states = sorted(P.REGION_NAMES)
    wide = J.pivot_states(dense, "state", "day", "flag", states, prefix="st_")
    totals = panel.groupBy("day").agg(F.sum("units").alias("units"))
    out = totals.join(wide, "day", "left")
    return out.groupBy(*[f"st_{s}" for s in states]).agg(
        F.count(F.lit(1)).alias("days"), F.sum("units").alias("units"))


def _state_pivot_sql():
    states = sorted(P.REGION_NAMES)
    cols = ", ".join(f'max(CASE WHEN state = \'{s}\' THEN flag END) AS "st_{s}"' for s in states)
    keys = ", ".join(f'w."st_{s}"' for s in states)
    return f"""WITH {S.PANEL},
{Q.SPINE},
{_WINDOWS_SQL},
wide AS (SELECT day, {cols} FROM dense GROUP BY day),
totals AS (SELECT day, SUM(units) AS units FROM panel GROUP BY day)
SELECT {keys}, COUNT(*) AS days, SUM(t.units) AS units
FROM totals t LEFT JOIN wide w ON t.day = w.day GROUP BY {keys}
"""


query("j10_state_pivot_join", _state_pivot_sql())(state_pivot_join)


def parade_days(spark, sf_dir):
    """Second Saturday of each year's festival window."""
    return Q.parade(P.panel_days(spark, sf_dir))


query("c14_parade_days", f"""{CAL}
SELECT day FROM parade
""")(parade_days)


def events_in_range(spark, sf_dir):
    """Holiday dates kept only inside the panel's day range."""
    days = P.panel_days(spark, sf_dir)
    return J.within_range_of(Q.holidays(days), days)


query("j09_events_in_range", f"""{CAL}
SELECT day, year FROM holidays
WHERE day BETWEEN (SELECT min(day) FROM panel) AND (SELECT max(day) FROM panel)
""")(events_in_range)
