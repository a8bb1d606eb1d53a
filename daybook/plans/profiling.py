"""Profiling, window and set queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.numeric import rnd
from ..operators import alignment as AL
from ..operators import evaluate as EV
from ..operators import forecast as FC
from ..operators import profile as PR
from ..operators import quantiles as QU
from ..operators import segments as SG
from ..operators import windows as WN
from ..sources import panel as P
from ..sources.tables import read_table
from . import common as Q
from . import sqlparts as S
from .registry import query

GROUPS = list(P.GROUP_LABELS)
MEASURES = ["units", "lines", "temp", "wind", "cloud"]
BASE = f"WITH {S.PANEL},\n{S.DAILY},\n{S.CODES},\n{Q.calendar_ctes()},\n{Q.ENRICHED}"


def scored(spark, sf_dir, last=P.VALID_END):
    """Weekday-mean forecaster (M1) rows for train and validation:
    ``(split, day, grp, weekday, actual, pred)``."""
    panel = P.panel_table(spark, sf_dir, last=last)
    train = panel.where(F.col("day") <= P.TRAIN_END)
    rows = panel.where(F.col("day") <= P.VALID_END).withColumn("split", P.split_label(F.col("day")))
    out = FC.weekday_mean_forecast(train, rows.withColumnRenamed("units", "actual"), value="units")
    return out.select("split", "day", "grp", "weekday", "actual", "pred")


SCORED = f"""model AS (SELECT {S.wd('day')} AS weekday, grp, AVG(units) AS pred FROM panel WHERE {S.TRAIN} GROUP BY 1, 2),
scored AS (SELECT {S.SPLIT_CASE} AS split, p.day, p.grp, m.weekday, p.units AS actual, m.pred
           FROM panel p JOIN model m ON {S.wd('p.day')} = m.weekday AND p.grp = m.grp
           WHERE p.day <= DATE '{P.VALID_END}')"""


def _describe_sql(cols: list[str], src: str, by: list[str] | None = None) -> str:
    by = by or []
    keys = "".join(f"{k}, " for k in by)
    grp = f" GROUP BY {', '.join(by)}" if by else ""
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT {keys}'{c}' AS \"column\", COUNT({x}) AS count, ROUND(AVG({x}), 6) AS mean, "
            f"ROUND(stddev_samp({x}), 6) AS std, MIN({x}) AS min, ROUND(quantile_cont({x}, 0.25), 6) AS p25, "
            f"ROUND(quantile_cont({x}, 0.5), 6) AS p50, ROUND(quantile_cont({x}, 0.75), 6) AS p75, "
            f"MAX({x}) AS max FROM {src}{grp}")
    return "\nUNION ALL ".join(parts)


def describe_all(spark, sf_dir):
    """A1: describe over the whole panel."""
    return PR.describe(P.panel_table(spark, sf_dir), ["units", "lines"])


query("a01_describe", f"WITH {S.PANEL}\n{_describe_sql(['units', 'lines'], 'panel')}")(describe_all)


def describe_by_group(spark, sf_dir):
    """A2: describe per group."""
    return PR.describe(P.panel_table(spark, sf_dir), ["units", "lines"], by=["grp"])


query("a02_describe_by_group",
      f"WITH {S.PANEL}\n{_describe_sql(['units', 'lines'], 'panel', ['grp'])}")(describe_by_group)


def key_means(spark, sf_dir):
    """A3/A4: mean and sample std per (group, weekday), rounded."""
    panel = P.panel_table(spark, sf_dir).withColumn("weekday", F.weekday("day"))
    return PR.mean_by(panel, ["grp", "weekday"], "units", std=True, digits=6)


query("a03_key_means", f"""WITH {S.PANEL}
SELECT grp, {S.wd('day')} AS weekday, ROUND(AVG(units), 6) AS mean, ROUND(stddev_samp(units), 6) AS std
FROM panel GROUP BY 1, 2
""")(key_means)

SPLITS = ("train", "validation", "test")


def split_side_by_side(spark, sf_dir):
    """A5: mean / std / count per group for every split side by side."""
    panel = P.panel_table(spark, sf_dir).withColumn("split", P.split_label(F.col("day")))
    return PR.split_side_by_side(panel, "grp", "split", "units", SPLITS)


def _side_sql():
    parts = []
    for s in SPLITS:
        v = f"CASE WHEN split = '{s}' THEN units END"
        parts.append(f"ROUND(AVG({v}), 6) AS mean_{s}, ROUND(stddev_samp({v}), 6) AS std_{s}, "
                     f"COUNT({v}) AS count_{s}")
    return f"""WITH {S.PANEL},
l AS (SELECT *, {S.SPLIT_CASE} AS split FROM panel)
SELECT grp, {", ".join(parts)} FROM l GROUP BY grp"""


query("a05_split_side_by_side", _side_sql())(split_side_by_side)


def group_stats(spark, sf_dir):
    """Count, mean, std, min, max per group."""
    return PR.basic_stats(P.panel_table(spark, sf_dir), ["grp"], "units")


query("a06_group_stats", f"""WITH {S.PANEL}
SELECT grp, COUNT(units) AS count, ROUND(AVG(units), 6) AS mean, ROUND(stddev_samp(units), 6) AS std,
       MIN(units) AS min, MAX(units) AS max FROM panel GROUP BY grp
""")(group_stats)


def daily_totals(spark, sf_dir):
    """Total over groups per day (the panel itself is A8)."""
    return PR.daily_total(P.panel_table(spark, sf_dir), "units")


query("a07_daily_totals", f"""WITH {S.PANEL}
SELECT day, SUM(units) AS total FROM panel GROUP BY day
""")(daily_totals)


def monthly_trend(spark, sf_dir):
    """Monthly mean per group."""
    return PR.monthly_mean(P.panel_table(spark, sf_dir), "units", keys=["grp"])


query("a09_monthly_trend", f"""WITH {S.PANEL}
SELECT CAST(date_trunc('month', day) AS DATE) AS month, grp, ROUND(AVG(units), 6) AS mean, COUNT(units) AS n
FROM panel GROUP BY 1, 2
""")(monthly_trend)


def daily_pivot(spark, sf_dir):
    """Day x group pivot of units (fixed group list)."""
    return PR.pivot_sum(P.panel_table(spark, sf_dir), "day", "grp", "units", GROUPS, prefix="g")


PIVOT_SQL = "gpiv AS (SELECT day, " + ", ".join(
    f"SUM(CASE WHEN grp = {g} THEN units END) AS g{g}" for g in GROUPS) + " FROM panel GROUP BY day)"
query("a13_daily_pivot", f"WITH {S.PANEL},\n{PIVOT_SQL}\nSELECT * FROM gpiv")(daily_pivot)


def weekday_pivot(spark, sf_dir):
    """Group x weekday mean pivot."""
    panel = P.panel_table(spark, sf_dir).withColumn("weekday", F.weekday("day"))
    return PR.pivot_sum(panel, "grp", "weekday", "units", list(range(7)), agg="avg", prefix="wd")


WD_PIVOT_SQL = "wdp AS (SELECT grp, " + ", ".join(
    f"AVG(CASE WHEN isodow(day) - 1 = {d} THEN units END) AS wd{d}" for d in range(7)) + \
    " FROM panel GROUP BY grp)"
query("a14_weekday_pivot", f"WITH {S.PANEL},\n{WD_PIVOT_SQL}\nSELECT * FROM wdp")(weekday_pivot)


def weekday_stack(spark, sf_dir):
    """The weekday pivot stacked back to (group, weekday, mean)."""
    wide = weekday_pivot(spark, sf_dir)
    long = PR.melt(wide, ["grp"], [f"wd{d}" for d in range(7)], "wd", "mean")
    return long.select("grp", F.substring("wd", 3, 1).cast("int").alias("weekday"), "mean")


query("a15_weekday_stack", f"""WITH {S.PANEL},
{WD_PIVOT_SQL}
""" + "\nUNION ALL ".join(f"SELECT grp, {d} AS weekday, wd{d} AS mean FROM wdp" for d in range(7)))(
    weekday_stack)


def melt_actual_pred(spark, sf_dir):
    """Validation actual and predicted values as long rows."""
    s = scored(spark, sf_dir).where(F.col("split") == "validation").withColumn(
        "pred", rnd("pred", 6))
    return PR.melt(s.select("day", "grp", "actual", "pred"), ["day", "grp"], ["actual", "pred"],
                   "series", "value")


query("a16_melt_actual_pred", f"""WITH {S.PANEL},
{SCORED}
SELECT day, grp, 'actual' AS series, actual AS value FROM scored WHERE split = 'validation'
UNION ALL SELECT day, grp, 'pred', ROUND(pred, 6) FROM scored WHERE split = 'validation'
""")(melt_actual_pred)


def pct_difference(spark, sf_dir):
    """Percent difference of mean prediction vs mean actual per
    (group, weekday) on validation."""
    s = scored(spark, sf_dir).where(F.col("split") == "validation")
    return PR.percent_difference(s, ["grp", "weekday"])


query("a17_pct_difference", f"""WITH {S.PANEL},
{SCORED}
SELECT grp, weekday, ROUND((AVG(pred) - AVG(actual)) / AVG(actual) * 100, 6) AS pct_diff
FROM scored WHERE split = 'validation' GROUP BY 1, 2
""")(pct_difference)


def corr_matrix(spark, sf_dir):
    """Full correlation matrix of the panel measures (pairwise nulls)."""
    return PR.correlation_pairs(Q.enriched(spark, sf_dir), MEASURES, upper=False)


def _pairs_sql(cols, src, upper):
    import itertools
    pairs = list(itertools.combinations(cols, 2)) if upper else list(itertools.product(cols, cols))
    return "\nUNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, ROUND({S.corr(a, b)}, 6) AS corr FROM {src}" for a, b in pairs)


query("a18_corr_matrix", f"{BASE}\n{_pairs_sql(MEASURES, 'enriched', False)}")(corr_matrix)


def target_corr(spark, sf_dir):
    """Correlation to the target, target first, by |corr|."""
    return PR.target_correlation(Q.enriched(spark, sf_dir), "units", MEASURES[1:])


query("a19_target_corr", f"""{BASE}
SELECT 'units' AS "column", CAST(1.0 AS DOUBLE) AS corr
""" + "".join(f"\nUNION ALL SELECT '{c}', ROUND({S.corr('units', c)}, 6) FROM enriched" for c in MEASURES[1:]))(
    target_corr)


def group_corr_pairs(spark, sf_dir):
    """Upper-triangle correlation of the groups' daily series."""
    return PR.correlation_pairs(daily_pivot(spark, sf_dir), [f"g{g}" for g in GROUPS])


query("a20_group_corr_pairs",
      f"WITH {S.PANEL},\n{PIVOT_SQL}\n{_pairs_sql([f'g{g}' for g in GROUPS], 'gpiv', True)}")(
    group_corr_pairs)

NULLABLE = ["temp", "wind", "cloud", "code", "description", "units"]


def missing_summary(spark, sf_dir):
    """Missing count and percentage per column (only > 0)."""
    return PR.missing_summary(Q.enriched(spark, sf_dir), NULLABLE)


query("a21_missing_summary", f"""{BASE},
m AS (""" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS missing, COUNT(*) AS n FROM enriched"
    for c in NULLABLE) + """)
SELECT "column", missing, ROUND(missing / n * 100, 6) AS pct FROM m WHERE missing > 0
""")(missing_summary)


def missing_by_year(spark, sf_dir):
    """Null counts per year."""
    return PR.missing_by(Q.enriched(spark, sf_dir), [F.year("day").alias("year")], NULLABLE[:5])


def _missing_by_sql(key_expr, key_name):
    nulls = ", ".join(f"COUNT(*) - COUNT({c}) AS null_{c}" for c in NULLABLE[:5])
    return f"""{BASE}
SELECT {key_expr} AS {key_name}, COUNT(*) AS rows, {nulls} FROM enriched GROUP BY 1"""


query("a22_missing_by_year", _missing_by_sql("CAST(year(day) AS INTEGER)", "year"))(missing_by_year)


def nullity_corr(spark, sf_dir):
    """Correlation of null indicators (constant indicators give null)."""
    return PR.nullity_correlation(Q.enriched(spark, sf_dir), NULLABLE)


query("a23_nullity_corr", f"""{BASE},
ind AS (SELECT {", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}" for c in NULLABLE)} FROM enriched)
{_pairs_sql(NULLABLE, 'ind', True)}
""")(nullity_corr)


def missing_timeline(spark, sf_dir):
    """Null counts per day."""
    return PR.missing_by(Q.enriched(spark, sf_dir), [F.col("day")], NULLABLE[:5])


query("a24_missing_timeline", _missing_by_sql("day", "day"))(missing_timeline)


def histogram(spark, sf_dir):
    """20 equal-width bins of units."""
    h = PR.histogram(P.panel_table(spark, sf_dir), "units", 20)
    return h.select("bin", rnd("lo", 6).alias("lo"), rnd("hi", 6).alias("hi"), "count")


query("a25_histogram", f"""WITH {S.PANEL},
b AS (SELECT min(units) AS lo, max(units) AS hi, (max(units) - min(units)) / 20 AS w FROM panel),
h AS (SELECT CAST(CASE WHEN w = 0 THEN 1 ELSE least(floor((units - lo) / w) + 1, 20) END AS INTEGER) AS bin,
             COUNT(*) AS count FROM panel, b WHERE units IS NOT NULL GROUP BY 1)
SELECT bin, ROUND(lo + (bin - 1) * w, 6) AS lo, ROUND(lo + bin * w, 6) AS hi, count FROM h, b
""")(histogram)


def box_stats(spark, sf_dir):
    """Box-plot statistics of units per weekday."""
    panel = P.panel_table(spark, sf_dir).withColumn("weekday", F.weekday("day"))
    return PR.box_stats(panel, ["weekday"], "units")


query("a26_box_stats", f"""WITH {S.PANEL},
p AS (SELECT {S.wd('day')} AS weekday, units FROM panel),
q AS (SELECT weekday, quantile_cont(units, 0.25) AS q1, quantile_cont(units, 0.5) AS median,
             quantile_cont(units, 0.75) AS q3 FROM p GROUP BY weekday),
j AS (SELECT p.weekday, p.units, q.q1, q.median, q.q3, q.q3 - q.q1 AS iqr FROM p JOIN q USING (weekday))
SELECT weekday, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3, ROUND(iqr, 6) AS iqr,
  MIN(CASE WHEN units >= q1 - 1.5 * iqr AND units <= q3 + 1.5 * iqr THEN units END) AS whisker_lo,
  MAX(CASE WHEN units >= q1 - 1.5 * iqr AND units <= q3 + 1.5 * iqr THEN units END) AS whisker_hi,
  COUNT(CASE WHEN NOT (units >= q1 - 1.5 * iqr AND units <= q3 + 1.5 * iqr) THEN 1 END) AS n_outliers
FROM j GROUP BY weekday, q1, median, q3, iqr
""")(box_stats)


def fact_quantiles(spark, sf_dir):
    """A1/A2 on the fact table: quartiles and the 99 % point of every line's
    price and quantity per return flag and line status, by distributed selection."""
    lines = read_table(spark, sf_dir, "lineitem", ["l_returnflag", "l_linestatus", "l_extendedprice", "l_quantity"])
    out = QU.exact_quantiles(lines, ["l_extendedprice", "l_quantity"], FACT_PROBS, ["l_returnflag", "l_linestatus"])
    return out.withColumn("value", rnd("value", 4))


FACT_PROBS = [0.25, 0.5, 0.75, 0.99]

query("a02b_fact_quantiles", "\nUNION ALL ".join(
    f"SELECT l_returnflag, l_linestatus, '{c}' AS \"column\", CAST({p} AS DOUBLE) AS p, "
    f"ROUND(quantile_cont(CAST({c} AS DOUBLE), {p}), 4) AS value FROM lineitem GROUP BY l_returnflag, l_linestatus"
    for c in ("l_extendedprice", "l_quantity") for p in FACT_PROBS))(fact_quantiles)


def fact_box_stats(spark, sf_dir):
    """A26 on the fact table: box-plot statistics of every line's price per
    return flag, quartiles by distributed selection."""
    lines = read_table(spark, sf_dir, "lineitem", ["l_returnflag", "l_extendedprice"])
    lines = lines.withColumn("l_extendedprice", F.col("l_extendedprice").cast("double"))
    return PR.box_stats(lines, ["l_returnflag"], "l_extendedprice", digits=4, select=True)


query("a26b_fact_box_stats", """WITH p AS (SELECT l_returnflag, CAST(l_extendedprice AS DOUBLE) AS v FROM lineitem),
q AS (SELECT l_returnflag, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM p GROUP BY l_returnflag),
j AS (SELECT p.l_returnflag, p.v, q.q1, q.median, q.q3, q.q3 - q.q1 AS iqr FROM p JOIN q USING (l_returnflag))
SELECT l_returnflag, ROUND(q1, 4) AS q1, ROUND(median, 4) AS median, ROUND(q3, 4) AS q3, ROUND(iqr, 4) AS iqr,
  MIN(CASE WHEN v >= q1 - 1.5 * iqr AND v <= q3 + 1.5 * iqr THEN v END) AS whisker_lo,
  MAX(CASE WHEN v >= q1 - 1.5 * iqr AND v <= q3 + 1.5 * iqr THEN v END) AS whisker_hi,
  COUNT(CASE WHEN NOT (v >= q1 - 1.5 * iqr AND v <= q3 + 1.5 * iqr) THEN 1 END) AS n_outliers
FROM j GROUP BY l_returnflag, q1, median, q3, iqr
""")(fact_box_stats)


def kde_by_split(spark, sf_dir):
    """Gaussian kernel density of the sales rows per split, 200 points."""
    t = P.panel_table(spark, sf_dir).withColumn("split", P.split_label(F.col("day")))
    out = PR.kde_grid(t, "units", "split", digits=9)
    return out.withColumn("x", rnd("x", 4))


query("a27_kde_by_split", f"""WITH {S.PANEL},
l AS (SELECT units AS total, {S.SPLIT_CASE} AS split FROM panel),
st AS (SELECT split, COUNT(total) AS n, stddev_samp(total) * pow(COUNT(total), -0.2) AS bw,
              min(total) AS lo, max(total) AS hi FROM l GROUP BY split),
g AS (SELECT split, n, bw, lo - 3.0 * bw AS g0, (hi - lo + 2 * 3.0 * bw) / 199 AS step,
             unnest(range(0, 200)) AS k FROM st),
d AS (SELECT g.split, g.k, g.n, g.bw, g.g0, g.step,
             SUM(exp(-0.5 * ((g.g0 + g.k * g.step - l.total) / g.bw) * ((g.g0 + g.k * g.step - l.total) / g.bw))) AS s
      FROM g JOIN l ON g.split = l.split GROUP BY ALL)
SELECT split, CAST(k AS INTEGER) AS k, ROUND(g0 + k * step, 4) AS x,
       ROUND(s / (n * bw * {math.sqrt(2 * math.pi)!r}), 9) AS density FROM d
""")(kde_by_split)


def value_summary(spark, sf_dir):
    """Rows, distinct days, zeros, negatives, mean, min, max per
    group."""
    return EV.prediction_summary(P.panel_table(spark, sf_dir), "units", by=["grp"])


VALUE_SUMMARY_SQL = """SELECT {by}COUNT({v}) AS n, COUNT(DISTINCT day) AS n_days,
  COUNT(CASE WHEN {v} = 0 THEN 1 END) AS n_zero, COUNT(CASE WHEN {v} < 0 THEN 1 END) AS n_negative,
  ROUND(AVG({v}), 6) AS mean, MIN({v}) AS min, MAX({v}) AS max FROM {src} {grp}"""
query("a28_value_summary", f"WITH {S.PANEL}\n" + VALUE_SUMMARY_SQL.format(
    by="grp, ", v="units", src="panel", grp="GROUP BY grp"))(value_summary)


def global_range(spark, sf_dir):
    """Min / max of the daily totals of every split, padded 10%."""
    t = PR.daily_total(P.panel_table(spark, sf_dir), "units").withColumn(
        "split", P.split_label(F.col("day")))
    frames = [t.where(F.col("split") == s) for s in SPLITS]
    r = PR.global_range(frames, "total")
    return r.select("lo", "hi", rnd("axis_lo", 6).alias("axis_lo"), rnd("axis_hi", 6).alias("axis_hi"))


query("a29_global_range", f"""WITH {S.PANEL},
t AS (SELECT day, SUM(units) AS total FROM panel GROUP BY day),
r AS (SELECT min(total) AS lo, max(total) AS hi FROM t WHERE {S.SPLIT_CASE.replace('day', 'day')} IS NOT NULL)
SELECT lo, hi, ROUND(greatest(0.0, lo - (hi - lo) * 0.1), 6) AS axis_lo, ROUND(hi + (hi - lo) * 0.1, 6) AS axis_hi FROM r
""")(global_range)


def availability(spark, sf_dir):
    """Rows per (month of the year, group) over distinct days per month
    of the year, fitted on train only (defect D15), joined to every row of
    train and validation."""
    panel = P.panel_table(spark, sf_dir).where(F.col("day") <= P.VALID_END)
    out = PR.availability_ratio(panel.where(F.col("day") <= P.TRAIN_END), panel)
    return out.select("day", "grp", "month", rnd("availability", 9).alias("availability"))


query("a30_availability", f"""WITH {S.PANEL},
tr AS (SELECT * FROM panel WHERE {S.TRAIN}),
g AS (SELECT month(day) AS month, grp, COUNT(*) AS g_days FROM tr GROUP BY 1, 2),
m AS (SELECT month(day) AS month, COUNT(DISTINCT day) AS m_days FROM tr GROUP BY 1)
SELECT p.day, p.grp, CAST(month(p.day) AS INTEGER) AS month, ROUND(g.g_days / m.m_days, 9) AS availability
FROM panel p LEFT JOIN g ON month(p.day) = g.month AND p.grp = g.grp
LEFT JOIN m ON g.month = m.month
WHERE p.day <= DATE '{P.VALID_END}'
""")(availability)


def business_years(spark, sf_dir):
    """Aug-Jul business-year slices of the daily totals."""
    t = PR.daily_total(P.panel_table(spark, sf_dir), "units")
    return t.groupBy(PR.business_year(F.col("day")).alias("business_year")).agg(
        F.count(F.lit(1)).alias("days"), F.sum("total").alias("total"),
        F.min("total").alias("min_day"), F.max("total").alias("max_day"))


query("a31_business_years", f"""WITH {S.PANEL},
t AS (SELECT day, SUM(units) AS total FROM panel GROUP BY day)
SELECT CAST(year(day - INTERVAL 7 MONTH) AS INTEGER) AS business_year, COUNT(*) AS days, SUM(total) AS total,
       MIN(total) AS min_day, MAX(total) AS max_day FROM t GROUP BY 1
""")(business_years)


def group_mean_spread(spark, sf_dir):
    """Std of the group means x 10."""
    return PR.group_mean_spread(P.panel_table(spark, sf_dir), "grp", "units").select(
        rnd("score", 6).alias("score"))


query("a32_group_mean_spread", f"""WITH {S.PANEL},
m AS (SELECT grp, AVG(units) AS m FROM panel GROUP BY grp)
SELECT ROUND(stddev_samp(m) * 10.0, 6) AS score FROM m
""")(group_mean_spread)


def bad_values(spark, sf_dir):
    """Null / NaN / infinite counts of the feature matrix."""
    return PR.bad_value_counts(Q.enriched(spark, sf_dir), MEASURES)


query("a34_bad_values", f"{BASE}\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS n_null, "
    f"COUNT(CASE WHEN isnan(CAST({c} AS DOUBLE)) THEN 1 END) AS n_nan, "
    f"COUNT(CASE WHEN abs(CAST({c} AS DOUBLE)) = 'inf'::DOUBLE THEN 1 END) AS n_inf FROM enriched"
    for c in MEASURES))(bad_values)


def ordered_series(spark, sf_dir):
    """Actual and predicted series per group and split, ordered."""
    s = scored(spark, sf_dir)
    return s.select("split", "grp", "day", "actual", rnd("pred", 6).alias("pred")).orderBy(
        "grp", "split", "day")


query("a36_ordered_series", f"""WITH {S.PANEL},
{SCORED}
SELECT split, grp, day, actual, ROUND(pred, 6) AS pred FROM scored ORDER BY grp, split, day
""")(ordered_series)


# ---------------------------------------------------------------- windows

def rolling(spark, sf_dir):
    """W1 (7-row mean incl. current, and the leak-free 7 previous rows),
    7-calendar-day mean, W2 next row, W3 time index; all per group."""
    panel = P.panel_table(spark, sf_dir)
    return panel.select(
        "day", "grp", "units",
        rnd(WN.rolling_mean("units"), 6).alias("roll7"),
        rnd(WN.rolling_mean("units", include_current=False), 6).alias("roll7_prev"),
        rnd(WN.rolling_mean_days("units"), 6).alias("roll7_days"),
        WN.next_value("units").alias("next_units"),
        WN.time_index().alias("t"))


query("w01_rolling", f"""WITH {S.PANEL}
SELECT day, grp, units,
  ROUND(AVG(units) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS roll7,
  ROUND(AVG(units) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS roll7_prev,
  ROUND(AVG(units) OVER (PARTITION BY grp ORDER BY date_diff('day', DATE '1970-01-01', day)
        RANGE BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS roll7_days,
  lead(units) OVER (PARTITION BY grp ORDER BY day) AS next_units,
  CAST(row_number() OVER (PARTITION BY grp ORDER BY day) - 1 AS INTEGER) AS t
FROM panel
""")(rolling)


def rolling_blocks(spark, sf_dir):
    """W1-W3 as ``w01_rolling``, with each group's series cut into blocks."""
    rows = SG.with_time_index(P.panel_table(spark, sf_dir), "grp", "day")
    out = SG.with_rolling(rows, "units", "grp")
    return out.select("day", "grp", "units", rnd("roll", 6).alias("roll7"), rnd("roll_prev", 6).alias("roll7_prev"),
                      F.col("next").alias("next_units"), F.col("t").cast("int").alias("t"))


query("w01b_rolling_blocks", f"""WITH {S.PANEL}
SELECT day, grp, units,
  ROUND(AVG(units) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS roll7,
  ROUND(AVG(units) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS roll7_prev,
  lead(units) OVER (PARTITION BY grp ORDER BY day) AS next_units,
  CAST(row_number() OVER (PARTITION BY grp ORDER BY day) - 1 AS INTEGER) AS t
FROM panel
""")(rolling_blocks)


def top_pairs(spark, sf_dir):
    """Five strongest and five weakest group correlations."""
    pairs = group_corr_pairs(spark, sf_dir)
    top = WN.top_k(pairs, [F.col("corr").desc(), "a", "b"], 5).withColumn("end", F.lit("top"))
    bottom = WN.top_k(pairs, [F.col("corr").asc(), "a", "b"], 5).withColumn("end", F.lit("bottom"))
    return top.unionByName(bottom)


_PAIRS = _pairs_sql([f'g{g}' for g in GROUPS], 'gpiv', True)
query("w07_top_pairs", f"""WITH {S.PANEL},
{PIVOT_SQL},
pairs AS ({_PAIRS})
(SELECT a, b, corr, 'top' AS "end" FROM pairs ORDER BY corr DESC, a, b LIMIT 5)
UNION ALL
(SELECT a, b, corr, 'bottom' AS "end" FROM pairs ORDER BY corr ASC, a, b LIMIT 5)
""")(top_pairs)


def top_days(spark, sf_dir):
    """The three biggest days per group (ties by earlier day)."""
    panel = P.panel_table(spark, sf_dir)
    return WN.top_k_per_group(panel, "grp", [F.col("units").desc(), "day"], 3).select(
        "grp", "rank", "day", "units")


query("w08_top_days", f"""WITH {S.PANEL}
SELECT grp, CAST(rank AS INTEGER) AS rank, day, units FROM (
  SELECT grp, day, units, row_number() OVER (PARTITION BY grp ORDER BY units DESC, day) AS rank FROM panel) r
WHERE rank <= 3
""")(top_days)


def corr_nodes(spark, sf_dir):
    """Distinct groups taking part in a correlation edge >= 0 (graph
    nodes of the edge list)."""
    pairs = group_corr_pairs(spark, sf_dir).where(F.col("corr") >= 0)
    return WN.distinct_union(pairs, "a", "b")


query("u02_corr_nodes", f"""WITH {S.PANEL},
{PIVOT_SQL},
pairs AS ({_PAIRS})
SELECT a AS node FROM pairs WHERE corr >= 0 UNION SELECT b FROM pairs WHERE corr >= 0
""")(corr_nodes)


def distinct_days(spark, sf_dir):
    """U4: distinct panel days."""
    return WN.distinct_days(P.panel_table(spark, sf_dir))


query("u04_distinct_days", f"WITH {S.PANEL}\nSELECT DISTINCT day FROM panel")(distinct_days)


def error_union(spark, sf_dir):
    """Signed error rows of train and validation, labelled."""
    s = scored(spark, sf_dir)
    frames = {sp: s.where(F.col("split") == sp) for sp in ("train", "validation")}
    out = EV.signed_errors(frames, ["day", "grp"])
    return out.select("split", "day", "grp", "actual", rnd("pred", 6).alias("pred"),
                      rnd("error", 6).alias("error"))


query("u01_error_union", f"""WITH {S.PANEL},
{SCORED}
SELECT split, day, grp, actual, ROUND(pred, 6) AS pred, ROUND(actual - pred, 6) AS error FROM scored
WHERE split IN ('train', 'validation')
""")(error_union)


# ---------------------------------------------------------------- actual vs predicted

from ..functions import dates as DT  # noqa: E402
from ..functions import columns as CO  # noqa: E402


def season_actual_pred(spark, sf_dir):
    """A10: actual and predicted mean / std per (season, group label) on
    validation."""
    s = scored(spark, sf_dir).where(F.col("split") == "validation")
    s = s.withColumn("season", DT.season_meteo("day")).withColumn("label", P.group_label(F.col("grp")))
    return PR.actual_pred_by(s, ["season", "label"])


def _actual_pred_sql(keys, where, extra=""):
    return f"""WITH {S.PANEL},
{SCORED},
x AS (SELECT *, {extra} 1 AS one FROM scored WHERE {where})
SELECT {keys}, COUNT(actual) AS n, ROUND(AVG(actual), 6) AS actual_mean, ROUND(stddev_samp(actual), 6) AS actual_std,
       ROUND(AVG(pred), 6) AS pred_mean, ROUND(stddev_samp(pred), 6) AS pred_std
FROM x GROUP BY {keys}"""


_SEASON = ("CASE WHEN month(day) IN (12, 1, 2) THEN 'winter' WHEN month(day) IN (3, 4, 5) THEN 'spring' "
           "WHEN month(day) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END")
_LABEL = S.LABEL_CASE
query("a10_season_actual_pred", _actual_pred_sql(
    "season, label", "split = 'validation'", f"{_SEASON} AS season, {_LABEL} AS label,"))(
    season_actual_pred)


def month_position_actual_pred(spark, sf_dir):
    """Actual and predicted per (month third, group) on validation."""
    s = scored(spark, sf_dir).where(F.col("split") == "validation").withColumn(
        "month_third", DT.month_third("day"))
    return PR.actual_pred_by(s, ["month_third", "grp"])


_THIRD = "CASE WHEN day(day) <= 10 THEN 'start' WHEN day(day) <= 20 THEN 'middle' ELSE 'end' END"
query("a11_month_position_actual_pred", _actual_pred_sql(
    "month_third, grp", "split = 'validation'", f"{_THIRD} AS month_third,"))(month_position_actual_pred)


def weekday_split_actual_pred(spark, sf_dir):
    """Actual and predicted per (group, weekday, split)."""
    return PR.actual_pred_by(scored(spark, sf_dir), ["grp", "weekday", "split"])


query("a12_weekday_split_actual_pred", _actual_pred_sql("grp, weekday, split", "TRUE"))(
    weekday_split_actual_pred)


REQUIRED = ["day", "grp", "actual", "pred", "temp"]


def integrity_profile(spark, sf_dir):
    """A33 + U3: schema diff (missing required columns), one summary row (rows,
    date range, negative predictions) of the scored frame, and whether it holds
    the same (day, group, value) rows as the panel, by months that differ."""
    s = scored(spark, sf_dir)
    panel = P.sales_panel(spark, sf_dir, last=P.VALID_END).withColumnRenamed("units", "actual")
    off = AL.differing_ranges(s, panel, ["day", "grp", "actual"], F.trunc("day", "MM")).agg(F.count(F.lit(1)).alias("n")).scalar()
    prof = PR.integrity_profile(s, REQUIRED, pred="pred")
    diff = CO.column_difference(REQUIRED, s)
    return prof["summary"].select("*", F.lit(",".join(prof["missing_columns"])).alias("missing_columns"),
                                  F.lit(",".join(diff["extra"])).alias("extra_columns"),
                                  off.alias("differing_months"), (off == 0).alias("aligned"))


query("a33_integrity_profile", f"""WITH {S.PANEL},
{SCORED}
SELECT COUNT(*) AS rows, MIN(day) AS first_day, MAX(day) AS last_day,
       COUNT(CASE WHEN pred < 0 THEN 1 END) AS negative_predictions,
       'temp' AS missing_columns, 'split,weekday' AS extra_columns, CAST(0 AS BIGINT) AS differing_months, TRUE AS aligned FROM scored
""")(integrity_profile)


def column_selection(spark, sf_dir):
    """N16 + N17 + N19: numeric columns chosen by schema type, columns by
    prefix / substring, rounded to 2 decimals."""
    e = Q.enriched(spark, sf_dir)
    numeric = CO.numeric_columns(e, exclude=("grp", "code"))
    flags = CO.columns_like(e, prefix="is_") + CO.columns_like(e, contains="_parade")
    out = e.select("day", "grp", *numeric, *dict.fromkeys(flags))
    return CO.round_columns(out, numeric, 2)


query("n16_column_selection", f"""{BASE}
SELECT day, grp, ROUND(units, 2) AS units, ROUND(lines, 2) AS lines, ROUND(n_orders, 2) AS n_orders,
       ROUND(temp, 2) AS temp, ROUND(wind, 2) AS wind, ROUND(cloud, 2) AS cloud,
       is_holiday, is_festival, is_parade, is_easter_saturday, is_nye, before_parade, after_parade
FROM enriched
""")(column_selection)
