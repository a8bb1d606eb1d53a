"""Least-squares forecasters with twins (M3-M7, R7, R9, V10), and source and
sink round trips over driver data (S3, S4, S6-S8, S11, S14, F11, N15)."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import nulls as NU
from ..functions.numeric import rnd
from ..operators import evaluate as EV
from ..operators import forecast as FC
from ..operators import linear as LN
from ..session import shared_path
from ..sources import files as FI
from ..sources import panel as P
from ..sources.tables import read_table
from . import common as Q
from . import sqlparts as S
from .forecasting import BINARY, NUMERIC
from .impact import DESIGN
from .profiling import BASE
from .registry import ORACLE, query
from ..functions.numeric import sql_round_rewrite

GROUPS = [f"g{g}" for g in list(P.GROUP_LABELS)[1:]]
WEEKDAYS = [f"wd{d}" for d in range(1, 7)]


def dummies():
    return [*[(F.weekday("day") == d).cast("int").alias(f"wd{d}") for d in range(1, 7)],
            *[(F.col("grp") == g).cast("int").alias(f"g{g}") for g in list(P.GROUP_LABELS)[1:]]]


DUMMIES_SQL = ", ".join([*[f"CAST({S.wd('day')} = {d} AS INTEGER) AS wd{d}" for d in range(1, 7)],
                         *[f"CAST(grp = {g} AS INTEGER) AS g{g}" for g in list(P.GROUP_LABELS)[1:]]])


def ols_ctes(src: str, y: str, xs: list[str], by: str | None = None) -> str:
    """CTEs that solve least squares of ``y`` on 1 and ``xs`` over the rows of
    ``src``: the sums of products, one elimination step per column, and back
    substitution; the last, ``fit``, holds b0..bk (one row per ``by``)."""
    n = len(xs) + 1
    terms = ["1.0", *[f"CAST({x} AS DOUBLE)" for x in xs], f"CAST({y} AS DOUBLE)"]
    key = f"{by}, " if by else ""
    cells = [(i, j) for i in range(n) for j in range(i, n + 1)]
    sums = ", ".join(f"SUM({terms[i]} * {terms[j]}) AS a{i}_{j}" for i, j in cells)
    out = [f"e0 AS (SELECT {key}{sums} FROM {src}" + (f" GROUP BY {by})" if by else ")")]
    for k in range(n - 1):
        step = ", ".join(f"a{i}_{j} - a{k}_{i} / a{k}_{k} * a{k}_{j} AS a{i}_{j}" if i > k else f"a{i}_{j}" for i, j in cells)
        out.append(f"e{k + 1} AS (SELECT {key}{step} FROM e{k})")
    at = f"e{n - 1}"
    for i in range(n - 1, -1, -1):
        known = "".join(f" - a{i}_{j} * b{j}" for j in range(i + 1, n))
        out.append(f"s{i} AS (SELECT *, (a{i}_{n}{known}) / a{i}_{i} AS b{i} FROM {at})")
        at = f"s{i}"
    out.append(f"fit AS (SELECT {key}{', '.join(f'b{i}' for i in range(n))} FROM {at})")
    return ",\n".join(out)


def predicted(xs: list[str]) -> str:
    return "b0" + "".join(f" + b{i} * {x}" for i, x in enumerate(xs, 1))


def pooled(frame, features):
    """Fit on train, score train and validation: (split, grp, actual, pred)."""
    fit = LN.fit_pooled(frame.where(F.col("split") == "train"), features, "units")
    rows = frame.where(F.col("split").isin("train", "validation"))
    return rows.select("split", "grp", F.col("units").alias("actual"), LN.linear_predict(fit["coef"], fit["intercept"]).alias("pred"))


def minimal_ols(spark, sf_dir):
    """M4 + V10: pooled OLS on weekday and group; metrics per split, with the
    adjusted R^2 for the number of features."""
    panel = P.panel_table(spark, sf_dir).withColumn("split", P.split_label(F.col("day")))
    m = EV.error_metrics(pooled(panel.select("units", "split", "grp", *dummies()), WEEKDAYS + GROUPS), "actual", "pred", by=["split"])
    return m.withColumn("adj_r2", rnd(EV.adjusted_r2(F.col("r2"), F.col("n"), F.lit(len(WEEKDAYS + GROUPS))), 5))


query("m04_minimal_ols", f"""WITH {S.PANEL},
x AS (SELECT units, grp, {S.SPLIT_CASE} AS split, {DUMMIES_SQL} FROM panel),
tr AS (SELECT * FROM x WHERE split = 'train'),
{ols_ctes('tr', 'units', WEEKDAYS + GROUPS)},
p AS (SELECT split, units AS actual, {predicted(WEEKDAYS + GROUPS)} AS pred FROM x CROSS JOIN fit WHERE split IN ('train', 'validation')),
m AS (SELECT split, {S.metrics()} FROM p GROUP BY split)
SELECT *, ROUND(1.0 - (1.0 - r2) * (n - 1) / (n - {len(WEEKDAYS + GROUPS)} - 1), 5) AS adj_r2 FROM m
""")(minimal_ols)

# The date features; the first level of each category is left out,
# as the other levels determine it.
DATE_NUMERIC = ["weekday", "week_sin", "week_cos", "month_sin", "month_cos", "day_of_month"]
DATE_BINARY = ["weekend", "month_middle", "month_end", "spring", "summer", "fall"]


def date_ols(spark, sf_dir):
    """M5: pooled OLS on weekday number, cyclic week and month, day of month,
    thirds of the month, quarter seasons, weekend and group; metrics per split."""
    panel = P.panel_table(spark, sf_dir).withColumn("split", P.split_label(F.col("day")))
    cyc = D.cyclic_calendar(F.col("day"))
    dom, season = F.dayofmonth("day"), D.season_quarter(F.col("day"))
    x = panel.select("units", "split", "grp", F.weekday("day").alias("weekday"),
                     *[cyc[c].alias(c) for c in DATE_NUMERIC[1:5]], dom.alias("day_of_month"),
                     (F.weekday("day") >= 5).cast("int").alias("weekend"),
                     ((dom > 10) & (dom <= 20)).cast("int").alias("month_middle"), (dom > 20).cast("int").alias("month_end"),
                     *[(season == s).cast("int").alias(s) for s in DATE_BINARY[3:]], *dummies()[6:])
    return EV.error_metrics(pooled(x, DATE_NUMERIC + DATE_BINARY + GROUPS), "actual", "pred", by=["split"], digits=4)


query("m05_date_ols", f"""WITH {S.PANEL},
x AS (SELECT units, grp, {S.SPLIT_CASE} AS split, {S.wd('day')} AS weekday,
  sin({2 * math.pi!r} * weekofyear(day) / 52) AS week_sin, cos({2 * math.pi!r} * weekofyear(day) / 52) AS week_cos,
  sin({2 * math.pi!r} * month(day) / 12) AS month_sin, cos({2 * math.pi!r} * month(day) / 12) AS month_cos, day(day) AS day_of_month,
  CAST({S.wd('day')} >= 5 AS INTEGER) AS weekend, CAST(day(day) > 10 AND day(day) <= 20 AS INTEGER) AS month_middle, CAST(day(day) > 20 AS INTEGER) AS month_end,
  CAST(month(day) BETWEEN 4 AND 6 AS INTEGER) AS spring, CAST(month(day) BETWEEN 7 AND 9 AS INTEGER) AS summer,
  CAST(month(day) >= 10 AS INTEGER) AS fall, {DUMMIES_SQL} FROM panel),
tr AS (SELECT * FROM x WHERE split = 'train'),
{ols_ctes('tr', 'units', DATE_NUMERIC + DATE_BINARY + GROUPS)},
p AS (SELECT split, units AS actual, {predicted(DATE_NUMERIC + DATE_BINARY + GROUPS)} AS pred FROM x CROSS JOIN fit WHERE split IN ('train', 'validation'))
SELECT split, {S.metrics(digits=4)} FROM p GROUP BY split
""")(date_ols)

# ------------------------------------------------- twins of queries registered elsewhere

FRAME_SQL = f"""x AS (SELECT day, grp, units, {S.SPLIT_CASE} AS split,
  """ + ",\n  ".join(f"COALESCE({c}, (SELECT AVG({c}) FROM enriched WHERE {S.TRAIN})) AS {c}" for c in NUMERIC) + f""",
  CAST(is_holiday AS INTEGER) AS holiday, CAST(is_festival AS INTEGER) AS festival,
  CAST(month(day) IN (6, 7, 8) AS INTEGER) AS summer, {DUMMIES_SQL} FROM enriched),
tr AS (SELECT * FROM x WHERE split = 'train')"""
PER_GROUP = NUMERIC + ["holiday", "festival", "summer"] + WEEKDAYS

ORACLE["m03_pooled_ols"] = sql_round_rewrite(f"""{BASE},
{FRAME_SQL},
{ols_ctes('tr', 'units', NUMERIC + BINARY)},
p AS (SELECT split, grp, units AS actual, {predicted(NUMERIC + BINARY)} AS pred FROM x CROSS JOIN fit WHERE split IN ('train', 'validation'))
SELECT split, grp, {S.metrics()} FROM p GROUP BY split, grp
""")
# groups large enough for a fit of their own, as all are in the given tables
ORACLE["m07_per_group_ols"] = sql_round_rewrite(f"""{BASE},
{FRAME_SQL},
{ols_ctes('tr', 'units', PER_GROUP, 'grp')},
p AS (SELECT x.grp, units AS actual, {predicted(PER_GROUP)} AS pred FROM x JOIN fit ON x.grp = fit.grp WHERE split = 'validation')
SELECT grp, {S.metrics()} FROM p GROUP BY grp
""")
ORACLE["r07_coefficients"] = sql_round_rewrite(f"""{BASE},
x AS (SELECT units, n_orders, temp, wind, cloud, CAST({S.wd('day')} >= 5 AS INTEGER) AS weekend,
        CAST(is_holiday AS INTEGER) AS holiday, {DUMMIES_SQL.partition('wd6, ')[2]}
      FROM enriched WHERE {S.TRAIN} AND temp IS NOT NULL),
{ols_ctes('x', 'units', DESIGN)},
c AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, b{i} AS coef FROM fit" for i, f in enumerate(DESIGN, 1))})
SELECT feature, ROUND(coef, 6) AS coef, ROUND(abs(coef), 6) AS abs_coef, feature = 'temp' AS is_named FROM c
""")

# ------------------------------------------------- sources and sinks

DAILY = "day DATE, n_orders BIGINT, temp DOUBLE, wind DOUBLE, cloud INT, code INT"


def headerless_csv(spark, sf_dir):
    """S3: the daily measures written without a header line, names forced by
    the schema."""
    path = shared_path(spark, "roundtrip", uuid.uuid4().hex, "headerless")
    P.daily_measures(spark, sf_dir).write.option("header", False).csv(path)
    return FI.read_csv(spark, path, DAILY, header=False)


query("s03_headerless_csv", f"WITH {S.DAILY}\nSELECT * FROM daily")(headerless_csv)


def short_header(spark, sf_dir):
    """S4 + S11: a file whose header names two of three columns; its presence
    is checked before the read."""
    path = shared_path(spark, "roundtrip", uuid.uuid4().hex, "short_header")
    rows = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"]).select(
        F.col("r_regionkey").alias("o"), F.concat_ws(",", F.col("r_regionkey").cast("string"), "r_name", F.length("r_name").cast("string")).alias("line"))
    head = rows.agg(F.lit(-1).cast("long").alias("o"), F.lit("key,name").alias("line"))
    head.union(rows.select(F.col("o").cast("long"), "line")).coalesce(1).sortWithinPartitions("o").select("line").write.text(path)
    FI.require_inputs(spark, [path])
    return FI.read_short_header(spark, path, "key BIGINT, name STRING, width INT")


query("s04_short_header", "SELECT CAST(r_regionkey AS BIGINT) AS key, r_name AS name, CAST(length(r_name) AS INTEGER) AS width FROM region")(short_header)


def date_parse(spark, sf_dir):
    """S7 + S8: order days written in both text forms and parsed back; the wrong
    form gives null."""
    o = read_table(spark, sf_dir, "orders", ["o_orderdate"]).select(F.to_date("o_orderdate").alias("day")).distinct()
    iso, dotted = F.date_format("day", "yyyy-MM-dd"), F.date_format("day", "dd.MM.yyyy")
    return o.select("day", FI.parse_date(iso).alias("from_iso"), FI.parse_date(dotted, "dd.MM.yyyy").alias("from_dotted"),
                    FI.parse_date(dotted).alias("wrong_form"))


query("s07_date_parse", """SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS DATE) AS from_iso,
  CAST(o_orderdate AS DATE) AS from_dotted, CAST(NULL AS DATE) AS wrong_form FROM orders""")(date_parse)


def markdown_sections(spark, sf_dir):
    """The span of each order priority per region in 1997, written as a
    markdown file of state sections (both date forms in turn), read back."""
    path = shared_path(spark, "roundtrip", uuid.uuid4().hex, "sections")
    day = F.to_date("o_orderdate")
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate", "o_orderpriority"]).where(F.year(day) == 1997)
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    spans = (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
             .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
             .groupBy("r_name", F.substring("o_orderpriority", 3, 100).alias("name")).agg(F.min(day).alias("a"), F.max(day).alias("b")))
    month = F.element_at(F.array(*map(F.lit, FI.GERMAN_MONTHS)), F.month("b"))
    first = F.element_at(F.array(*map(F.lit, FI.GERMAN_MONTHS)), F.month("a"))
    words = F.concat(F.dayofmonth("a").cast("string"), F.lit(". "), first, F.lit(" - "), F.dayofmonth("b").cast("string"), F.lit(". "), month, F.lit(" 1997"))
    dotted = F.concat(F.date_format("a", "dd.MM.yyyy"), F.lit(" - "), F.date_format("b", "dd.MM.yyyy"))
    entry = F.concat(F.lit("- "), "name", F.lit(": "), F.when(F.length("name") % 2 == 0, words).otherwise(dotted))
    state = spans.select("r_name", entry.alias("e")).groupBy("r_name").agg(F.array_join(F.sort_array(F.collect_list("e")), "\n").alias("body"))
    text = state.select(F.concat(F.lit("## "), "r_name", F.lit(":\n"), "body").alias("s")).agg(
        F.concat(F.lit("# Ferien 1997\n"), F.array_join(F.sort_array(F.collect_list("s")), "\n")).alias("value"))
    text.write.text(path)
    ranges = FI.read_sections_checked(spark, path)       # raises where a line is left
    return ranges.select("year", "state", "name", "start", "end", F.lit(0).alias("unparsed"))


query("s06_markdown_sections", """
SELECT 1997 AS year, r_name AS state, substr(o_orderpriority, 3, 100) AS name, MIN(CAST(o_orderdate AS DATE)) AS start,
       MAX(CAST(o_orderdate AS DATE)) AS "end", 0 AS unparsed
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE year(CAST(o_orderdate AS DATE)) = 1997 GROUP BY ALL""")(markdown_sections)


def submission(spark, sf_dir):
    """Validation forecasts (M1) keyed by packed id, written as CSV and
    read back by id."""
    panel = P.panel_table(spark, sf_dir)
    valid = panel.where(F.col("day").between(P.VALID_START, P.VALID_END)).withColumnRenamed("units", "actual")
    out = FC.weekday_mean_forecast(panel.where(F.col("day") <= P.TRAIN_END), valid, value="units")
    path = shared_path(spark, "roundtrip", uuid.uuid4().hex, "submission")
    FI.write_table(out.select(P.packed_id(F.col("day"), F.col("grp")).alias("id"), "pred"), path, "csv")
    back = FI.read_csv(spark, path, "id BIGINT, pred DOUBLE")
    return back.select("id", P.id_day(F.col("id")).alias("day"), P.id_group(F.col("id")).alias("grp"), rnd("pred", 6).alias("pred"))


query("s14_submission", f"""WITH {S.PANEL},
model AS (SELECT {S.wd('day')} AS weekday, grp, AVG(units) AS pred FROM panel WHERE {S.TRAIN} GROUP BY 1, 2)
SELECT CAST(strftime(p.day, '%y%m%d') AS BIGINT) * 10 + p.grp AS id, p.day, p.grp, ROUND(m.pred, 6) AS pred
FROM panel p JOIN model m ON {S.wd('p.day')} = m.weekday AND p.grp = m.grp WHERE p.{S.VALID}
""")(submission)


def month_distances(spark, sf_dir):
    """F11 + N15: distance of each panel day from the month's start and middle,
    clipped to [0, 1]; and the measured cloud share clipped alike."""
    days = P.panel_table(spark, sf_dir).select("day").distinct()
    dist = D.month_distances(F.col("day"))
    daily = P.daily_measures(spark, sf_dir).select("day", NU.clip_unit(F.col("temp") / 10).alias("temp_unit"))
    return days.join(daily, "day", "left").select("day", *[rnd(v, 9).alias(k) for k, v in dist.items()], rnd("temp_unit", 9).alias("temp_unit"))


query("f11_month_distances", f"""WITH {S.PANEL}, {S.DAILY},
d AS (SELECT DISTINCT day, day(last_day(day)) / 2.0::DOUBLE AS half FROM panel)
SELECT d.day, ROUND(least(greatest((day(d.day) - 1) / half, 0.0), 1.0), 9) AS dist_from_start,
       ROUND(least(greatest(abs(day(d.day) - half) / half, 0.0), 1.0), 9) AS dist_from_middle,
       ROUND(CASE WHEN temp IS NOT NULL THEN least(greatest(temp / 10, 0.0), 1.0) END, 9) AS temp_unit
FROM d LEFT JOIN daily ON d.day = daily.day
""")(month_distances)
