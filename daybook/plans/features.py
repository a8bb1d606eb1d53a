"""Enrichment, null handling and feature queries (J1-J8, N1-N19,
F1-F43)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import rnd
from ..functions import dates as D
from ..functions import encode as EN
from ..functions import nulls as NU
from ..functions import scale as SC
from ..functions import weather as WX
from ..operators import enrich as J
from ..operators import segments as SG
from ..operators import split as SP
from ..operators import profile as PR
from ..operators import quantiles as QU
from ..sources import panel as P
from ..sources.tables import read_table
from . import common as Q
from . import sqlparts as S
from .registry import ORACLE, query

BASE = f"WITH {S.PANEL},\n{S.DAILY},\n{S.CODES},\n{Q.calendar_ctes()},\n{Q.ENRICHED}"
ENRICHED_COLS = ["day", "grp", "units", "lines", "n_orders", "temp", "wind", "cloud", "code",
                 "description", "is_holiday", "is_festival", "is_parade", "before_parade",
                 "after_parade", "is_easter_saturday", "is_nye"]


def enriched_panel(spark, sf_dir):
    """Panel + daily measures + code text + event flags."""
    return Q.enriched(spark, sf_dir).select(*ENRICHED_COLS)


query("j01_enriched_panel", f"""{BASE}
SELECT {", ".join(ENRICHED_COLS)} FROM enriched
""")(enriched_panel)


def month_day_profile(spark, sf_dir):
    """Validation rows with the train mean of the same (month, day of
    month), one row per key on the history side."""
    panel = P.panel_table(spark, sf_dir)
    train = panel.where(F.col("day") <= P.TRAIN_END)
    valid = SP.date_window(panel, P.VALID_START, P.VALID_END)
    out = J.month_day_profile(valid, train, "units")
    return out.select("day", "grp", "units", rnd("md_mean", 6).alias("md_mean"))


query("j05_month_day_profile", f"""WITH {S.PANEL},
prof AS (SELECT month(day) AS m, day(day) AS d, AVG(units) AS md_mean FROM panel WHERE {S.TRAIN} GROUP BY 1, 2)
SELECT p.day, p.grp, p.units, ROUND(prof.md_mean, 6) AS md_mean
FROM panel p LEFT JOIN prof ON month(p.day) = prof.m AND day(p.day) = prof.d
WHERE p.{S.VALID}
""")(month_day_profile)


def split_spans(spark, sf_dir):
    """N1-N3 + A35: rows, span and days per split, plus the complement of
    the validation window."""
    panel = P.panel_table(spark, sf_dir)
    labelled = panel.withColumn("split", P.split_label(F.col("day")))
    spans = PR.split_span(labelled)
    outside = SP.outside_window(panel, P.VALID_START, P.VALID_END).withColumn(
        "split", F.lit("not_validation"))
    early = SP.before(panel, P.VALID_START).withColumn("split", F.lit("before_validation"))
    return spans.unionByName(PR.split_span(outside)).unionByName(PR.split_span(early))


def _span_sql(where: str, label: str) -> str:
    return (f"SELECT {label} AS split, COUNT(*) AS rows, MIN(day) AS first_day, MAX(day) AS last_day, "
            f"COUNT(DISTINCT day) AS days FROM panel WHERE {where} GROUP BY 1")


query("n01_split_spans", f"""WITH {S.PANEL}
{_span_sql('TRUE', S.SPLIT_CASE)}
UNION ALL {_span_sql(f"NOT ({S.VALID})", "'not_validation'")}
UNION ALL {_span_sql(f"day < DATE '{P.VALID_START}'", "'before_validation'")}
""")(split_spans)


def hash_split(spark, sf_dir):
    """Seeded 80/20 split by a hash of (day, group); rows per side and
    group."""
    panel = P.panel_table(spark, sf_dir)
    tr, te = SP.random_split(panel, 80)
    return (tr.withColumn("side", F.lit("train")).unionByName(te.withColumn("side", F.lit("test")))
            .groupBy("side", "grp").agg(F.count(F.lit(1)).alias("rows"), F.sum("units").alias("units")))


_HASH = ("CAST(((date_diff('day', DATE '1970-01-01', day) * 2654435761 + grp * 40503 + 42 * 9973)"
         " % 1000003) % 100 AS INTEGER)")
query("n04_hash_split", f"""WITH {S.PANEL}
SELECT CASE WHEN {_HASH} < 80 THEN 'train' ELSE 'test' END AS side, grp,
       COUNT(*) AS rows, SUM(units) AS units
FROM panel GROUP BY 1, 2
""")(hash_split)


def imputation(spark, sf_dir):
    """Null indicators first, then temp by the train
    mean, wind by the train median, code to -1, flags to 0, presence flag
    of the joined text."""
    e = Q.enriched(spark, sf_dir)
    train = e.where(F.col("day") <= P.TRAIN_END)
    out = NU.null_indicators(e, ["temp", "wind"])
    out = NU.mean_impute(out, ["temp"], fit_on=train)
    out = NU.median_impute(out, ["wind"], fit_on=train)
    out = NU.fill_constant(out, ["code"], -1)
    out = NU.fill_constant(out, ["cloud"], 0)
    return out.select("day", "grp", rnd("temp", 9).alias("temp"), "wind", "code", "cloud",
                      "isnull_temp", "isnull_wind",
                      NU.presence_flag("description").alias("has_description"))


query("n08_imputation", f"""{BASE},
st AS (SELECT AVG(temp) AS mt, MEDIAN(wind) AS mw FROM enriched WHERE {S.TRAIN})
SELECT day, grp, ROUND(COALESCE(temp, (SELECT mt FROM st)), 9) AS temp,
       COALESCE(wind, (SELECT mw FROM st)) AS wind, COALESCE(code, -1) AS code,
       COALESCE(cloud, 0) AS cloud,
       CAST(temp IS NULL AS INTEGER) AS isnull_temp, CAST(wind IS NULL AS INTEGER) AS isnull_wind,
       CAST(description IS NOT NULL AS INTEGER) AS has_description
FROM enriched
""")(imputation)


def fill_forward_backward(spark, sf_dir):
    """Forward then backward fill of the joined daily measure within
    each group in day order."""
    e = Q.enriched(spark, sf_dir)
    out = NU.ffill_bfill(e, ["temp", "code"], ["grp"], "day")
    return out.select("day", "grp", rnd("temp", 9).alias("temp"), "code")


query("n11_fill_forward_backward", f"""{BASE},
f AS (SELECT day, grp,
        COALESCE(last_value(temp IGNORE NULLS) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                 first_value(temp IGNORE NULLS) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS temp,
        COALESCE(last_value(code IGNORE NULLS) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                 first_value(code IGNORE NULLS) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS code
      FROM enriched)
SELECT day, grp, ROUND(temp, 9) AS temp, code FROM f
""")(fill_forward_backward)


def fill_blocks(spark, sf_dir):
    """N11/W5 as ``n11_fill_forward_backward``, with each group's series cut into
    blocks."""
    e = Q.enriched(spark, sf_dir).select("day", "grp", "temp", "code")
    return SG.with_fill(e, ["temp", "code"], "grp", "day").select("day", "grp", rnd("temp", 9).alias("temp"), "code")


query("n11b_fill_blocks")(fill_blocks)
ORACLE["n11b_fill_blocks"] = ORACLE["n11_fill_forward_backward"]


# ------------------------------------------------------------ calendar features

EPOCH = "1995-01-01"
HARMONICS = 4


def calendar_features(spark, sf_dir):
    """F1-F22 over the panel's day spine."""
    panel = P.panel_table(spark, sf_dir)
    sp = Q.spine(spark, panel)
    out = D.calendar_features(sp)
    extra = {**D.cyclic_calendar(F.col("day")), **D.fourier_terms(F.col("day"), EPOCH, HARMONICS)}
    out = out.select("*", *[rnd(v, 9).alias(k) for k, v in extra.items()])
    return out.select("*", rnd(D.normalized_year(sp), 9).alias("norm_year"),
                      D.days_since_start(sp).alias("days_since_start"),
                      D.year_offset(F.col("day"), 1995).alias("year_offset"))


def _calendar_features_sql() -> str:
    import math
    two_pi = 2 * math.pi
    cyc = []
    for name, x, p in (("month", "month(day)", 12), ("day", "day(day)", 31),
                       ("week", "weekofyear(day)", 52), ("weekday", "(isodow(day) - 1)", 7)):
        cyc.append(f"ROUND(sin({two_pi!r} * {x} / {p}), 9) AS {name}_sin")
        cyc.append(f"ROUND(cos({two_pi!r} * {x} / {p}), 9) AS {name}_cos")
    t = f"CAST(date_diff('day', DATE '{EPOCH}', day) AS DOUBLE)"
    for name, p in (("weekly", 7.0), ("yearly", 365.25)):
        for i in range(1, HARMONICS + 1):
            cyc.append(f"ROUND(sin({two_pi!r} * {i} * {t} / {p}), 9) AS {name}_sin_{i}")
            cyc.append(f"ROUND(cos({two_pi!r} * {i} * {t} / {p}), 9) AS {name}_cos_{i}")
    names, german = (", ".join(f"'{n}'" for n in x) for x in (D.WEEKDAY_NAMES_EN, D.WEEKDAY_NAMES_DE))
    dom = "day(day)"
    m = "month(day)"
    return f"""WITH {S.PANEL},
{Q.SPINE}
SELECT day, CAST(year(day) AS INTEGER) AS year, CAST({m} AS INTEGER) AS month,
  CAST({dom} AS INTEGER) AS dom, CAST(quarter(day) AS INTEGER) AS quarter,
  {S.wd('day')} AS weekday, CAST(weekofyear(day) AS INTEGER) AS iso_week,
  [{names}][isodow(day)] AS weekday_name, [{german}][isodow(day)] AS weekday_name_de,
  CAST(isodow(day) >= 6 AS INTEGER) AS is_weekend,
  CASE WHEN {dom} <= 10 THEN 'start' WHEN {dom} <= 20 THEN 'middle' ELSE 'end' END AS month_third,
  CAST(({dom} - 1) // 7 + 1 AS INTEGER) AS week_of_month,
  CASE WHEN {m} IN (12, 1, 2) THEN 'winter' WHEN {m} IN (3, 4, 5) THEN 'spring'
       WHEN {m} IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season,
  CASE WHEN {m} <= 3 THEN 'winter' WHEN {m} <= 6 THEN 'spring' WHEN {m} <= 9 THEN 'summer' ELSE 'fall' END AS season_q,
  CAST({m} = 12 AND {dom} = 31 AS INTEGER) AS is_nye,
  strftime(day, '%m-%d') AS month_day,
  CAST(date_trunc('month', day) AS DATE) AS month_start,
  CAST(day = CAST(date_trunc('month', day) AS DATE) AS INTEGER) AS is_month_start,
  CAST(day = last_day(day) AS INTEGER) AS is_month_end,
  CAST(day = CAST(date_trunc('quarter', day) AS DATE) AS INTEGER) AS is_quarter_start,
  CAST(day = CAST(date_trunc('quarter', day) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS INTEGER) AS is_quarter_end,
  CAST({dom} <= 3 AS INTEGER) AS near_month_start, CAST({dom} >= 28 AS INTEGER) AS near_month_end,
  CAST({dom} <= 5 AS INTEGER) AS cycle_start, CAST({dom} > 5 AND {dom} < 25 AS INTEGER) AS cycle_mid,
  CAST({dom} >= 25 AS INTEGER) AS cycle_end,
  CAST({m} IN (12, 1, 2) AS INTEGER) AS is_winter, CAST({m} IN (3, 4, 5) AS INTEGER) AS is_spring,
  CAST({m} IN (6, 7, 8) AS INTEGER) AS is_summer, CAST({m} IN (9, 10, 11) AS INTEGER) AS is_fall,
  {", ".join(cyc)},
  ROUND((year(day) - (SELECT min(year(day)) FROM spine)) / (SELECT max(year(day)) - min(year(day)) FROM spine), 9) AS norm_year,
  CAST(date_diff('day', (SELECT min(day) FROM spine), day) AS INTEGER) AS days_since_start,
  CAST(year(day) - 1995 AS INTEGER) AS year_offset
FROM spine
"""


query("f01_calendar_features", _calendar_features_sql())(calendar_features)


# ------------------------------------------------------------ measure features

RAIN, SNOW = ["URGENT"], ["HIGH"]


def measure_features(spark, sf_dir):
    """F23-F34 over the day spine left-joined to the daily measures (days
    without orders keep null measures)."""
    panel = P.panel_table(spark, sf_dir)
    daily = P.daily_table(spark, sf_dir)
    codes = P.code_dictionary(spark, sf_dir)
    d = J.left_enrich(Q.spine(spark, panel), [(daily, ["day"])])
    d = J.lookup(d, codes, "code", "prio_code", ["description"])
    train = daily.where(F.col("day") <= P.TRAIN_END)
    edges = WX.quantile_edges(train, "temp")
    season = D.season_meteo(F.col("day"))
    cols = {
        "temp_base": WX.cut_right("temp", WX.BASE_EDGES, WX.BASE_LABELS),
        "temp_four": WX.cut_right("temp", WX.FOUR_EDGES, WX.FOUR_LABELS),
        "temp_season": WX.season_temp_category("temp", season, WX.SEASON_TEMP_TABLES["preparation"],
                                               WX.SEASON_TEMP_FALLBACK),
        "temp_season_h": WX.season_temp_category("temp", season, WX.SEASON_TEMP_TABLES["hybrid"],
                                                 WX.SEASON_TEMP_FALLBACK),
        "temp_season_s": WX.season_temp_category("temp", season, WX.SELECTION_TEMP_TABLE,
                                                 WX.SELECTION_TEMP_FALLBACK),
        "temp_q": WX.quantile_category("temp", edges),
        "felt": rnd(WX.felt_simple("temp", "wind"), 9),
        "felt_pw": rnd(WX.felt_piecewise("temp", "wind"), 9),
        "good": WX.good_weather("temp", "cloud", "description", RAIN, SNOW).cast("int"),
    }
    cols.update({k: v.cast("int") for k, v in WX.threshold_flags("temp").items()})
    cols.update({f"{k}_d": v.cast("int") for k, v in
                 WX.very_good_bad_weather("temp", "cloud", "description", RAIN, SNOW).items()})
    cols.update({f"{k}_s": v.cast("int") for k, v in WX.very_good_bad_weather("temp", "cloud").items()})
    cols.update({k: v.cast("int") for k, v in WX.comfort_flags("temp", "cloud", "wind").items()})
    winter = season == "winter"
    cols.update({k: rnd(v, 9) for k, v in WX.interactions("temp", "wind", "cloud", winter).items()})
    cols.update({k: v.cast("int") for k, v in WX.weekend_interactions(F.col("day"), "temp").items()})
    return d.select("day", *[v.alias(k) for k, v in cols.items()])


def _measure_features_sql() -> str:
    def cut(edges, labels):
        parts = " ".join(f"WHEN temp <= {e} THEN '{lab}'" for e, lab in zip(edges, labels))
        return f"CASE WHEN temp IS NULL THEN NULL {parts} ELSE '{labels[-1]}' END"

    season = ("CASE WHEN month(day) IN (12, 1, 2) THEN 'winter' WHEN month(day) IN (3, 4, 5) THEN 'spring' "
              "WHEN month(day) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END")

    def seasonal(table, fallback):
        parts = []
        for s, (lo, hi) in table.items():
            parts.append(f"WHEN {season} = '{s}' AND temp < {lo} THEN 'cold'")
            parts.append(f"WHEN {season} = '{s}' AND temp >= {lo} AND temp < {hi} THEN 'mild'")
            parts.append(f"WHEN {season} = '{s}' AND temp >= {hi} THEN 'warm'")
        return f"CASE {' '.join(parts)} ELSE '{fallback}' END"

    def t(c):
        return f"COALESCE({c}, FALSE)"

    c_rain = t("contains(description, 'URGENT')")
    c_snow = t("contains(description, 'HIGH')")
    wet = f"({c_rain} OR {c_snow})"
    we = "isodow(day) >= 6"
    pw = "pow(wind, 0.16)"
    heat = ("(-8.78469475556 + 1.61139411 * temp + 2.33854883889 * 0.5 - 0.14611605 * temp * 0.5"
            " - 0.012308094 * temp * temp - 0.0164248277778 * 0.5 * 0.5 + 0.002211732 * temp * temp * 0.5"
            " + 0.00072546 * temp * 0.5 * 0.5 - 0.000003582 * temp * temp * 0.5 * 0.5)")
    labels = ["very_cold", "cold", "mild", "warm", "hot"]
    q = " ".join(f"WHEN temp <= e[{i + 1}] THEN '{labels[i]}'" for i in range(4))
    return f"""WITH {S.PANEL},
{S.DAILY},
{S.CODES},
{Q.SPINE},
qe AS (SELECT quantile_cont(temp, [0.2, 0.4, 0.6, 0.8]) AS e FROM daily WHERE {S.TRAIN}),
d AS (SELECT s.day, dl.temp, dl.wind, dl.cloud, c.description FROM spine s
      LEFT JOIN daily dl ON s.day = dl.day LEFT JOIN codes c ON dl.code = c.prio_code)
SELECT day,
  {cut(WX.BASE_EDGES, WX.BASE_LABELS)} AS temp_base,
  {cut(WX.FOUR_EDGES, WX.FOUR_LABELS)} AS temp_four,
  {seasonal(WX.SEASON_TEMP_TABLES['preparation'], WX.SEASON_TEMP_FALLBACK)} AS temp_season,
  {seasonal(WX.SEASON_TEMP_TABLES['hybrid'], WX.SEASON_TEMP_FALLBACK)} AS temp_season_h,
  {seasonal(WX.SELECTION_TEMP_TABLE, WX.SELECTION_TEMP_FALLBACK)} AS temp_season_s,
  CASE WHEN temp IS NULL THEN NULL {q} ELSE 'hot' END AS temp_q,
  ROUND(temp - 0.2 * wind, 9) AS felt,
  ROUND(CASE WHEN temp < 10 THEN 13.12 + 0.6215 * temp - 11.37 * {pw} + 0.3965 * temp * {pw}
             WHEN temp > 20 THEN {heat} ELSE temp END, 9) AS felt_pw,
  CAST({t('temp >= 15')} AND {t('cloud <= 5')} AND NOT {wet} AS INTEGER) AS good,
  CAST({t('temp >= 20')} AS INTEGER) AS temp_warm,
  CAST({t('temp >= 10 AND temp < 20')} AS INTEGER) AS temp_mild,
  CAST({t('temp < 10')} AS INTEGER) AS temp_cold,
  CAST({t('temp >= 20')} AND {t('cloud <= 3')} AND NOT {wet} AS INTEGER) AS very_good_d,
  CAST({t('temp < 10')} OR {t('cloud > 6')} OR {wet} AS INTEGER) AS bad_d,
  CAST({t('temp > 15')} AND {t('cloud < 5')} AS INTEGER) AS good_s,
  CAST({t('temp > 20')} AND {t('cloud < 3')} AS INTEGER) AS very_good_s,
  CAST({t('temp < 10')} OR {t('cloud > 6')} AS INTEGER) AS bad_s,
  CAST({t('temp BETWEEN 18 AND 25')} AND {t('cloud <= 5')} AND {t('wind <= 15')} AS INTEGER) AS comfort,
  CAST({t('temp < 5')} OR {t('temp > 30')} OR {t('cloud >= 7')} OR {t('wind >= 25')} AS INTEGER) AS discomfort,
  ROUND(temp * wind, 9) AS temp_wind, ROUND(temp * cloud, 9) AS temp_cloud,
  ROUND(wind * cloud, 9) AS wind_cloud,
  ROUND(temp * CAST({season} = 'winter' AS DOUBLE), 9) AS temp_winter,
  CAST(month(day) IN (6, 7, 8) AND {we} AS INTEGER) AS summer_weekend,
  CAST(month(day) IN (12, 1, 2) AND {we} AS INTEGER) AS winter_weekend,
  CAST({t('temp >= 20')} AND {we} AS INTEGER) AS warm_weekend,
  CAST({t('temp <= 10')} AND {we} AS INTEGER) AS cold_weekend
FROM d, qe
"""


query("f23_measure_features", _measure_features_sql())(measure_features)


# ------------------------------------------------------------ encodings

WEEKDAYS = list(range(7))
THIRDS = ["end", "middle", "start"]          # sorted level list, first dropped
CONDITIONS = {"cond_urgent": "URGENT", "cond_high": "HIGH", "cond_low": "LOW"}
LAYOUT = (["day", "grp", "label"] + [f"wd_{i}" for i in WEEKDAYS]
          + [f"third_{t}" for t in THIRDS[1:]] + list(CONDITIONS) + ["wd_7"])


def encodings(spark, sf_dir):
    """Label map, full one-hot of weekday, drop-first one-hot
    of the month third, substring condition flags, fixed column layout (a
    level that never occurs still gets its column)."""
    e = Q.enriched(spark, sf_dir)
    cols = {"label": EN.label_map("grp", P.GROUP_LABELS)}
    cols.update(EN.one_hot(F.weekday("day"), WEEKDAYS, "wd"))
    cols.update(EN.one_hot(D.month_third("day"), THIRDS, "third", drop_first=True))
    cols.update(EN.substring_flags("description", CONDITIONS))
    out = e.select("day", "grp", *[v.alias(k) for k, v in cols.items()])
    return EN.align_columns(out, LAYOUT)


def _encodings_sql() -> str:
    wd = ", ".join(f"CAST(isodow(day) - 1 = {i} AS INTEGER) AS wd_{i}" for i in WEEKDAYS)
    third = "CASE WHEN day(day) <= 10 THEN 'start' WHEN day(day) <= 20 THEN 'middle' ELSE 'end' END"
    th = ", ".join(f"CAST({third} = '{t}' AS INTEGER) AS third_{t}" for t in THIRDS[1:])
    cond = ", ".join(f"CAST(COALESCE(contains(description, '{v}'), FALSE) AS INTEGER) AS {k}"
                     for k, v in CONDITIONS.items())
    return f"""{BASE}
SELECT day, grp, {S.LABEL_CASE} AS label, {wd}, {th}, {cond}, 0 AS wd_7 FROM enriched
"""


query("f35_encodings", _encodings_sql())(encodings)


# ------------------------------------------------------------ scaling

def scaling(spark, sf_dir):
    """Standard and robust scaling fitted on train, applied to
    validation; double scaling; target normalised and restored."""
    e = Q.enriched(spark, sf_dir).where(F.col("temp").isNotNull())
    train = e.where(F.col("day") <= P.TRAIN_END)
    valid = e.where(F.col("day").between(P.VALID_START, P.VALID_END))
    std = SC.fit_standard(train, ["temp", "wind"])
    rob = SC.fit_robust(train, ["temp"])
    tgt = SC.target_normalizer(train, "units")
    out = SC.apply_standard(valid, std, "_z")
    out = SC.apply_robust(out, rob, "_r")
    dbl = SC.double_standardize(train, [valid], ["temp"], ["temp", "wind"])[1]
    out = out.join(dbl.select("day", "grp", F.col("temp").alias("temp_zz")), ["day", "grp"])
    out = out.withColumn("units_n", SC.normalize_target(F.col("units"), tgt))
    out = out.withColumn("units_back", SC.denormalize_target(F.col("units_n"), tgt))
    return out.select("day", "grp", *[rnd(c, 6).alias(c) for c in
                                      ("temp_z", "wind_z", "temp_r", "temp_zz", "units_n",
                                       "units_back")])


query("f39_scaling", f"""{BASE},
e AS (SELECT * FROM enriched WHERE temp IS NOT NULL),
tr AS (SELECT * FROM e WHERE {S.TRAIN}),
st AS (SELECT AVG(temp) AS mt, stddev_pop(temp) AS st, AVG(wind) AS mw, stddev_pop(wind) AS sw,
              quantile_cont(temp, 0.5) AS med, quantile_cont(temp, 0.75) - quantile_cont(temp, 0.25) AS iqr,
              AVG(units) AS mu, stddev_pop(units) AS su FROM tr),
z1 AS (SELECT AVG((temp - mt) / st) AS m2, stddev_pop((temp - mt) / st) AS s2 FROM tr, st),
v AS (SELECT e.*, (temp - mt) / st AS tz, (wind - mw) / sw AS wz, (temp - med) / iqr AS tr_,
             (units - mu) / su AS un, mu, su FROM e, st WHERE e.{S.VALID})
SELECT day, grp, ROUND(tz, 6) AS temp_z, ROUND(wz, 6) AS wind_z, ROUND(tr_, 6) AS temp_r,
       ROUND((tz - m2) / s2, 6) AS temp_zz, ROUND(un, 6) AS units_n, ROUND(un * su + mu, 6) AS units_back
FROM v, z1
""")(scaling)


def fact_scaling(spark, sf_dir):
    """F27, F40 and N9 fitted on the fact table by distributed selection: every
    line's price scaled by the train lines' median and IQR, binned by their
    quintiles, zero tax read as missing and filled with their median."""
    lines = read_table(spark, sf_dir, "lineitem", ["l_shipdate", "l_extendedprice", "l_tax"]).select(
        F.to_date("l_shipdate").alias("day"), F.col("l_extendedprice").cast("double").alias("price"),
        F.nullif(F.col("l_tax").cast("double"), F.lit(0.0)).alias("tax"))
    train = lines.where(F.col("day") <= P.TRAIN_END)
    fitted = QU.Selection(train, ["price", "tax"], [0.2, 0.25, 0.4, 0.5, 0.6, 0.75, 0.8])      # one selection for all three
    out = NU.median_impute(lines, ["tax"], fit_on=train, select=fitted)
    out = SC.apply_robust(out, SC.fit_robust(train, ["price"], select=fitted), "_r")
    quintile = WX.quantile_category("price", WX.quantile_edges(train, "price", select=fitted), ("q1", "q2", "q3", "q4", "q5"))
    return out.groupBy(P.split_label(F.col("day")).alias("split"), quintile.alias("quintile")).agg(
        F.count(F.lit(1)).alias("n"), rnd(F.avg("price_r"), 6).alias("price_r"),
        rnd(F.max("price_r"), 6).alias("max_price_r"), rnd(F.avg("tax"), 6).alias("tax"))


query("f40b_fact_scaling", f"""WITH l AS (
  SELECT CAST(l_shipdate AS DATE) AS day, CAST(l_extendedprice AS DOUBLE) AS price, nullif(CAST(l_tax AS DOUBLE), 0) AS tax
  FROM lineitem),
st AS (SELECT quantile_cont(price, [0.2, 0.4, 0.6, 0.8]) AS e, quantile_cont(price, 0.5) AS med,
              quantile_cont(price, 0.75) - quantile_cont(price, 0.25) AS iqr, quantile_cont(tax, 0.5) AS t
       FROM l WHERE {S.TRAIN}),
r AS (SELECT {S.SPLIT_CASE} AS split, CASE WHEN price <= e[1] THEN 'q1' WHEN price <= e[2] THEN 'q2'
        WHEN price <= e[3] THEN 'q3' WHEN price <= e[4] THEN 'q4' ELSE 'q5' END AS quintile,
        (price - med) / iqr AS price_r, COALESCE(tax, t) AS tax
      FROM l p, st)
SELECT split, quintile, COUNT(*) AS n, ROUND(AVG(price_r), 6) AS price_r, ROUND(MAX(price_r), 6) AS max_price_r,
  ROUND(AVG(tax), 6) AS tax
FROM r GROUP BY 1, 2
""")(fact_scaling)
