"""Event impact (E1-E8) and feature ranking (R1-R9) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import rnd
from ..operators import impact as IM
from ..operators import linear as LN
from ..operators import ranking as RK
from ..session import materialize
from ..sources import panel as P
from . import common as Q
from . import sqlparts as S
from .profiling import BASE, SCORED, _describe_sql, scored
from .registry import query


def event_describe(spark, sf_dir):
    """E1 + E2: describe of units on parade vs other days, over all days and
    over Saturdays only (weekday control)."""
    e = Q.enriched(spark, sf_dir)
    allrows = IM.flag_describe(e, "is_parade", "units").withColumn("scope", F.lit("all"))
    sat = IM.flag_describe(e.where(F.weekday("day") == 5), "is_parade", "units").withColumn(
        "scope", F.lit("saturday"))
    return allrows.unionByName(sat)


query("e01_event_describe", f"""{BASE},
sat AS (SELECT * FROM enriched WHERE isodow(day) = 6)
SELECT *, 'all' AS scope FROM ({_describe_sql(['units'], 'enriched', ['is_parade'])}) a
UNION ALL SELECT *, 'saturday' FROM ({_describe_sql(['units'], 'sat', ['is_parade'])}) b
""")(event_describe)


def uplift(spark, sf_dir):
    """Parade uplift overall, against Saturdays only, and per group
    (groups without parade rows are skipped)."""
    e = Q.enriched(spark, sf_dir)
    a = IM.uplift(e, "is_parade", "units").withColumn("grp", F.lit(None).cast("int"))
    s = IM.uplift(e.where(F.weekday("day") == 5), "is_parade", "units").withColumn(
        "grp", F.lit(None).cast("int"))
    g = IM.uplift(e, "is_parade", "units", by=["grp"])
    return (a.withColumn("scope", F.lit("all")).unionByName(s.withColumn("scope", F.lit("saturday")))
            .unionByName(g.withColumn("scope", F.lit("group"))))


def _uplift_sql(src, by, scope):
    keys = f"{by}, " if by else "CAST(NULL AS INTEGER) AS grp, "
    grp = f" GROUP BY {by}" if by else ""
    return f"""SELECT {keys}ROUND(AVG(CASE WHEN is_parade THEN units END), 6) AS event_mean,
  ROUND(AVG(CASE WHEN NOT is_parade THEN units END), 6) AS base_mean,
  COUNT(CASE WHEN is_parade THEN units END) AS event_n, COUNT(CASE WHEN NOT is_parade THEN units END) AS base_n,
  ROUND((AVG(CASE WHEN is_parade THEN units END) / AVG(CASE WHEN NOT is_parade THEN units END) - 1) * 100, 6) AS uplift_pct,
  '{scope}' AS scope
FROM {src}{grp} HAVING COUNT(CASE WHEN is_parade THEN units END) > 0"""


query("e03_uplift", f"""{BASE},
sat AS (SELECT * FROM enriched WHERE isodow(day) = 6)
{_uplift_sql('enriched', None, 'all')}
UNION ALL {_uplift_sql('sat', None, 'saturday')}
UNION ALL {_uplift_sql('enriched', 'grp', 'group')}
""")(uplift)

EVENTS = ("is_nye", "is_easter_saturday", "is_parade")


def event_intervals(spark, sf_dir):
    """Mean, 95% t-interval and samples per event, on daily totals and
    per group; events with fewer than 2 samples are dropped."""
    e = Q.enriched(spark, sf_dir)
    long = None
    for ev in EVENTS:
        part = e.where(F.col(ev)).select(F.lit(ev[3:]).alias("event"), "day", "grp", "units")
        long = part if long is None else long.unionByName(part)
    totals = long.groupBy("event", "day").agg(F.sum("units").alias("units"))
    t = IM.event_intervals(totals, "event", "units").withColumn("grp", F.lit(None).cast("int"))
    g = IM.event_intervals(long, "event", "units", by=["grp"])
    return t.unionByName(g)


def _t_sql(df: str) -> str:
    z = IM.Z975
    table = "[" + ", ".join(repr(v) for v in IM.T975) + "]"
    v = f"CAST({df} AS DOUBLE)"
    series = (f"({z!r} + {z ** 3 + z!r} / (4 * {v}) + {5 * z ** 5 + 16 * z ** 3 + 3 * z!r} / (96 * {v} * {v})"
              f" + {3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z!r} / (384 * {v} * {v} * {v}))")
    return f"(CASE WHEN {df} < 1 THEN NULL WHEN {df} <= 30 THEN {table}[{df}] ELSE {series} END)"


def _intervals_sql(src, by):
    keys = f"{by}, " if by else "CAST(NULL AS INTEGER) AS grp, "
    grp = f"{by}, " if by else ""
    return f"""SELECT {keys}event, COUNT(units) AS samples, ROUND(AVG(units), 6) AS mean,
  ROUND(stddev_samp(units) / sqrt(COUNT(units)) * {_t_sql('COUNT(units) - 1')}, 6) AS ci,
  COUNT(units) < 5 AS small_sample
FROM {src} GROUP BY {grp}event HAVING COUNT(units) >= 2"""


query("e04_event_intervals", f"""{BASE},
long AS (""" + "\nUNION ALL ".join(
    f"SELECT '{ev[3:]}' AS event, day, grp, units FROM enriched WHERE {ev}" for ev in EVENTS) + f"""),
totals AS (SELECT event, day, SUM(units) AS units FROM long GROUP BY 1, 2)
{_intervals_sql('totals', None)}
UNION ALL {_intervals_sql('long', 'grp')}
""")(event_intervals)


def event_history(spark, sf_dir):
    """E5: units on parade and Easter-Saturday days per group (semi join)."""
    panel = P.panel_table(spark, sf_dir)
    days = Q.parade(panel).unionByName(Q.easter_saturdays(panel))
    return IM.event_history(panel, days, "units")


query("e05_event_history", f"""WITH {S.PANEL},
{Q.calendar_ctes()},
days AS (SELECT day FROM parade UNION SELECT day FROM easter_sat)
SELECT grp, COUNT(units) AS n, ROUND(AVG(units), 6) AS mean, ROUND(stddev_samp(units), 6) AS std,
       MIN(units) AS min, MAX(units) AS max
FROM panel WHERE day IN (SELECT day FROM days) GROUP BY grp
""")(event_history)


def event_rows(spark, sf_dir):
    """Validation predictions on holidays, sorted by day and group."""
    s = scored(spark, sf_dir, last=P.VALID_END).where(F.col("split") == "validation")
    out = IM.event_rows(s, Q.holidays(P.panel_days(spark, sf_dir)), order=["day", "grp"])
    return out.select("day", "grp", "actual", rnd("pred", 6).alias("pred"))


query("e06_event_rows", f"""WITH {S.PANEL},
{Q.calendar_ctes()},
{SCORED}
SELECT day, grp, actual, ROUND(pred, 6) AS pred FROM scored
WHERE split = 'validation' AND day IN (SELECT day FROM holidays) ORDER BY day, grp
""")(event_rows)


def event_split_stats(spark, sf_dir):
    """E7 (per split) + E8 (per split and group): festival-day mean, max and
    min of units."""
    e = Q.enriched(spark, sf_dir).withColumn("split", P.split_label(F.col("day")))
    a = IM.event_split_stats(e, "is_festival", "units", ["split"]).withColumn(
        "grp", F.lit(None).cast("int"))
    b = IM.event_split_stats(e, "is_festival", "units", ["split", "grp"])
    return a.unionByName(b)


query("e07_event_split_stats", f"""{BASE},
l AS (SELECT *, {S.SPLIT_CASE} AS split, CASE WHEN is_festival THEN units END AS v FROM enriched)
SELECT split, CAST(NULL AS INTEGER) AS grp, COUNT(v) AS n, ROUND(AVG(v), 6) AS mean, MAX(v) AS max, MIN(v) AS min
FROM l GROUP BY split
UNION ALL
SELECT split, grp, COUNT(v), ROUND(AVG(v), 6), MAX(v), MIN(v) FROM l GROUP BY split, grp
""")(event_split_stats)


# ---------------------------------------------------------------- ranking

FEATURES = ["lines", "n_orders", "temp", "wind", "cloud"]


def _f_sql(src, by=None):
    keys = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    parts = []
    for c in FEATURES:
        r = S.corr(c, "units")
        n = f"COUNT(CASE WHEN {c} IS NOT NULL AND units IS NOT NULL THEN 1 END)"
        parts.append(f"SELECT {keys}'{c}' AS feature, ROUND(COALESCE({r} * {r} / NULLIF(1 - {r} * {r}, 0)"
                     f" * ({n} - 2), 0.0), 6) AS f_score FROM {src}{grp}")
    return "\nUNION ALL ".join(parts)


def f_scores(spark, sf_dir):
    """Univariate F score of each feature against units, all rows."""
    return RK.f_scores(Q.enriched(spark, sf_dir), FEATURES, "units")


query("r01_f_scores", f"{BASE}\n{_f_sql('enriched')}")(f_scores)


def f_scores_group_max(spark, sf_dir):
    """R2: per-group F scores, maximum over groups (constant -> 0)."""
    return RK.f_scores_max_over_groups(Q.enriched(spark, sf_dir), FEATURES, "units", "grp")


query("r02_f_scores_group_max", f"""{BASE},
per AS ({_f_sql('enriched', 'grp')})
SELECT feature, MAX(f_score) AS f_score FROM per GROUP BY feature
""")(f_scores_group_max)


def top_features(spark, sf_dir):
    """The three best features by group-max F score."""
    return RK.ranked(f_scores_group_max(spark, sf_dir), 3)


query("r03_top_features", f"""{BASE},
per AS ({_f_sql('enriched', 'grp')})
SELECT feature, MAX(f_score) AS f_score, CAST(row_number() OVER (ORDER BY MAX(f_score) DESC, feature) AS INTEGER) AS rank
FROM per GROUP BY feature ORDER BY rank LIMIT 3
""")(top_features)


def _design(spark, sf_dir):
    e = Q.enriched(spark, sf_dir).where(F.col("day") <= P.TRAIN_END)
    e = e.select("units", "lines", "n_orders", "temp", "wind", "cloud",
                 (F.weekday("day") >= 5).cast("int").alias("weekend"),
                 F.col("is_holiday").cast("int").alias("holiday"),
                 *[(F.col("grp") == g).cast("int").alias(f"g{g}") for g in list(P.GROUP_LABELS)[1:]])
    return materialize(e.dropna())


# Fixed value: the largest subset of the exhaustive search.
MAX_FEATURES = 10
DESIGN = ["n_orders", "temp", "wind", "cloud", "weekend", "holiday"] + \
    [f"g{g}" for g in list(P.GROUP_LABELS)[1:]]


def prefix_search(spark, sf_dir):
    """R4 + R6: adjusted R^2 of OLS on the first 1..k features ranked by F
    score, from one Gram pass (candidates scored in mapInPandas)."""
    d = _design(spark, sf_dir)
    ranks = RK.f_scores(d, DESIGN, "units").orderBy(F.col("f_score").desc(), "feature")
    order = [r.feature for r in ranks.collect()]  # k names, k = number of features
    g = LN.gram(d, order, "units").first().asDict()
    res = LN.score_subsets(spark, g, order, LN.prefix_masks(spark, len(order)))
    return res.select("size", LN.mask_names(order).alias("features"), rnd("r2", 6).alias("r2"),
                      rnd("adj_r2", 6).alias("adj_r2"))


query("r04_prefix_search")(prefix_search)


def subset_search(spark, sf_dir):
    """Exhaustive subset search (every non-empty subset of up to
    ``MAX_FEATURES`` design columns) by adjusted R^2, report of the best 10."""
    d = _design(spark, sf_dir)
    feats = DESIGN
    g = LN.gram(d, feats, "units").first().asDict()
    res = LN.score_subsets(spark, g, feats, LN.all_masks(spark, len(feats), MAX_FEATURES))
    return (res.orderBy(F.col("adj_r2").desc(), "mask").limit(10)
            .select("size", LN.mask_names(feats).alias("features"), rnd("adj_r2", 6).alias("adj_r2")))


query("r05_subset_search")(subset_search)


def coefficients(spark, sf_dir):
    """R7 + R9: pooled OLS coefficients ranked by |coef| (signed kept), and
    the temperature coefficient flagged."""
    fit = LN.fit_pooled(_design(spark, sf_dir), DESIGN, "units")
    t = LN.coefficient_table(spark, fit)
    return t.select("feature", rnd("coef", 6).alias("coef"), rnd("abs_coef", 6).alias("abs_coef"),
                    (F.col("feature") == "temp").alias("is_named")).orderBy(F.col("abs_coef").desc())


query("r07_coefficients")(coefficients)

