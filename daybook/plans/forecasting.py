"""Forecaster and evaluation queries (M, V)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import forecast as fc
from ..session import materialize
from ..sources.panel import TRAIN_END, VALID_END, VALID_START, panel_table
from . import sqlparts as S
from .registry import query


def _train_valid(spark, sf_dir, **pruned):
    panel = panel_table(spark, sf_dir, **pruned)
    train = panel.where(F.col("day") <= TRAIN_END)
    valid = panel.where(F.col("day").between(VALID_START, VALID_END))
    return panel, train, valid


def weekday_mean_eval(spark, sf_dir):
    """M1 + J3 + V2 + V4: weekday x group means fitted on train, scored on
    validation, MAE / RMSE / R^2 / MAPE per group."""
    _, train, valid = _train_valid(spark, sf_dir)
    scored = fc.weekday_mean_forecast(train, valid.withColumnRenamed("units", "actual"),
                                      value="units")
    return ev.error_metrics(scored, "actual", "pred", by=["grp"])


query("m01_weekday_mean_eval", f"""
WITH {S.PANEL},
model AS (SELECT {S.wd('day')} AS weekday, grp, AVG(units) AS pred FROM panel WHERE {S.TRAIN} GROUP BY 1, 2),
scored AS (SELECT p.grp, p.units AS actual, m.pred FROM panel p
           JOIN model m ON {S.wd('p.day')} = m.weekday AND p.grp = m.grp
           WHERE p.{S.VALID})
SELECT grp, {S.metrics()} FROM scored GROUP BY grp
""")(weekday_mean_eval)


# ---------------------------------------------------------------- more forecasters

from ..functions.numeric import rnd  # noqa: E402
from ..functions import nulls as NU  # noqa: E402
from ..operators import harmonics as HM  # noqa: E402
from ..operators import linear as LN  # noqa: E402
from ..operators import mlmodels as ML  # noqa: E402
from ..sources import panel as P  # noqa: E402
from . import common as Q  # noqa: E402


def fixed_linear_eval(spark, sf_dir):
    """M2 + V1: the hand-set linear scorer on the validation year, overall
    metrics."""
    _, _, valid = _train_valid(spark, sf_dir)
    s = valid.select(F.col("units").alias("actual"),
                     fc.fixed_linear_score(F.col("day"), F.col("grp")).alias("pred"))
    return ev.error_metrics(s, "actual", "pred")


query("m02_fixed_linear_eval", f"""
WITH {S.PANEL},
s AS (SELECT units AS actual,
        85.08 + 23.87 * CAST(isodow(day) >= 6 AS DOUBLE) + 69.39 * CAST(month(day) IN (7, 8, 9) AS DOUBLE)
        + CASE WHEN grp = 2 THEN 306.89 WHEN grp = 3 THEN 60.44 WHEN grp = 5 THEN 177.19 ELSE 0.0 END AS pred
      FROM panel WHERE {S.VALID})
SELECT {S.metrics()} FROM s
""")(fixed_linear_eval)


def group_weekday_ols(spark, sf_dir):
    """M8: OLS on one-hot weekday for one group equals that group's weekday
    means; fitted on group 1's train rows, scored on its validation rows,
    metrics."""
    _, train, valid = _train_valid(spark, sf_dir, last=VALID_END, groups=[1])
    scored = fc.weekday_mean_forecast(train, valid.withColumnRenamed("units", "actual"))
    return ev.error_metrics(scored, "actual", "pred", by=["grp"])


query("m08_group_weekday_ols", f"""
WITH {S.PANEL},
model AS (SELECT {S.wd('day')} AS weekday, AVG(units) AS pred FROM panel WHERE {S.TRAIN} AND grp = 1 GROUP BY 1),
scored AS (SELECT p.grp, p.units AS actual, m.pred FROM panel p JOIN model m ON {S.wd('p.day')} = m.weekday
           WHERE p.{S.VALID} AND p.grp = 1)
SELECT grp, {S.metrics()} FROM scored GROUP BY grp
""")(group_weekday_ols)


def _features_frame(spark, sf_dir):
    """Model matrix shared by the fitted forecasters (M18: one function for
    train, validation and future rows)."""
    e = Q.enriched(spark, sf_dir)
    train = e.where(F.col("day") <= TRAIN_END)
    e = NU.mean_impute(e, ["temp", "wind", "cloud"], fit_on=train)
    return materialize(e.select(
        "day", "grp", "units", "temp", "wind", "cloud",
        F.weekday("day").alias("weekday"),
        F.col("is_holiday").cast("int").alias("holiday"),
        F.col("is_festival").cast("int").alias("festival"),
        F.month("day").isin(6, 7, 8).cast("int").alias("summer"),
        *[(F.weekday("day") == d).cast("int").alias(f"wd{d}") for d in range(1, 7)],
        *[(F.col("grp") == g).cast("int").alias(f"g{g}") for g in list(P.GROUP_LABELS)[1:]],
        P.split_label(F.col("day")).alias("split")))


NUMERIC = ["temp", "wind", "cloud"]
# no weekend flag: it is the sum of two weekday columns
BINARY = ["holiday", "festival", "summer"] + [f"wd{d}" for d in range(1, 7)] + \
    [f"g{g}" for g in list(P.GROUP_LABELS)[1:]]


def pooled_ols(spark, sf_dir):
    """M3-M6 + F43 + V2: MLlib pipeline (scaled numeric, one-hot, OLS by
    normal equations) fitted on train, metrics per split and group."""
    x = _features_frame(spark, sf_dir)
    pipe = ML.feature_pipeline(NUMERIC, BINARY, "units", ML.ols("units"))
    _, out = ML.fit_score(pipe, x.where(F.col("split") == "train"),
                          x.where(F.col("split").isin("train", "validation")))
    return ev.error_metrics(out.withColumnRenamed("units", "actual"), "actual", "pred",
                            by=["split", "grp"])


query("m03_pooled_ols")(pooled_ols)


def per_group_ols(spark, sf_dir):
    """M7 + M16: one OLS per group on shared features (Gram per group,
    solved in applyInPandas; small groups fall back to their mean), scored
    on validation, metrics per group."""
    x = _features_frame(spark, sf_dir)
    feats = NUMERIC + ["holiday", "festival", "summer"] + [f"wd{d}" for d in range(1, 7)]
    models = LN.fit_per_group(x.where(F.col("split") == "train"), feats, "units", "grp")
    s = LN.score_per_group(x.where(F.col("split") == "validation"), models, feats, "grp")
    return ev.error_metrics(s.withColumnRenamed("units", "actual"), "actual", "pred", by=["grp"])


query("m07_per_group_ols")(per_group_ols)


def _spectrum(spark, sf_dir):
    panel = panel_table(spark, sf_dir)
    train = panel.where(F.col("day") <= TRAIN_END)
    spec = materialize(HM.spectrum(train, value="units"))
    return panel, train, spec


def spectrum_top(spark, sf_dir):
    """M9 + M10 + W8: DFT of each group's train series, the four largest
    one-sided harmonics."""
    _, _, spec = _spectrum(spark, sf_dir)
    top = HM.dominant(spec, 4)
    return top.select("grp", "rank", "k", "n", rnd("freq", 9).alias("freq"), rnd("amp", 3).alias("amp"))


query("m09_spectrum_top", f"""
WITH {S.PANEL},
s AS (SELECT grp, units AS y, CAST(row_number() OVER (PARTITION BY grp ORDER BY day) - 1 AS BIGINT) AS t,
             COUNT(*) OVER (PARTITION BY grp) AS n FROM panel WHERE {S.TRAIN}),
ks AS (SELECT DISTINCT grp, n, unnest(range(1, CAST(floor(n / 2) AS BIGINT) + 1)) AS k FROM s),
dft AS (SELECT ks.grp, ks.k, ks.n,
               SUM(s.y * cos(2 * pi() * ks.k * s.t / ks.n)) AS re,
               -SUM(s.y * sin(2 * pi() * ks.k * s.t / ks.n)) AS im
        FROM ks JOIN s ON ks.grp = s.grp GROUP BY ks.grp, ks.k, ks.n),
r AS (SELECT grp, k, n, sqrt(re * re + im * im) AS amp,
             row_number() OVER (PARTITION BY grp ORDER BY sqrt(re * re + im * im) DESC, k DESC) AS rank FROM dft)
SELECT grp, CAST(rank AS INTEGER) AS rank, k, n, ROUND(CAST(k AS DOUBLE) / n, 9) AS freq, ROUND(amp, 3) AS amp
FROM r WHERE rank <= 4
""")(spectrum_top)


def harmonic_forecast(spark, sf_dir):
    """M11 + N14 + V2 + V8: mean + 4 harmonics of each group's train series,
    continued over the validation rows (t keeps counting, D7), clipped at
    0; MAE / RMSE per group and the mean of the group MAEs."""
    panel, train, spec = _spectrum(spark, sf_dir)
    top = HM.dominant(spec, 4)
    valid = panel.where(F.col("day").between(VALID_START, VALID_END))
    rows = HM.continue_index(train, valid)
    pred = HM.reconstruct(rows, spec, top).withColumn("pred", NU.clip_min("pred"))
    pred = pred.withColumnRenamed("units", "actual")
    per = ev.error_metrics(pred, "actual", "pred", by=["grp"], digits=3)
    mean = ev.mean_group_mae(pred).select(rnd("mean_group_mae", 3)).scalar()
    return per.withColumn("mean_group_mae", mean)


DFT = f"""s AS (SELECT grp, units AS y, CAST(row_number() OVER (PARTITION BY grp ORDER BY day) - 1 AS BIGINT) AS t,
             COUNT(*) OVER (PARTITION BY grp) AS n FROM panel WHERE {S.TRAIN}),
ks AS (SELECT DISTINCT grp, n, unnest(range(0, CAST(floor(n / 2) AS BIGINT) + 1)) AS k FROM s),
dft AS (SELECT ks.grp, ks.k, ks.n,
               SUM(s.y * cos(2 * pi() * ks.k * s.t / ks.n)) AS re,
               -SUM(s.y * sin(2 * pi() * ks.k * s.t / ks.n)) AS im
        FROM ks JOIN s ON ks.grp = s.grp GROUP BY ks.grp, ks.k, ks.n),
top AS (SELECT *, sqrt(re * re + im * im) AS amp, atan2(im, re) AS phase FROM dft WHERE k > 0
        QUALIFY row_number() OVER (PARTITION BY grp ORDER BY sqrt(re * re + im * im) DESC, k DESC) <= 4),
mean AS (SELECT grp, re / n AS m, n FROM dft WHERE k = 0),
v AS (SELECT grp, day, units, CAST(row_number() OVER (PARTITION BY grp ORDER BY day) - 1 AS BIGINT) AS t0
      FROM panel WHERE {S.VALID})"""

query("m11_harmonic_forecast", f"""
WITH {S.PANEL}, {DFT},
p AS (SELECT v.grp, v.day, v.units AS actual,
             greatest(0.0, any_value(mean.m) + SUM(2 * top.amp / top.n * cos(2 * pi() * top.k / top.n * (v.t0 + top.n) + top.phase))) AS pred
      FROM v JOIN mean ON v.grp = mean.grp JOIN top ON v.grp = top.grp GROUP BY v.grp, v.day, v.units),
per AS (SELECT grp, {S.metrics(digits=3)} FROM p GROUP BY grp),
g AS (SELECT AVG(mae) AS mean_group_mae FROM (SELECT AVG(ABS(actual - pred)) AS mae FROM p GROUP BY grp) t)
SELECT per.*, ROUND(g.mean_group_mae, 3) AS mean_group_mae FROM per CROSS JOIN g
""")(harmonic_forecast)


def harmonic_features(spark, sf_dir):
    """Five harmonics from train, as re cos and im sin columns, for train
    and validation rows (t keeps counting)."""
    panel, train, spec = _spectrum(spark, sf_dir)
    t = HM.continue_index(train, panel.where(F.col("day").between(VALID_START, VALID_END)))
    tr = train.withColumn("t", HM.time_index("grp", "day"))
    out = HM.harmonic_features(tr.unionByName(t), spec)
    return out.select("day", "grp", "t", *[rnd(c, 3).alias(c) for r in range(1, 6) for c in (f"harm_{r}_cos", f"harm_{r}_sin")])


query("m13_harmonic_features", f"""
WITH {S.PANEL}, {DFT},
h AS (SELECT grp, k, n, re, im, row_number() OVER (PARTITION BY grp ORDER BY sqrt(re * re + im * im) DESC, k DESC) AS rank
      FROM dft WHERE k < CAST(floor(n / 2) AS BIGINT)),
r AS (SELECT p.day, p.grp, s.t FROM s JOIN (SELECT grp, day, CAST(row_number() OVER (PARTITION BY grp ORDER BY day) - 1 AS BIGINT) AS t
                                             FROM panel WHERE {S.TRAIN}) p ON s.grp = p.grp AND s.t = p.t
      UNION ALL SELECT v.day, v.grp, v.t0 + mean.n FROM v JOIN mean ON v.grp = mean.grp)
SELECT r.day, r.grp, r.t, """ + ", ".join(
    f"ROUND(MAX(CASE WHEN h.rank = {i} THEN h.{part} * {fn}(2 * pi() * (CAST(h.k AS DOUBLE) / h.n) * r.t) END), 3) AS harm_{i}_{fn}"
    for i in range(1, 6) for fn, part in (("cos", "re"), ("sin", "im"))) + """
FROM r JOIN h ON r.grp = h.grp AND h.rank <= 5 GROUP BY r.day, r.grp, r.t
""")(harmonic_features)


def random_forest(spark, sf_dir):
    """Random forest (300 trees, depth 8, min 5 rows per leaf) on
    calendar, measure and harmonic-free features; validation metrics per
    group."""
    x = _features_frame(spark, sf_dir)
    pipe = ML.feature_pipeline(NUMERIC, BINARY, "units", ML.random_forest("units"), scale=False)
    _, out = ML.fit_score(pipe, x.where(F.col("split") == "train"),
                          x.where(F.col("split") == "validation"))
    return ev.error_metrics(out.withColumnRenamed("units", "actual"), "actual", "pred", by=["grp"],
                            digits=3)


query("m14_random_forest")(random_forest)


def boosted_submission(spark, sf_dir):
    """M15 + M17 + S9 + S14: boosted trees with a validation indicator for
    early stopping, then batch scoring of the test period: packed ids are
    parsed back to (day, group), enriched with the same feature code,
    scored, clipped at 0, keyed by id."""
    x = _features_frame(spark, sf_dir)
    fit_rows = x.where(F.col("split").isin("train", "validation")).withColumn(
        "is_val", F.col("split") == "validation")
    pipe = ML.feature_pipeline(NUMERIC, BINARY, "units", ML.boosted("units", "is_val"),
                               scale=False)
    model = pipe.fit(fit_rows)
    ids = x.where(F.col("split") == "test").select(P.packed_id(F.col("day"), F.col("grp")).alias("id"))
    keys = ids.select("id", P.id_day(F.col("id")).alias("day"), P.id_group(F.col("id")).alias("grp"))
    rows = keys.join(x, ["day", "grp"], "left")
    out = model.transform(rows).withColumn("pred", NU.clip_min("pred"))
    return out.select("id", "day", "grp", rnd("pred", 3).alias("pred"))


query("m15_boosted_submission")(boosted_submission)


def harmonic_variant(spark, sf_dir):
    """M10 (two-sided) + M12: the four largest amplitudes of the whole spectrum,
    so both members of a mirror pair can be picked, put together without the
    mean and without the 1/n factor, time index restarting at 0; MAE per
    group.  The pair's members have equal cosines, so a pair counts twice."""
    panel, train, spec = _spectrum(spark, sf_dir)
    top = HM.dominant(spec.withColumn("amp", F.round("amp", 6)), 4, one_sided=False)
    valid = panel.where(F.col("day").between(VALID_START, VALID_END))
    rows = HM.continue_index(train, valid, restart=True)
    pred = HM.reconstruct(rows, spec, top, with_mean=False, scale=False)
    return ev.error_metrics(pred.withColumnRenamed("units", "actual"), "actual", "pred",
                            by=["grp"], digits=1)


query("m12_harmonic_variant", f"""
WITH {S.PANEL}, {DFT},
two AS (SELECT grp, k, n, re, im FROM dft WHERE k > 0
        UNION ALL SELECT grp, n - k, n, re, -im FROM dft WHERE k > 0 AND 2 * k < n),
pick AS (SELECT *, round(sqrt(re * re + im * im), 6) AS a6, atan2(im, re) AS phase,
                CASE WHEN 2 * k < n THEN CAST(k AS DOUBLE) / n ELSE CAST(k - n AS DOUBLE) / n END AS freq FROM two
         QUALIFY row_number() OVER (PARTITION BY grp ORDER BY round(sqrt(re * re + im * im), 6) DESC, k DESC) <= 4),
p AS (SELECT v.grp, v.day, v.units AS actual, SUM(2 * pick.a6 * cos(2 * pi() * pick.freq * v.t0 + pick.phase)) AS pred
      FROM v JOIN pick ON v.grp = pick.grp GROUP BY v.grp, v.day, v.units)
SELECT grp, {S.metrics(digits=1)} FROM p GROUP BY grp
""")(harmonic_variant)
