"""Forecasters on the full design (M6, M14, M16), importances (R8), subset
search over it (R5) and a stored model (S15)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import nulls as NU
from ..functions import weather as WX
from ..functions.numeric import rnd
from ..operators import calendar as C
from ..operators import enrich as J
from ..operators import evaluate as EV
from ..operators import harmonics as HM
from ..operators import least_squares as LS
from ..operators import linear as LN
from ..operators import mlmodels as ML
from ..session import materialize, shared_path
from ..sizing import checked_broadcast
from ..sources import panel as P
from . import common as Q
from . import sqlparts as S
from .calendars import _WINDOWS_SQL, _order_windows
from .fits import DUMMIES_SQL, FRAME_SQL, GROUPS, WEEKDAYS, dummies, ols_ctes, predicted
from .forecasting import BINARY, NUMERIC, _features_frame
from .profiling import BASE
from .registry import ORACLE, query

STATES = {s: f"depth_{s.split(' ')[0].lower()}" for s in sorted(P.REGION_NAMES)}
QUINTILES = ["very_cold", "cold", "mild", "warm", "hot"]      # the first is the base
WEATHER = [f"temp_{q}" for q in QUINTILES[1:]] + ["good_weather"]
FULL = NUMERIC + WEATHER + ["holiday", "festival", "summer", "bridge", "payday"] + list(STATES.values()) + WEEKDAYS + GROUPS


def full_frame(spark, sf_dir) -> DataFrame:
    """The full pipeline's design (M18): measures with means for nulls, quintile
    of the temperature, good weather, holiday, bridge day, festival, payday
    window, state activity, weekday and group.

    Fitted constants come from the train days.  State columns hold how many order
    windows of a state are open on the day; a 0/1 flag would be constant wherever
    orders are many.
    """
    panel = P.panel_table(spark, sf_dir, last=P.VALID_END)
    daily = P.daily_table(spark, sf_dir)
    out = J.left_enrich(panel, [(daily.select("day", "temp", "wind", "cloud"), ["day"])])
    out = Q.with_day_flags(out, Q.day_flags(panel))
    out = out.withColumn("bridge", C.bridge_day_loose(out).cast("int"))
    train = out.where(F.col("day") <= P.TRAIN_END)
    known = daily.where(F.col("day") <= P.TRAIN_END)
    quintile = WX.quantile_category("temp", WX.quantile_edges(known, "temp"))
    mean = known.agg(F.avg("temp").alias("t"), F.avg("cloud").alias("c"))
    good = (F.col("temp") >= mean.select("t").scalar()) & (F.col("cloud") <= mean.select("c").scalar())
    out = out.select("*", *[F.coalesce((quintile == q).cast("int"), F.lit(0)).alias(f"temp_{q}") for q in QUINTILES[1:]],
                     F.coalesce(good.cast("int"), F.lit(0)).alias("good_weather"))
    out = NU.mean_impute(out, NUMERIC, fit_on=train)
    lo, hi = P.panel_bounds(spark, sf_dir)
    depth = C.dense_coverage(_order_windows(spark, sf_dir), "state", lo, hi)
    wide = depth.groupBy("day").pivot("state", list(STATES)).agg(F.first("depth"))
    wide = materialize(wide.select("day", *[F.coalesce(F.col(f"`{s}`"), F.lit(0)).alias(c) for s, c in STATES.items()]))
    return materialize(out.join(checked_broadcast(wide), "day", "left").select(
        "day", "grp", "units", *NUMERIC, *WEATHER, F.col("is_holiday").cast("int").alias("holiday"),
        F.col("is_festival").cast("int").alias("festival"), F.month("day").isin(6, 7, 8).cast("int").alias("summer"), "bridge",
        C.payday_window(F.col("day")).cast("int").alias("payday"), *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in STATES.values()],
        *dummies(), P.split_label(F.col("day")).alias("split")))


def full_ols(spark, sf_dir):
    """M6 + F43 + V10: least squares on the full design by merged triangles,
    fitted on train; metrics and adjusted R^2 per split.  Columns that the train
    days make dependent (with many orders a day the eighths of urgent ones are
    the same on nearly all days) get the least-norm fit."""
    x = full_frame(spark, sf_dir)
    fit = LS.fit_triangular(x.where(F.col("split") == "train"), FULL, "units", least_norm=True)
    s = x.select("split", F.col("units").alias("actual"), LN.linear_predict(fit["coef"], fit["intercept"]).alias("pred"))
    m = EV.error_metrics(s, "actual", "pred", by=["split"], digits=4)
    return m.withColumn("adj_r2", rnd(EV.adjusted_r2(F.col("r2"), F.col("n"), F.lit(len(FULL))), 4))


def _full_sql() -> str:
    q = {"cold": ("1", "2"), "mild": ("2", "3"), "warm": ("3", "4")}
    cats = [f"CASE WHEN temp > qe.e[{a}] AND temp <= qe.e[{b}] THEN 1 ELSE 0 END AS temp_{n}" for n, (a, b) in q.items()]
    cats.append("CASE WHEN temp > qe.e[4] THEN 1 ELSE 0 END AS temp_hot")
    imputed = ", ".join(f"COALESCE({c}, (SELECT AVG({c}) FROM enriched WHERE {S.TRAIN})) AS {c}" for c in NUMERIC)
    depth = ", ".join(f"(SELECT COUNT(*) FROM windows w WHERE w.state = '{s}' AND d.day BETWEEN w.start AND w.\"end\") AS {c}"
                      for s, c in STATES.items())
    return f"""{BASE},
{Q.SPINE},
{_WINDOWS_SQL.partition('state_days AS')[0].rstrip().rstrip(',')},
depths AS (SELECT d.day, {depth} FROM (SELECT DISTINCT day FROM panel) d),
qe AS (SELECT quantile_cont(temp, [0.2, 0.4, 0.6, 0.8]) AS e, AVG(temp) AS t, AVG(cloud) AS c FROM daily WHERE {S.TRAIN}),
x AS (SELECT e.day, grp, units, {S.SPLIT_CASE.replace('day', 'e.day')} AS split, {imputed}, {', '.join(cats)},
  CASE WHEN temp >= qe.t AND cloud <= qe.c THEN 1 ELSE 0 END AS good_weather,
  CAST(is_holiday AS INTEGER) AS holiday, CAST(is_festival AS INTEGER) AS festival, CAST(month(e.day) IN (6, 7, 8) AS INTEGER) AS summer,
  CAST(isodow(e.day) IN (1, 5) AND (CAST(e.day - INTERVAL 1 DAY AS DATE) IN (SELECT day FROM holidays)
       OR CAST(e.day + INTERVAL 1 DAY AS DATE) IN (SELECT day FROM holidays)) AS INTEGER) AS bridge,
  CAST(day(e.day) >= 25 OR day(e.day) <= 3 AS INTEGER) AS payday, {', '.join(STATES.values())},
  {DUMMIES_SQL.replace('(day)', '(e.day)')}
  FROM enriched e CROSS JOIN qe JOIN depths ON depths.day = e.day WHERE e.day <= DATE '{P.VALID_END}'),
tr AS (SELECT * FROM x WHERE split = 'train')"""


query("m06_full_ols", f"""{_full_sql()},
{ols_ctes('tr', 'units', FULL)},
p AS (SELECT split, units AS actual, {predicted(FULL)} AS pred FROM x CROSS JOIN fit),
m AS (SELECT split, {S.metrics(digits=4)} FROM p GROUP BY split)
SELECT *, ROUND(1.0 - (1.0 - r2) * (n - 1) / (n - {len(FULL)} - 1), 4) AS adj_r2 FROM m
""")(full_ols)

SHARED = NUMERIC + ["holiday", "festival", "summer"]


def shared_heads(spark, sf_dir):
    """Measures and seasons with slopes that all groups share, an intercept
    and weekday slopes of every group's own, in one joint fit; validation
    metrics per group."""
    x = _features_frame(spark, sf_dir)
    coef, heads = LS.fit_shared_and_heads(x.where(F.col("split") == "train"), SHARED, WEEKDAYS, "units", "grp", least_norm=True)
    rows = x.where(F.col("split") == "validation").join(F.broadcast(heads.drop("n")), "grp")      # one row a group
    pred = LN.linear_predict(coef, 0.0) + F.col("b0")
    for c in WEEKDAYS:
        pred = pred + F.col(c) * F.col(f"b_{c}")
    return EV.error_metrics(rows.select("grp", F.col("units").alias("actual"), pred.alias("pred")), "actual", "pred", by=["grp"], digits=4)


# The heads are the cells of group and weekday, so the joint fit is that of the
# rows less their cell's means.
_CELL = "PARTITION BY grp, isodow(day)"
query("m16_shared_heads", f"""{BASE},
{FRAME_SQL},
c AS (SELECT grp, isodow(day) AS dow, units - AVG(units) OVER ({_CELL}) AS units,
             {', '.join(f'{f} - AVG({f}) OVER ({_CELL}) AS {f}' for f in SHARED)} FROM tr),
{ols_ctes('c', 'units', SHARED)},
cells AS (SELECT grp, isodow(day) AS dow, AVG(units) AS u, {', '.join(f'AVG({f}) AS m_{f}' for f in SHARED)} FROM tr GROUP BY ALL),
p AS (SELECT x.grp, x.units AS actual, u{''.join(f' + b{i} * ({f} - m_{f})' for i, f in enumerate(SHARED, 1))} AS pred
      FROM x JOIN cells ON cells.grp = x.grp AND cells.dow = isodow(x.day) CROSS JOIN fit WHERE split = 'validation')
SELECT grp, {S.metrics(digits=4)} FROM p GROUP BY grp
""")(shared_heads)


def full_subsets(spark, sf_dir):
    """R5 on the full design: the ten best subsets of all its columns by
    adjusted R^2, by branch and bound."""
    x = full_frame(spark, sf_dir).where(F.col("split") == "train")
    out = LS.best_subsets(x, FULL, "units")
    return out.select("rank", "size", "features", rnd("r2", 6).alias("r2"), rnd("adj_r2", 6).alias("adj_r2"))


query("r05b_best_subsets_full")(full_subsets)

HARMONICS = [f"harm_{r}_{fn}" for r in range(1, 6) for fn in ("cos", "sin")]


def forest_frame(spark, sf_dir) -> DataFrame:
    """Calendar, measures and each group's five harmonics (fitted on train, the
    time index going on after it), for train and validation rows."""
    x = _features_frame(spark, sf_dir)
    train = x.where(F.col("split") == "train").select("day", "grp", "units")
    valid = x.where(F.col("split") == "validation").select("day", "grp", "units")
    spec = materialize(HM.spectrum(train, value="units"))
    rows = train.withColumn("t", HM.time_index("grp", "day")).unionByName(HM.continue_index(train, valid))
    waves = HM.harmonic_features(rows, spec).select("day", "grp", *HARMONICS)
    return materialize(x.where(F.col("split") != "test").join(checked_broadcast(waves), ["day", "grp"]))


def forest_importance(spark, sf_dir):
    """M14 + R8: random forest on calendar, measures and harmonics; per feature
    its impurity importance, and the validation error when its values are
    shuffled among the rows, against the error as it is."""
    x = forest_frame(spark, sf_dir)
    names = NUMERIC + BINARY + HARMONICS
    pipe = ML.feature_pipeline(NUMERIC, BINARY + HARMONICS, "units", ML.random_forest("units", trees=60), scale=False)
    model = pipe.fit(x.where(F.col("split") == "train"))
    losses = ML.permutation_losses(model, x.where(F.col("split") == "validation"), names, "units", ["day", "grp"])
    gains = model.stages[-1].featureImportances.toArray().tolist()
    table = spark.createDataFrame(list(zip(names, map(float, gains))), "feature string, importance double")
    return table.join(losses, "feature").select("feature", rnd("importance", 6).alias("importance"),
                                                rnd("mse", 3).alias("mse"), rnd("shuffled_mse", 3).alias("shuffled_mse"))


query("r08_forest_importance")(forest_importance)


def stored_model(spark, sf_dir):
    """The pooled pipeline (scaler, layout, regressor) fitted on train,
    stored in the shared file system with its input's schema and fold, loaded
    again, checked against both and scored as m03 is."""
    x = _features_frame(spark, sf_dir)
    train = x.where(F.col("split") == "train")
    path = shared_path(spark, "models", uuid.uuid4().hex)
    ML.save_checked(ML.feature_pipeline(NUMERIC, BINARY, "units", ML.ols("units")).fit(train), path, train, NUMERIC + BINARY)
    model = ML.load_checked(path, train, NUMERIC + BINARY)
    out = model.transform(x.where(F.col("split").isin("train", "validation")))
    return EV.error_metrics(out.withColumnRenamed("units", "actual"), "actual", "pred", by=["split", "grp"])


query("s15_stored_model")(stored_model)
ORACLE["s15_stored_model"] = ORACLE["m03_pooled_ols"]
