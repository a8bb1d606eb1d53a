"""Evaluation (V1-V12) and source / sink round-trip queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.numeric import rnd
from ..operators import evaluate as EV
from ..session import shared_path
from ..sources import files as FI
from ..sources import panel as P
from ..sources.tables import read_table
from . import sqlparts as S
from .profiling import SCORED, VALUE_SUMMARY_SQL, scored
from .registry import query


def split_comparison(spark, sf_dir):
    """V3: train vs validation MAE / RMSE per group, side by side."""
    return EV.split_comparison(scored(spark, sf_dir))


query("v03_split_comparison", f"""WITH {S.PANEL},
{SCORED}
SELECT grp, """ + ", ".join(
    f"ROUND(AVG(CASE WHEN split = '{s}' THEN ABS(actual - pred) END), 6) AS mae_{s}, "
    f"ROUND(SQRT(AVG(CASE WHEN split = '{s}' THEN (actual - pred) * (actual - pred) END)), 6) AS rmse_{s}, "
    f"COUNT(CASE WHEN split = '{s}' THEN 1 END) AS n_{s}" for s in ("train", "validation")) +
    " FROM scored GROUP BY grp")(split_comparison)


def loss_variants(spark, sf_dir):
    """V5 + V6: epsilon MAPE and the asymmetric Huber cost per group on the
    validation year."""
    s = scored(spark, sf_dir).where(F.col("split") == "validation")
    return s.groupBy("grp").agg(rnd(EV.mape_eps(), 6).alias("mape_eps"),
                                rnd(EV.asymmetric_huber(), 6).alias("asym_huber"))


query("v05_loss_variants", f"""WITH {S.PANEL},
{SCORED}
SELECT grp, ROUND(AVG(ABS((actual - pred) / (actual + 1e-7))) * 100, 6) AS mape_eps,
  ROUND(AVG(CASE WHEN actual - pred > 0 THEN 2.5 ELSE 0.7 END *
            CASE WHEN ABS(actual - pred) <= 1 THEN 0.5 * (actual - pred) * (actual - pred)
                 ELSE ABS(actual - pred) - 0.5 END) - 0.2 * AVG(pred), 6) AS asym_huber
FROM scored WHERE split = 'validation' GROUP BY grp
""")(loss_variants)


def mean_group_mae(spark, sf_dir):
    """V8: mean of the per-group MAE on validation."""
    return EV.mean_group_mae(scored(spark, sf_dir).where(F.col("split") == "validation"))


query("v08_mean_group_mae", f"""WITH {S.PANEL},
{SCORED},
g AS (SELECT grp, AVG(ABS(actual - pred)) AS mae FROM scored WHERE split = 'validation' GROUP BY grp)
SELECT ROUND(AVG(mae), 6) AS mean_group_mae, COUNT(*) AS n_groups FROM g
""")(mean_group_mae)


def error_histogram(spark, sf_dir):
    """V9: 20-bin histogram of prediction minus actual on validation."""
    s = scored(spark, sf_dir).where(F.col("split") == "validation").withColumn("pred", rnd("pred", 6))
    h = EV.error_histogram(s)
    return h.select("bin", rnd("lo", 4).alias("lo"), rnd("hi", 4).alias("hi"), "count")


query("v09_error_histogram", f"""WITH {S.PANEL},
{SCORED},
e AS (SELECT ROUND(pred, 6) - actual AS err FROM scored WHERE split = 'validation'),
b AS (SELECT min(err) AS lo, max(err) AS hi, (max(err) - min(err)) / 20 AS w FROM e),
h AS (SELECT CAST(CASE WHEN w = 0 THEN 1 ELSE least(floor((err - lo) / w) + 1, 20) END AS INTEGER) AS bin,
             COUNT(*) AS count FROM e, b WHERE err IS NOT NULL GROUP BY 1)
SELECT bin, ROUND(lo + (bin - 1) * w, 4) AS lo, ROUND(lo + bin * w, 4) AS hi, count FROM h, b
""")(error_histogram)


def aligned_totals(spark, sf_dir):
    """V11 + F22: validation-year and test-year daily totals aligned by the
    day offset from each period's start."""
    panel = P.panel_table(spark, sf_dir, first=P.VALID_START)
    a = panel.where(F.col("day").between(P.VALID_START, P.VALID_END))
    b = panel.where(F.col("day") >= P.TEST_START)
    return EV.aligned_daily_totals(a, b, value="units", label_a="validation", label_b="test")


query("v11_aligned_totals", f"""WITH {S.PANEL},
a AS (SELECT day, SUM(units) AS total_validation FROM panel WHERE {S.VALID} GROUP BY day),
b AS (SELECT day, SUM(units) AS total_test FROM panel WHERE {S.TEST} GROUP BY day),
a2 AS (SELECT CAST(date_diff('day', (SELECT min(day) FROM a), day) AS INTEGER) AS "offset", total_validation FROM a),
b2 AS (SELECT CAST(date_diff('day', (SELECT min(day) FROM b), day) AS INTEGER) AS "offset", total_test FROM b)
SELECT COALESCE(a2."offset", b2."offset") AS "offset", total_validation, total_test
FROM a2 FULL OUTER JOIN b2 ON a2."offset" = b2."offset"
""")(aligned_totals)


def prediction_series(spark, sf_dir):
    """Validation actuals, validation predictions of the weekday-mean
    forecaster and test-period totals per day since the validation start."""
    valid = scored(spark, sf_dir).where(F.col("split") == "validation")
    later = P.panel_table(spark, sf_dir, first=P.TEST_START)
    out = EV.prediction_series(valid, later, value="units")
    return out.select("offset", "total_actual", rnd("total_pred", 6).alias("total_pred"), "total_later")


query("v11b_prediction_series", f"""WITH {S.PANEL},
{SCORED},
v AS (SELECT day, actual, pred FROM scored WHERE split = 'validation'),
u AS (SELECT day, CAST(actual AS DOUBLE) AS a, pred AS p, CAST(NULL AS DOUBLE) AS l FROM v
      UNION ALL SELECT day, NULL, NULL, CAST(units AS DOUBLE) FROM panel WHERE {S.TEST})
SELECT CAST(date_diff('day', (SELECT min(day) FROM v), day) AS INTEGER) AS "offset",
  SUM(a) AS total_actual, ROUND(SUM(p), 6) AS total_pred, SUM(l) AS total_later
FROM u GROUP BY 1
""")(prediction_series)


def prediction_summary(spark, sf_dir):
    """Prediction distribution per split."""
    s = scored(spark, sf_dir).withColumn("pred", rnd("pred", 6))
    return EV.prediction_summary(s, "pred", by=["split"])


query("v12_prediction_summary", f"WITH {S.PANEL},\n{SCORED},\nsr AS (SELECT split, day, ROUND(pred, 6) AS pred FROM scored)\n"
      + VALUE_SUMMARY_SQL.format(by="split, ", v="pred", src="sr", grp="GROUP BY split"))(
    prediction_summary)


# ---------------------------------------------------------------- sources / sinks

def packed_ids(spark, sf_dir):
    """Test-period (day, group) keys packed to ``yyMMdd`` + group digit
    and parsed back."""
    panel = P.panel_table(spark, sf_dir, first=P.TEST_START)
    ids = panel.select(P.packed_id(F.col("day"), F.col("grp")).alias("id"))
    return ids.select("id", P.id_day(F.col("id")).alias("day"), P.id_group(F.col("id")).alias("grp"))


query("s09_packed_ids", f"""WITH {S.PANEL},
ids AS (SELECT CAST(strftime(day, '%y%m%d') AS BIGINT) * 10 + grp AS id FROM panel WHERE {S.TEST}),
s AS (SELECT id, lpad(CAST(id AS VARCHAR), 7, '0') AS t FROM ids)
SELECT id, make_date(CASE WHEN CAST(substr(t, 1, 2) AS INTEGER) >= 69 THEN 1900 ELSE 2000 END
                     + CAST(substr(t, 1, 2) AS INTEGER), CAST(substr(t, 3, 2) AS INTEGER),
                     CAST(substr(t, 5, 2) AS INTEGER)) AS day,
       CAST(id % 10 AS INTEGER) AS grp FROM s
""")(packed_ids)


def coerce_numeric(spark, sf_dir):
    """Coercing casts of the priority text (whole text -> null, leading
    digit -> number)."""
    o = read_table(spark, sf_dir, "orders", ["o_orderpriority"])
    return o.groupBy(FI.coerce_double(F.col("o_orderpriority")).alias("as_number"),
                     P.priority_code(F.col("o_orderpriority")).alias("code")).agg(
        F.count(F.lit(1)).alias("n"))


query("s10_coerce_numeric", """
SELECT TRY_CAST(o_orderpriority AS DOUBLE) AS as_number, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS code,
       COUNT(*) AS n FROM orders GROUP BY 1, 2
""")(coerce_numeric)

DAILY_SCHEMA = "day DATE, n_orders BIGINT, temp DOUBLE, wind DOUBLE, cloud INT, code INT"


def csv_roundtrip(spark, sf_dir):
    """S1 + S2 + S12: the daily measures written as ';'-separated CSV to the
    shared folder and read back with an explicit schema."""
    path = shared_path(spark, "roundtrip", uuid.uuid4().hex, "daily_csv")
    FI.write_table(P.daily_measures(spark, sf_dir), path, "csv", sep=";")
    return FI.read_csv(spark, path, DAILY_SCHEMA, sep=";")


query("s12_csv_roundtrip", f"WITH {S.DAILY}\nSELECT * FROM daily")(csv_roundtrip)


def keyed_files(spark, sf_dir):
    """S5 + S12: the panel written as one CSV folder per group, read back
    with one glob and the group taken from each file's path."""
    path = shared_path(spark, "roundtrip", uuid.uuid4().hex, "panel_by_group")
    panel = P.panel_table(spark, sf_dir)
    FI.write_table(panel.select("day", "units", F.col("grp").alias("g")), path, "csv",
                   partition_by=["g"])
    back = FI.read_keyed_files(spark, f"{path}/g=*/*.csv", "day DATE, units DOUBLE",
                               r"/g=(\d+)/", "grp")
    return back.select("day", F.col("grp").cast("int").alias("grp"), "units")


query("s05_keyed_files", f"WITH {S.PANEL}\nSELECT day, grp, units FROM panel")(keyed_files)


def json_report(spark, sf_dir):
    """S13 + S16: per-group metrics of the weekday-mean forecaster stacked
    as (section, key, metric, value) rows, written as JSON, read back."""
    s = scored(spark, sf_dir).where(F.col("split") == "validation")
    m = EV.error_metrics(s, by=["grp"])
    rep = FI.stats_report(m, "weekday_mean_validation", ["grp"])
    path = shared_path(spark, "roundtrip", uuid.uuid4().hex, "report_json")
    FI.write_table(rep, path, "json")
    return spark.read.schema("section STRING, key STRING, metric STRING, value DOUBLE").json(path)


query("s13_json_report", f"""WITH {S.PANEL},
{SCORED},
m AS (SELECT grp, {S.metrics()} FROM scored WHERE split = 'validation' GROUP BY grp)
SELECT 'weekday_mean_validation' AS section, CAST(grp AS VARCHAR) AS key, metric, value FROM (
  """ + "\n  UNION ALL ".join(f"SELECT grp, '{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM m"
                            for c in ("n", "mae", "rmse", "r2", "mape", "mape_n")) + ") u")(json_report)
