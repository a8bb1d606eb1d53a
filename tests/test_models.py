"""Least squares, spectrum and interval operators against NumPy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.operators import harmonics as HM
from daybook.operators import impact as IM
from daybook.operators import linear as LN
from daybook.sizing import checked_broadcast


def test_pooled_ols_matches_lstsq(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    y = 2 + x @ np.array([1.5, -0.5, 3.0]) + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(v),) for r, v in zip(x, y)],
                               "a double, b double, c double, y double")
    fit = LN.fit_pooled(df, ["a", "b", "c"], "y")
    beta = np.linalg.lstsq(np.c_[np.ones(200), x], y, rcond=None)[0]
    assert fit["intercept"] == pytest.approx(beta[0], rel=1e-8)
    assert [fit["coef"][k] for k in "abc"] == pytest.approx(beta[1:], rel=1e-8)


def test_rank_deficient_design_gives_same_predictions(spark):
    # all dummy levels plus intercept: predictions must still be the cell means
    rows = [(1.0, 0.0, 4.0), (1.0, 0.0, 6.0), (0.0, 1.0, 1.0), (0.0, 1.0, 3.0)]
    df = spark.createDataFrame(rows, "d1 double, d2 double, y double")
    fit = LN.fit_pooled(df, ["d1", "d2"], "y")
    pred = [r.p for r in df.select(LN.linear_predict(fit["coef"], fit["intercept"]).alias("p")).collect()]
    assert pred == pytest.approx([5.0, 5.0, 2.0, 2.0])


def test_per_group_ols_and_fallback(spark):
    rows = [("a", float(i), 1.0 + 2.0 * i) for i in range(10)] + [("b", 1.0, 7.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    m = {r.g: r for r in LN.fit_per_group(df, ["x"], "y", "g").collect()}
    assert m["a"].b0 == pytest.approx(1.0) and m["a"].b1 == pytest.approx(2.0)
    assert m["b"].fallback and m["b"].b0 == pytest.approx(7.0)


def test_subset_scores_match_direct_fit(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(100, 3))
    y = x[:, 0] * 2 + rng.normal(size=100)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(v),) for r, v in zip(x, y)],
                               "a double, b double, c double, y double")
    g = LN.gram(df, ["a", "b", "c"], "y").first().asDict()
    res = {r.mask: r for r in LN.score_subsets(spark, g, ["a", "b", "c"], LN.all_masks(spark, 3)).collect()}
    assert len(res) == 7
    direct = LN.fit_pooled(df, ["a"], "y")
    assert res[1].adj_r2 == pytest.approx(direct["adj_r2"], rel=1e-9)


def test_spectrum_matches_numpy_and_rebuilds_series(spark):
    y = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(y)], "grp int, day int, value double")
    spec = HM.spectrum(df)
    s = {r.k: r for r in spec.collect()}
    x = np.fft.fft(y)
    assert [s[k].amp for k in range(7)] == pytest.approx(np.abs(x))
    # all frequencies (mirror pairs included, no doubling) rebuild the series
    rows = df.select("grp", F.col("day").cast("long").alias("t"), "value")
    top = spec.where("k > 0").withColumn("rank", F.col("k"))
    rec = HM.reconstruct(rows, spec, top, scale=True).withColumn("pred", F.col("pred"))
    # reconstruct doubles each term (one-sided convention): halve the sum of harmonics
    got = {r.t: (r.pred - np.mean(y)) / 2 + np.mean(y) for r in rec.collect()}
    assert [got[t] for t in range(7)] == pytest.approx(y)


def test_dominant_one_sided(spark):
    y = [math.cos(2 * math.pi * 2 * t / 16) * 10 + 1 for t in range(16)]
    df = spark.createDataFrame([(1, t, v) for t, v in enumerate(y)], "grp int, day int, value double")
    top = HM.dominant(HM.spectrum(df), 1).collect()
    assert top[0].k == 2


def test_t_quantiles(spark):
    df = spark.createDataFrame([(1,), (10,), (30,), (120,)], "df int")
    got = [r[0] for r in df.select(IM.t975(F.col("df"))).collect()]
    assert got[0] == pytest.approx(12.706, abs=1e-3)
    assert got[1] == pytest.approx(2.228, abs=1e-3)
    assert got[2] == pytest.approx(2.042, abs=1e-3)
    assert got[3] == pytest.approx(1.980, abs=1e-3)


def test_checked_broadcast_respects_bound(spark):
    small = spark.range(10)
    big = spark.range(100)
    assert "broadcast" in checked_broadcast(small, 50)._jdf.queryExecution().logical().toString().lower()
    assert checked_broadcast(big, 50) is big
