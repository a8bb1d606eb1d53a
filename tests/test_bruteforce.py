"""Queries without a SQL twin, checked against NumPy brute force on the
smallest scale factor."""

import numpy as np
import pytest

import __spark_entry__ as E
from daybook.plans import forecasting as FQ
from daybook.sources import panel as P

from .conftest import SF_SMALL


def test_harmonic_forecast_matches_numpy(spark):
    got = {r.grp: r.mae for r in E.queries()["m11_harmonic_forecast"](spark, SF_SMALL).collect()}
    pdf = P.sales_panel(spark, SF_SMALL).toPandas().sort_values(["grp", "day"])
    pdf["day"] = pdf["day"].astype("datetime64[ns]")
    for g, d in pdf.groupby("grp"):
        tr = d[d.day <= P.TRAIN_END]["units"].to_numpy(float)
        va = d[(d.day >= P.VALID_START) & (d.day <= P.VALID_END)]["units"].to_numpy(float)
        if len(va) == 0:
            continue
        n = len(tr)
        x = np.fft.fft(tr)
        f = np.fft.fftfreq(n)
        ks = sorted(range(1, n // 2 + 1), key=lambda k: (-abs(x[k]), -k))[:4]
        t = n + np.arange(len(va))
        pred = np.full(len(va), abs(x[0]) / n)
        for k in ks:
            pred += 2 * abs(x[k]) / n * np.cos(2 * np.pi * f[k] * t + np.angle(x[k]))
        pred = np.maximum(pred, 0)
        assert got[g] == pytest.approx(np.mean(np.abs(va - pred)), abs=2e-3)


def test_per_group_ols_matches_numpy(spark):
    got = {r.grp: r.mae for r in E.queries()["m07_per_group_ols"](spark, SF_SMALL).collect()}
    x = FQ._features_frame(spark, SF_SMALL).toPandas()
    feats = FQ.NUMERIC + ["holiday", "festival", "summer"] + [f"wd{d}" for d in range(1, 7)]
    for g, d in x.groupby("grp"):
        tr, va = d[d.split == "train"], d[d.split == "validation"]
        if len(va) == 0:
            continue
        a = np.c_[np.ones(len(tr)), tr[feats].to_numpy(float)]
        beta = np.linalg.lstsq(a, tr["units"].to_numpy(float), rcond=None)[0]
        pred = np.c_[np.ones(len(va)), va[feats].to_numpy(float)] @ beta
        assert got[g] == pytest.approx(np.mean(np.abs(va["units"].to_numpy(float) - pred)), abs=1e-4)
