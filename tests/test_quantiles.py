"""Distributed selection against ``percentile`` and numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from daybook.functions import nulls as NU
from daybook.functions import scale as SC
from daybook.functions import weather as WX
from daybook.operators import profile as PR
from daybook.operators import quantiles as QU

from .conftest import SF_SMALL

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def selected(df, cols, by, bound):
    rows = QU.exact_quantiles(df, cols, PROBS, by, bound).collect()
    out = {(*[r[b] for b in by], r["column"], r["p"]): r["value"] for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("bound", [1, 40, 10_000])
def test_equal_to_percentile(spark, bound):
    draw = np.random.default_rng(5)
    n = 6000
    g = np.where(draw.random(n) < 0.6, "hot", draw.choice(["a", "b"], n)).astype(object)
    g[:50] = None
    x = np.round(draw.lognormal(3, 2, n), 3)
    x[draw.random(n) < 0.35] = 7.0  # a third of the rows share one value
    frame = pd.DataFrame({"g": g, "x": x, "p": draw.integers(-3, 3, n).astype(float), "__v": draw.normal(size=n)})
    df = spark.createDataFrame(frame, "g string, x double, p double, __v double").repartition(6)
    df = df.withColumn("x", F.when(F.col("__v") > -1.5, F.col("x")))
    got = selected(df, ["x", "p", "__v"], ["g"], bound)
    want = df.groupBy("g").agg(*[F.percentile(c, F.array(*[F.lit(p) for p in PROBS])).alias(c) for c in ("x", "p", "__v")])
    rows = want.collect()
    assert len(got) == len(rows) * 3 * len(PROBS)
    for r in rows:
        for c in ("x", "p", "__v"):
            for p, v in zip(PROBS, r[c]):
                assert got[(r["g"], c, p)] == v, (r["g"], c, p)


def test_many_ties_large_ranks(spark):
    df = spark.range(0, 120_000, 1, 8).select((F.col("id") % 30_011).cast("double").alias("x"))
    values = np.arange(120_000) % 30_011
    got = selected(df, ["x"], [], 500)
    for p in PROBS:
        assert got[("x", p)] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_empty_null_and_nan(spark):
    schema = "g int, x double"
    assert QU.exact_quantiles(spark.createDataFrame([], schema), ["x"], [0.5], ["g"]).collect() == []
    assert QU.exact_quantiles(spark.createDataFrame([], schema), ["x"], [0.5]).collect() == []
    df = spark.createDataFrame([(1, None), (1, None), (2, 4.0), (2, None), (3, -0.0), (3, 0.0), (3, float("nan"))], schema)
    got = {(r["g"], r["p"]): r["value"] for r in QU.exact_quantiles(df, ["x"], [0.5, 1.0], ["g"], bound=1).collect()}
    assert got[(1, 0.5)] is None and got[(2, 0.5)] == got[(2, 1.0)] == 4.0
    assert got[(3, 0.5)] == 0.0 and np.isnan(got[(3, 1.0)])


def test_box_stats_by_selection(spark):
    draw = np.random.default_rng(9)
    df = spark.createDataFrame(pd.DataFrame({"k": draw.integers(0, 3, 900), "v": draw.exponential(10, 900)}))
    for keys in (["k"], []):
        rows = [sorted(PR.box_stats(df, keys, "v", select=s).collect(), key=str) for s in (False, True)]
        assert rows[0] == rows[1]


def test_fits_by_selection(spark):
    draw = np.random.default_rng(11)
    df = spark.createDataFrame(pd.DataFrame({"x": draw.normal(5, 3, 800)})).withColumn("y", F.when(F.col("x") > 3, F.col("x")))
    by_selection = {s: df.agg(*[a.alias(f"{c}{i}") for c, ab in SC.fit_robust(df, ["x", "y"], select=s).items()
                                for i, a in enumerate(ab)],
                              ).first() for s in (False, True)}
    assert by_selection[True] == pytest.approx(by_selection[False], abs=1e-12)
    filled = [NU.median_impute(df, ["y"], select=s).agg(F.sum("y")).first()[0] for s in (False, True)]
    assert filled[0] == pytest.approx(filled[1], abs=1e-9)
    edges = [df.select(WX.quantile_edges(df, "x", select=s).alias("e")).first()["e"] for s in (False, True)]
    assert edges[0] == pytest.approx(edges[1], abs=1e-12)


def test_fact_scaling_selects_once_for_all_its_steps(spark, monkeypatch):
    from daybook.plans import features as FE
    calls = []
    plain = QU.exact_quantiles
    monkeypatch.setattr(QU, "exact_quantiles", lambda *a, **k: calls.append(a[1]) or plain(*a, **k))
    assert FE.fact_scaling(spark, SF_SMALL).count() > 0
    assert calls == [["price", "tax"]]


def test_later_rounds_read_the_open_intervals_only(spark, monkeypatch):
    sizes = []
    plain = QU._cut
    monkeypatch.setattr(QU, "_cut", lambda values, *a: sizes.append(values.count()) or plain(values, *a))
    x = np.random.default_rng(1).normal(size=60_000)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    got = {r["p"]: r["value"] for r in QU.exact_quantiles(df, ["x"], [0.5], bound=5).collect()}
    assert got == {p: pytest.approx(np.quantile(x, p), rel=1e-12) for p in (0.5,)}
    assert sizes[0] == len(x) and len(sizes) > 1 and all(n < len(x) / 100 for n in sizes[1:])
