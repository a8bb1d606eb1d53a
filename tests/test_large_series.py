"""Least squares by triangles, subset search, merged ranges, block windows, row
alignment, checked reads and the pruned panel scan."""

import datetime as dt
import itertools
import random
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from daybook.operators import alignment as AL
from daybook.operators import calendar as C
from daybook.operators import least_squares as LS
from daybook.operators import mlmodels as ML
from daybook.operators import segments as SG
from daybook.plans import models as M
from daybook.sources import files as FI
from daybook.sources import panel as P

from .conftest import SF_SMALL

DAY = dt.date(2020, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def design(n=600, k=4, seed=3, shift=0.0):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, k))
    y = 5 + x @ np.arange(1, k + 1) + draw.normal(scale=0.3, size=n)
    return x + shift, y


def frame(spark, x, y, **more):
    return spark.createDataFrame(pd.DataFrame({f"x{i}": x[:, i] for i in range(x.shape[1])} | {"y": y} | more)).repartition(7)


@pytest.mark.parametrize("shift", [0.0, 1e8])
def test_triangular_fit_matches_lstsq(spark, shift):
    x, y = design(shift=shift)
    fit = LS.fit_triangular(frame(spark, x, y), [f"x{i}" for i in range(4)], "y")
    c = x - x.mean(0)
    beta = np.linalg.lstsq(np.c_[np.ones(len(y)), c], y, rcond=None)[0]
    assert list(fit["coef"].values()) == pytest.approx(beta[1:], rel=1e-8)
    assert fit["intercept"] + np.dot(list(fit["coef"].values()), x.mean(0)) == pytest.approx(beta[0], rel=1e-8 if shift == 0 else 1e-6)
    res = y - beta[0] - c @ beta[1:]
    assert fit["r2"] == pytest.approx(1 - res @ res / ((y - y.mean()) @ (y - y.mean())), rel=1e-10) and fit["n"] == 600


def test_triangular_fit_names_dependent_columns(spark):
    x, y = design()
    x[:, 3] = x[:, 0] - 2 * x[:, 1]
    with pytest.raises(LS.RankDeficientDesign, match="x3"):
        LS.fit_triangular(frame(spark, x, y), [f"x{i}" for i in range(4)], "y")
    x[:, 3] = 7.0
    with pytest.raises(LS.RankDeficientDesign, match="x3"):
        LS.fit_triangular(frame(spark, x, y), [f"x{i}" for i in range(4)], "y")


def test_shared_slopes_and_heads_match_the_stacked_design(spark):
    x, y = design(900, 4)
    g = np.arange(900) % 5
    y = y + g * 3.0 + g * x[:, 3]
    coef, heads = LS.fit_shared_and_heads(frame(spark, x, y, g=g), ["x0", "x1", "x2"], ["x3"], "y", "g")
    dummy = (g[:, None] == np.arange(5)).astype(float)
    beta = np.linalg.lstsq(np.c_[x[:, :3], dummy, dummy * x[:, 3:]], y, rcond=None)[0]
    assert [coef[f"x{i}"] for i in range(3)] == pytest.approx(beta[:3], rel=1e-9)
    rows = {r.g: r for r in heads.collect()}
    assert [rows[i].b0 for i in range(5)] == pytest.approx(beta[3:8], rel=1e-9)
    assert [rows[i].b_x3 for i in range(5)] == pytest.approx(beta[8:], rel=1e-9) and rows[0].n == 180


def all_subsets(x, y, k, best):
    n, out = len(y), []
    for size in range(1, k + 1):
        for s in itertools.combinations(range(k), size):
            a = np.c_[np.ones(n), x[:, s]]
            res = y - a @ np.linalg.lstsq(a, y, rcond=None)[0]
            out.append((1 - (res @ res) / ((y - y.mean()) @ (y - y.mean())) * (n - 1) / (n - size - 1), s))
    return sorted(out, reverse=True)[:best]


def test_best_subsets_equal_full_enumeration(spark):
    draw = np.random.default_rng(8)
    x = draw.normal(size=(120, 11))
    x[:, 5] += 0.9 * x[:, 0]
    y = x[:, 0] - x[:, 3] + 0.2 * x[:, 7] + draw.normal(size=120)
    got = LS.best_subsets(frame(spark, x, y), [f"x{i}" for i in range(11)], "y", branches=16).collect()
    expected = all_subsets(x, y, 11, 10)
    assert [r.adj_r2 for r in got] == pytest.approx([a for a, _ in expected], rel=1e-10)
    assert {r.features for r in got} == {",".join(f"x{i}" for i in s) for _, s in expected}
    assert [r["rank"] for r in got] == list(range(1, 11))


def test_merged_ranges_and_coverage(spark):
    draw = random.Random(2)
    rows = [(draw.choice("abc"), s, s + draw.randrange(-2, 9)) for s in (draw.randrange(200) for _ in range(120))]
    rows += [("d", 5, 5), ("d", 6, 8), ("d", 10, 9), ("e", -50, 400), (None, 3, 4), (None, 4, 4)]
    df = spark.createDataFrame([(k, day(s), day(e)) for k, s, e in rows] + [("d", None, day(3)), ("d", day(3), None)],
                               "k string, start date, end date")
    days = {}
    for k, s, e in rows:
        for i in range(s, e + 1):
            days.setdefault(k, {}).setdefault(day(i), 0)
            days[k][day(i)] += 1
    merged = C.merged_ranges(df, "k", "start", "end").collect()
    found = {}
    for r in merged:
        for i in range((r.end - r.start).days + 1):
            d = r.start + dt.timedelta(days=i)
            assert d not in found.setdefault(r.k, set())
            found[r.k].add(d)
    assert found == {k: set(v) for k, v in days.items()}
    assert sorted((r.start, r.end) for r in merged if r.k == "d") == [(day(5), day(8))]
    known = df.where("k is not null")
    depth = {(r.k, r.day): r.depth for r in C.dense_coverage(known, "k", day(0), day(99)).collect()}
    assert len(depth) == 500 and depth == {(k, day(i)): days[k].get(day(i), 0) for k in "abcde" for i in range(100)}
    flags = {(r.k, r.day): r.depth for r in C.dense_coverage(C.merged_ranges(known, "k", "start", "end"), "k", day(0), day(99)).collect()}
    assert flags == {x: min(1, n) for x, n in depth.items()}


@pytest.fixture(scope="module")
def series(spark):
    draw = random.Random(4)
    rows = [(g, day(i), draw.choice([None, None, float(draw.randrange(9))]), draw.choice([None, 1, 2]), float(draw.randrange(50)))
            for g, n in ((1, 300), (2, 5), (3, 1), (None, 40)) for i in range(n)]
    rows += [(4, day(i), None, None, 1.0) for i in range(6)]
    return spark.createDataFrame(rows, "grp int, day date, a double, b int, v double")


@pytest.mark.parametrize("blocks", [1, 5, 40])
def test_block_windows_equal_plain_ones(series, blocks):
    pdf = series.toPandas().sort_values(["grp", "day"])
    by = pdf.groupby("grp", dropna=False)
    expected = pdf.assign(a=by["a"].transform(lambda s: s.ffill().bfill()), b=by["b"].transform(lambda s: s.ffill().bfill()))
    got = SG.with_fill(series, ["a", "b"], "grp", "day", blocks).toPandas().sort_values(["grp", "day"])
    pd.testing.assert_frame_equal(got.reset_index(drop=True), expected.reset_index(drop=True), check_dtype=False)

    rows = SG.with_time_index(series, "grp", "day", blocks=blocks)
    out = SG.with_rolling(rows, "v", "grp", rows=7, block_rows=8).toPandas().sort_values(["grp", "day"]).reset_index(drop=True)
    assert out["t"].tolist() == by.cumcount().tolist() and len(out) == len(pdf)
    assert out["roll"].tolist() == pytest.approx(by["v"].transform(lambda s: s.rolling(7, 1).mean()).tolist())
    prev = by["v"].transform(lambda s: s.shift().rolling(7, 1).mean()).tolist()
    assert out["roll_prev"].tolist() == pytest.approx(prev, nan_ok=True)
    assert out["next"].tolist() == pytest.approx(by["v"].shift(-1).tolist(), nan_ok=True)


def test_block_windows_of_an_empty_table(series):
    assert SG.with_fill(series.limit(0), ["a"], "grp", "day").count() == 0
    assert SG.with_rolling(SG.with_time_index(series.limit(0), "grp", "day"), "v", "grp").count() == 0


def test_alignment_finds_swapped_missing_and_doubled_rows(spark):
    rows = [(day(i), i % 3, float(i % 7)) for i in range(120)]
    schema, cols, month = "day date, grp int, v double", ["day", "grp", "v"], F.trunc("day", "MM")

    def off(other):
        a, b = spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)
        return {(r.part, r.rows_a, r.rows_b) for r in AL.differing_ranges(a, b, cols, month).collect()}

    assert off(list(reversed(rows))) == set()
    swapped = [*rows]
    swapped[40], swapped[41] = (*rows[40][:2], rows[41][2]), (*rows[41][:2], rows[40][2])
    assert off(swapped) == {(dt.date(2020, 2, 1), 29, 29)}
    assert off(rows[:-1]) == {(dt.date(2020, 4, 1), 29, 28)}
    assert off(rows + rows[:1]) == {(dt.date(2020, 1, 1), 31, 32)}
    assert off([r for r in rows if r[0].month != 3]) == {(dt.date(2020, 3, 1), 31, 0)}
    assert off([(d, g, -0.0 if v == 0 else v) for d, g, v in rows]) == set()
    assert off(rows + [(None, None, None)]) == {(None, 0, 1)}


def test_one_bad_line_is_named(spark, tmp_path):
    good = "# Ferien 2015\n## Kiel:\n- Ostern: 01.04.2015 - 17.04.2015\n"
    (tmp_path / "good.md").write_text(good)
    assert FI.read_sections_checked(spark, str(tmp_path / "good.md")).count() == 1
    (tmp_path / "bad.md").write_text(good + "- Sommer: bald\n")
    with pytest.raises(FI.UnparsedSourceError, match="1 lines, among them '- Sommer: bald'"):
        FI.read_sections_checked(spark, str(tmp_path / "bad.md"))


def test_coerced_values_are_counted(spark):
    df = spark.createDataFrame([("1.5", "7", "x"), ("x", "8", "y"), (None, "z", "z"), ("", None, None)], "a string, b string, c string")
    out, lost = FI.read_coerced(df, {"a": "double", "b": "int"})
    assert lost == {"a": 2, "b": 1} and out.columns == ["a", "b", "c"]
    assert {(r.a, r.b, r.c) for r in out.collect()} == {(1.5, 7, "x"), (None, 8, "y"), (None, None, "z"), (None, None, None)}


def test_stored_model_refuses_other_rows_and_columns(spark, tmp_path):
    x, y = design(80, 2)
    df = frame(spark, x, y)
    model = ML.feature_pipeline(["x0"], ["x1"], "y", ML.ols("y")).fit(df)
    ML.save_checked(model, str(tmp_path / "m"), df, ["x0", "x1"])
    again = ML.load_checked(str(tmp_path / "m"), df.repartition(3), ["x0", "x1"])
    key = ["x0", "x1"]
    assert again.transform(df).orderBy(*key).select("pred").collect() == model.transform(df).orderBy(*key).select("pred").collect()
    with pytest.raises(ML.ModelMismatch, match="n, sum, xor"):
        ML.load_checked(str(tmp_path / "m"), df.limit(79), ["x0", "x1"])
    with pytest.raises(ML.ModelMismatch, match="columns"):
        ML.load_checked(str(tmp_path / "m"), df.withColumn("x1", F.col("x1").cast("float")), ["x0", "x1"])


def test_permutation_losses(spark):
    x, y = design(400, 3)
    df = frame(spark, x, y, id=np.arange(400))
    model = ML.feature_pipeline([], ["x0", "x1", "x2"], "y", ML.random_forest("y", trees=20), scale=False).fit(df)
    names = ["x0", "x1", "x2"]
    gains = model.stages[-1].featureImportances.toArray()
    assert gains.sum() == pytest.approx(1)
    pred = model.transform(df).agg(F.min("pred"), F.max("pred")).first()
    assert y.min() <= pred[0] and pred[1] <= y.max()
    loss = {r.feature: r for r in ML.permutation_losses(model, df, names, "y", ["id"]).collect()}
    assert set(loss) == set(names) and len({r.mse for r in loss.values()}) == 1
    assert loss["x2"].shuffled_mse > loss["x1"].shuffled_mse > loss["x0"].shuffled_mse > loss["x0"].mse
    one = df.withColumn("x1", F.lit(2.0))
    same = {r.feature: r for r in ML.permutation_losses(model, one, names, "y", ["id"]).collect()}
    assert same["x1"].shuffled_mse == pytest.approx(same["x1"].mse)       # a constant shuffles to itself


def test_panel_filters_reach_the_scans(spark):
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = P.sales_panel(spark, SF_SMALL, "2000-01-01", "2000-12-31", [1])._jdf.queryExecution().explainString(formatted)
    assert "GreaterThanOrEqual(l_shipdate,2000-01-01" in plan and "LessThan(l_shipdate,2001-01-01" in plan
    assert "StringStartsWith(p_type,ECONOMY " in plan
    assert {r.grp for r in P.sales_panel(spark, SF_SMALL, groups=[1, 4]).select("grp").distinct().collect()} == {1, 4}
    whole = P.sales_panel(spark, SF_SMALL).where(F.col("day").between("2000-01-01", "2000-12-31"))
    some = P.sales_panel(spark, SF_SMALL, "2000-01-01", "2000-12-31")
    assert AL.differing_ranges(whole, some, ["day", "grp", "units", "lines"], F.trunc("day", "MM")).isEmpty()


def test_no_row_per_order_and_day(spark):
    plan = M.C.merged_ranges(M._order_windows(spark, SF_SMALL), "state", "start", "end")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


@pytest.mark.parametrize("missing", ["regex", "public_tokenizers", "daybook.llm"])
def test_optional_parts_may_be_absent(missing):
    """Core queries stay when a package of the optional parts cannot be imported."""
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as E; q = E.queries(); " \
           "assert 'm01_weekday_mean_eval' in q and not any(k.startswith('op') for k in q) and 'pipeline' not in q"
    assert subprocess.run([sys.executable, "-c", code]).returncode == 0


@pytest.mark.parametrize("constant", [7.0, 0.1, None])
def test_least_norm_fit_of_a_dependent_design(spark, constant):
    x, y = design()
    x[:, 3] = x[:, 0] if constant is None else constant
    fit = LS.fit_triangular(frame(spark, x, y), [f"x{i}" for i in range(4)], "y", least_norm=True)
    z, s = x - x.mean(0), np.where(x.std(0) > 1e-12, x.std(0), 1)
    z[:, x.std(0) <= 1e-12] = 0
    beta = np.linalg.pinv(z / s) @ (y - y.mean()) / s
    assert list(fit["coef"].values()) == pytest.approx(beta, rel=1e-8, abs=1e-10)
    res = y - y.mean() - z @ beta
    assert fit["r2"] == pytest.approx(1 - res @ res / ((y - y.mean()) @ (y - y.mean())), rel=1e-10)


def test_shared_slopes_where_a_group_lacks_a_head_and_a_shared_column_is_constant(spark):
    x, y = design(900, 4)
    g = np.arange(900) % 5
    x[:, 2], x[g == 3, 3] = 7.0, 2.0
    y = y + g * 3.0 + g * x[:, 3]
    coef, heads = LS.fit_shared_and_heads(frame(spark, x, y, g=g), ["x0", "x1", "x2"], ["x3"], "y", "g", least_norm=True)
    dummy = (g[:, None] == np.arange(5)).astype(float)
    full = np.c_[x[:, :2], dummy, dummy * x[:, 3:]]
    want = full @ np.linalg.lstsq(full, y, rcond=None)[0]
    rows = {r.g: r for r in heads.collect()}
    got = x[:, :3] @ [coef[f"x{i}"] for i in range(3)] + [rows[k].b0 + rows[k].b_x3 * v for k, v in zip(g, x[:, 3])]
    assert coef["x2"] == 0 and got == pytest.approx(want, rel=1e-8)


def test_full_ols_where_a_measure_is_the_same_on_all_days(spark, tmp_path):
    for name in ("lineitem", "part", "customer", "nation", "region"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{SF_SMALL}/{name}.parquet")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    orders.withColumn("o_orderpriority", F.lit("3-MEDIUM")).write.parquet(str(tmp_path / "orders.parquet"))
    rows = {r.split: r for r in M.full_ols(spark, str(tmp_path)).collect()}
    assert set(rows) == {"train", "validation"} and all(np.isfinite(r.rmse) for r in rows.values())
    assert 0 < rows["train"].r2 < 1
    assert M.shared_heads(spark, str(tmp_path)).count() == 6
