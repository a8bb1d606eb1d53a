"""Feature expressions and null rules (F, N, D5/D16/D17)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.functions import dates as DT
from daybook.functions import encode as EN
from daybook.functions import nulls as NU
from daybook.functions import scale as SC
from daybook.functions import weather as WX
from daybook.functions.numeric import rnd, sql_round_rewrite

D = dt.date


def test_weekday_monday_zero_and_iso_week(spark):
    df = spark.createDataFrame([(D(2013, 7, 1),), (D(2016, 1, 1),)], "day date")
    r = df.select(F.weekday("day").alias("w"), F.weekofyear("day").alias("k"),
                  DT.weekday_name("day").alias("n")).collect()
    assert (r[0].w, r[0].n) == (0, "Monday")
    assert r[1].k == 53


def test_month_third_is_right_closed(spark):
    df = spark.createDataFrame([(D(2020, 1, 10),), (D(2020, 1, 11),), (D(2020, 1, 20),),
                                (D(2020, 1, 21),)], "day date")
    assert [r[0] for r in df.select(DT.month_third("day")).collect()] == \
        ["start", "middle", "middle", "end"]


def test_seasons_two_rules(spark):
    df = spark.createDataFrame([(D(2020, 3, 1),), (D(2020, 9, 1),)], "day date")
    r = df.select(DT.season_meteo("day"), DT.season_quarter("day")).collect()
    assert tuple(r[0]) == ("spring", "winter") and tuple(r[1]) == ("fall", "summer")


def test_temperature_categories_null_rules(spark):
    df = spark.createDataFrame([(None, "winter"), (10.0, "winter"), (20.0, "summer")],
                               "temp double, season string")
    r = df.select(
        WX.cut_right("temp", WX.BASE_EDGES, WX.BASE_LABELS).alias("base"),
        WX.season_temp_category("temp", "season", WX.SEASON_TEMP_TABLES["preparation"],
                                WX.SEASON_TEMP_FALLBACK).alias("prep"),
        WX.season_temp_category("temp", "season", WX.SELECTION_TEMP_TABLE,
                                WX.SELECTION_TEMP_FALLBACK).alias("sel")).collect()
    assert (r[0].base, r[0].prep, r[0].sel) == (None, "mild", "warm")   # D17
    assert r[1].base == "cold" and r[1].prep == "warm"                   # (-inf,10] / [10, inf)
    assert r[2].prep == "warm" and r[2].sel == "mild"


def test_good_weather_null_description(spark):
    df = spark.createDataFrame([(16.0, 3, None), (16.0, 3, "Regen"), (None, 3, None)],
                               "t double, c int, d string")
    got = [r[0] for r in df.select(WX.good_weather("t", "c", "d", ["Regen"], ["Schnee"])).collect()]
    assert got == [True, False, False]


def test_one_hot_rows_sum_to_one_and_drop_first(spark):
    df = spark.createDataFrame([(0,), (3,), (6,)], "w int")
    full = EN.one_hot("w", list(range(7)), "wd")
    s = df.select(sum(full.values()).alias("s")).collect()
    assert all(r.s == 1 for r in s)
    dropped = EN.one_hot("w", list(range(7)), "wd", drop_first=True)
    assert "wd_0" not in dropped and len(dropped) == 6


def test_ffill_stays_inside_group(spark):
    df = spark.createDataFrame([
        ("a", 1, 1.0), ("a", 2, None), ("a", 3, None),
        ("b", 1, None), ("b", 2, 5.0)], "g string, day int, x double")
    got = {(r.g, r.day): r.x for r in NU.ffill_bfill(df, ["x"], ["g"], "day").collect()}
    assert got[("a", 3)] == 1.0 and got[("b", 1)] == 5.0   # never crosses a -> b (D5)


def test_mean_impute_uses_fit_frame(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, None), (4, 100.0)], "d int, x double")
    train = df.where("d <= 2")
    got = {r.d: r.x for r in NU.mean_impute(df, ["x"], fit_on=train).collect()}
    assert got[3] == 2.0  # train mean, not the mean of all rows (D4)


def test_standard_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (6.0,)], "x double")
    fit = SC.fit_standard(df, ["x"])
    z = [r.x_z for r in SC.apply_standard(df, fit, "_z").collect()]
    assert z[0] == pytest.approx((1 - 3) / (14 / 3) ** 0.5)


def test_quantile_edges_fitted_on_train(spark):
    tr = spark.createDataFrame([(float(i),) for i in range(1, 11)], "t double")
    other = spark.createDataFrame([(0.0,), (100.0,)], "t double")
    e = WX.quantile_edges(tr, "t")
    got = [r[0] for r in other.select(WX.quantile_category("t", e)).collect()]
    assert got == ["very_cold", "hot"]


def test_rounding_same_rule_both_sides(spark):
    df = spark.createDataFrame([(0.125,), (-2.5,)], "x double")
    assert [r[0] for r in df.select(rnd("x", 2)).collect()] == [0.13, -2.5]
    import duckdb
    for x, want in ((0.125, 0.13), (-2.5, -2.5), (1e17 / 3, 1e17 / 3), (float("inf"), float("inf"))):
        assert duckdb.execute(sql_round_rewrite("SELECT ROUND(?::DOUBLE, 2)").replace("?", "$1"), [x]).fetchone()[0] == want


def test_rounding_passes_what_has_no_digits(spark):
    from daybook.functions.numeric import rnd
    df = spark.createDataFrame([(1e14, 5e10, float("nan"), float("inf"), 2.5)], "a double, b double, c double, d double, e double")
    r = df.select(rnd("a", 6), rnd("b", 9), rnd("c", 3), rnd("d", 3), rnd("e", 0)).first()
    assert r[0] == 1e14 and r[1] == 5e10 and r[2] != r[2] and r[3] == float("inf") and r[4] == 3.0


def test_availability_is_by_month_of_the_year(spark):
    import datetime
    from daybook.operators.profile import availability_ratio
    D = datetime.date
    fit = spark.createDataFrame([(D(1999, 1, 1), 1), (D(1999, 1, 2), 1), (D(1999, 1, 2), 2), (D(1998, 1, 5), 1)], "day date, grp int")
    rows = spark.createDataFrame([(D(2000, 1, 9), 1), (D(2000, 1, 9), 2), (D(2000, 2, 1), 1)], "day date, grp int")
    got = {(r.day.month, r.grp): r.availability for r in availability_ratio(fit, rows).collect()}
    assert got == {(1, 1): 1.0, (1, 2): 1 / 3, (2, 1): None}


def test_missing_checkpoint_folder_is_a_named_error():
    import pytest
    from daybook import session

    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = {}
    with pytest.raises(session.CheckpointFolderMissing):
        session.ensure_checkpoint_dir(Session)
