"""Calendar operators against values derivable by hand."""

import datetime as dt

from pyspark.sql import functions as F

from daybook.operators import calendar as C

D = dt.date


def test_easter_saturday_golden(spark):
    # Easter Sunday minus one day, 2012..2019
    years = C.year_table(spark, 2012, 2019)
    got = [r.easter_saturday for r in C.easter_table(years).orderBy("year").collect()]
    assert got == [D(2012, 4, 7), D(2013, 3, 30), D(2014, 4, 19), D(2015, 4, 4),
                   D(2016, 3, 26), D(2017, 4, 15), D(2018, 3, 31), D(2019, 4, 20)]


def test_holidays_and_workday(spark):
    years = C.year_table(spark, 2016, 2016)
    hol = {r.day for r in C.national_holidays(years).collect()}
    assert D(2016, 3, 25) in hol and D(2016, 3, 28) in hol  # Good Friday, Easter Monday
    assert D(2016, 5, 5) in hol and D(2016, 5, 16) in hol   # Ascension, Whit Monday
    assert len(hol) == 9


def test_second_saturday_of_festival(spark):
    # a 9-day festival Saturday..Sunday: the parade is its second Saturday
    years = C.year_table(spark, 2012, 2019)
    par = [r.day for r in C.nth_weekday(C.festival_days(years), 2, 5).orderBy("day").collect()]
    assert par == [D(2012, 6, 23), D(2013, 6, 29), D(2014, 6, 28), D(2015, 6, 27),
                   D(2016, 6, 25), D(2017, 6, 24), D(2018, 6, 23), D(2019, 6, 29)]


def test_nth_weekday_needs_enough_days(spark):
    days = spark.createDataFrame([(D(2020, 6, 6),), (D(2021, 6, 5),), (D(2021, 6, 12),)], "day date")
    got = [r.day for r in C.nth_weekday(days, 2, 5).collect()]
    assert got == [D(2021, 6, 12)]  # 2020 has a single Saturday: no row


def test_bridge_days_and_day_before(spark):
    spine = C.day_spine(spark, "2016-04-25", "2016-05-10")
    hol = C.national_holidays(C.year_table(spark, 2016, 2016))
    cal = C.holiday_calendar(spine, hol)
    rows = {r.day: r for r in cal.select(
        "day", C.bridge_day_strict(cal).alias("strict"), C.bridge_day_loose(cal).alias("loose"),
        C.day_before_holiday(cal, "2016-05-10").alias("before")).collect()}
    assert rows[D(2016, 5, 6)].strict          # Friday after Ascension Thursday
    assert rows[D(2016, 5, 6)].loose
    assert not rows[D(2016, 5, 4)].strict
    assert rows[D(2016, 5, 4)].before          # Wednesday before Ascension
    assert not rows[D(2016, 4, 29)].loose      # Friday, but 1 May falls on a Sunday
    assert not rows[D(2016, 5, 10)].before     # clipped at the range end


def test_paydays_roll_back(spark):
    spine = C.day_spine(spark, "2016-01-01", "2016-12-31")
    hol = C.national_holidays(C.year_table(spark, 2016, 2016))
    cal = C.holiday_calendar(spine, hol)
    pays = {(r.kind, r.day.month): r.day for r in C.paydays(cal).collect()}
    assert pays[("month_end", 1)] == D(2016, 1, 29)   # 31 Jan is a Sunday
    assert pays[("d15", 5)] == D(2016, 5, 13)          # 15 May Sunday, 16 May Whit Monday
    assert pays[("d25", 12)] == D(2016, 12, 23)        # 25/26 Dec holidays, 24 Saturday
    assert len(pays) == 36


def test_ranges_dense_calendar_and_slug(spark):
    ranges = spark.createDataFrame(
        [("Schleswig-Holstein", D(2020, 1, 1), D(2020, 1, 3)),
         ("Schleswig-Holstein", D(2020, 1, 2), D(2020, 1, 4)),
         ("Baden-Württemberg", D(2020, 1, 5), D(2020, 1, 5))], "state string, start date, end date")
    days = C.distinct_days(C.ranges_to_days(ranges, "start", "end"), "state")
    dense = C.dense_flag_calendar(days, "state", "2020-01-01", "2020-01-06")
    counts = {r.state: (r.n, r.f) for r in dense.groupBy("state").agg(
        F.count("*").alias("n"), F.sum("flag").alias("f")).collect()}
    assert counts == {"Schleswig-Holstein": (6, 4), "Baden-Württemberg": (6, 1)}
    s = spark.createDataFrame([("Baden-Württemberg",), ("Straße Süd",)], "x string")
    assert [r[0] for r in s.select(C.slug(F.col("x"))).collect()] == ["baden_wuerttemberg", "strasse_sued"]


def test_payday_window(spark):
    df = spark.createDataFrame([(D(2020, 1, 3),), (D(2020, 1, 4),), (D(2020, 1, 25),)], "day date")
    assert [r[0] for r in df.select(C.payday_window(F.col("day"))).collect()] == [True, False, True]
