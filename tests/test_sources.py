"""File sources, sinks and key parsing (S1-S16) on literal fixtures."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from daybook.sources import files as FI
from daybook.sources import panel as P

D = dt.date

MARKDOWN = """# Schulferien in Deutschland 2017 - Übersicht

## Baden-Württemberg
- Winterferien: 30.01.2017 - 03.02.2017
- Weihnachtsferien: 22.12.2017 - 05.01.2018

# Schulferien in Deutschland 2018 - Übersicht

## Baden-Württemberg:
   - Winterferien: 29. Januar - 10. Februar 2018
   - Weihnachtsferien: 22. Dezember 2018 - 5. Januar 2019
## Bayern:
    - Herbstferien: 15. Oktober - 26. Oktober 2018
    - Kaputt: irgendwann - nie
"""


def _write(text, name):
    d = tempfile.mkdtemp(prefix="daybook-test-")
    p = os.path.join(d, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_sectioned_markdown_both_formats(spark):
    ranges, bad = FI.read_sectioned_markdown(spark, _write(MARKDOWN, "holidays.md"))
    got = {(r.year, r.state, r.name): (r.start, r.end) for r in ranges.collect()}
    assert got[(2017, "Baden-Württemberg", "Winterferien")] == (D(2017, 1, 30), D(2017, 2, 3))
    assert got[(2018, "Baden-Württemberg", "Winterferien")] == (D(2018, 1, 29), D(2018, 2, 10))
    assert got[(2018, "Baden-Württemberg", "Weihnachtsferien")] == (D(2018, 12, 22), D(2019, 1, 5))
    assert got[(2018, "Bayern", "Herbstferien")] == (D(2018, 10, 15), D(2018, 10, 26))
    assert len(got) == 5                                   # first section kept (D2)
    assert [r.line.strip() for r in bad.collect()] == ["- Kaputt: irgendwann - nie"]   # D20


def test_semicolon_and_headerless_and_short_header(spark):
    p1 = _write("Datum;Feiertag\r\n01.01.2013;1\r\n29.03.2013;1\r\n\r\n", "f.csv")
    df = FI.read_csv(spark, p1, "Datum string, Feiertag int", sep=";")
    days = [r[0] for r in df.select(FI.parse_date(F.col("Datum"), "dd.MM.yyyy")).collect()]
    assert days == [D(2013, 1, 1), D(2013, 3, 29)]
    p2 = _write("0;nicht beobachtet\n1;Regen\n", "codes.csv")
    codes = FI.read_csv(spark, p2, "code int, description string", sep=";", header=False)
    assert codes.count() == 2
    p3 = _write("Datum\n2012-04-07,1\n2013-03-30,1\n", "short.csv")
    s = FI.read_short_header(spark, p3, "Datum date, flag int")
    assert [tuple(r) for r in s.collect()] == [(D(2012, 4, 7), 1), (D(2013, 3, 30), 1)]


def test_keyed_files_and_json_sink(spark):
    out = tempfile.mkdtemp(prefix="daybook-test-")
    df = spark.createDataFrame([(D(2020, 1, 1), 1, 2.0), (D(2020, 1, 2), 3, 4.0)],
                               "day date, g int, units double")
    FI.write_table(df, os.path.join(out, "p"), "csv", partition_by=["g"])
    back = FI.read_keyed_files(spark, os.path.join(out, "p", "g=*", "*.csv"),
                               "day date, units double", r"/g=(\d+)/", "g")
    assert sorted((r.g, r.units) for r in back.collect()) == [("1", 2.0), ("3", 4.0)]
    rep = FI.stats_report(spark.createDataFrame([(1, 0.5)], "grp int, mae double"), "s", ["grp"])
    FI.write_table(rep, os.path.join(out, "j"), "json")
    assert spark.read.json(os.path.join(out, "j")).count() == 1


def test_packed_ids_round_trip(spark):
    df = spark.createDataFrame([(D(2018, 8, 1), 1), (D(1999, 12, 31), 6)], "day date, grp int")
    ids = df.select(P.packed_id(F.col("day"), F.col("grp")).alias("id"))
    got = ids.select("id", P.id_day(F.col("id")).alias("d"), P.id_group(F.col("id")).alias("g")).collect()
    assert (got[0].id, got[0].d, got[0].g) == (1808011, D(2018, 8, 1), 1)
    assert (got[1].d, got[1].g) == (D(1999, 12, 31), 6)


def test_missing_inputs_raise(spark):
    with pytest.raises(FI.MissingInputError):
        FI.require_inputs(spark, ["/nonexistent/file.csv"])


def test_coercing_cast(spark):
    df = spark.createDataFrame([("1.5",), ("x",)], "s string")
    assert [r[0] for r in df.select(FI.coerce_double(F.col("s"))).collect()] == [1.5, None]


def test_model_persistence(spark):
    from daybook.operators import mlmodels as ML
    df = spark.createDataFrame([(float(i), float(i % 2), 2.0 * i) for i in range(20)],
                               "a double, b double, y double")
    model, _ = ML.fit_score(ML.feature_pipeline(["a"], ["b"], "y", ML.ols("y")), df, df)
    p = os.path.join(tempfile.mkdtemp(prefix="daybook-test-"), "m")
    ML.save_model(model, p)
    pred = ML.load_model(p).transform(df).select("pred").first()[0]
    assert pred == pytest.approx(0.0, abs=1e-6)
