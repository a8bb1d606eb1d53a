"""Registered queries: entry smoke test and DuckDB twins on the smallest
scale factor (the driver runs the same comparison at sf0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from daybook.plans import QUERIES
from daybook.sources.tables import TABLES

from .conftest import SF_SMALL

FAST = ["m01_weekday_mean_eval", "c01_calendar_spine", "c08_paydays", "j01_enriched_panel",
        "f01_calendar_features", "f23_measure_features", "a01_describe", "a26_box_stats",
        "e04_event_intervals", "r02_f_scores_group_max", "m09_spectrum_top", "w01_rolling",
        "s09_packed_ids", "v11_aligned_totals", "v11b_prediction_series", "a02b_fact_quantiles",
        "a26b_fact_box_stats", "f40b_fact_scaling"]


def _norm(rows):
    def n(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 5)
        return v
    return sorted((tuple(n(x) for x in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["grp", "n", "mae", "rmse", "r2", "mape", "mape_n"]
    assert df.count() > 0


def test_every_query_has_callable_and_known_twin():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    core = set(QUERIES)
    assert core <= set(qs) and {"m06_full_ols", "m16_shared_heads", "r08_forest_importance", "s15_stored_model"} <= core


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql_twin(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(cols)
    order = sorted(cols)
    srows = [tuple(r[c] for c in order) for r in df.collect()]
    drows = [tuple(r[cols.index(c)] for c in order) for r in drows]
    assert _norm(srows) == _norm(drows)
