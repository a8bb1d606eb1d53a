"""Shared SQL fragments for the DuckDB twins (same semantics as the
DataFrame code in ``daybook.sources.panel``)."""

from __future__ import annotations

from ..sources.panel import GROUP_LABELS, TEST_START, TRAIN_END, VALID_END, VALID_START

GROUP_CASE = "CASE split_part(p_type, ' ', 1) " + " ".join(
    f"WHEN '{v}' THEN {k}" for k, v in GROUP_LABELS.items()) + " END"

LABEL_CASE = "COALESCE(CASE grp " + " ".join(
    f"WHEN {k} THEN '{v}'" for k, v in GROUP_LABELS.items()) + " END, 'Unknown')"

PANEL = f"""panel AS (
  SELECT CAST(l.l_shipdate AS DATE) AS day, CAST({GROUP_CASE} AS INTEGER) AS grp,
         SUM(l.l_quantity) AS units, COUNT(*) AS lines
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY 1, 2)"""

DAILY = """daily AS (
  SELECT day, n_orders,
         CAST(cents AS DOUBLE) / n_orders / 1000000.0 - 10.0 AS temp,
         CAST(spread AS DOUBLE) / 10000000.0 AS wind,
         CAST(floor(n_high * 8 / n_orders) AS INTEGER) AS cloud,
         code
  FROM (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n_orders,
               SUM(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)) AS cents,
               MAX(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT))
                 - MIN(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)) AS spread,
               SUM(CASE WHEN TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 2 THEN 1 ELSE 0 END) AS n_high,
               MIN(TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS code
        FROM orders GROUP BY 1) t)"""

CODES = """codes AS (
  SELECT DISTINCT TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prio_code,
         substr(o_orderpriority, 3, 100) AS description
  FROM orders)"""

WEEKDAY = "(isodow({d}) - 1)"


def wd(d: str) -> str:
    return f"CAST(isodow({d}) - 1 AS INTEGER)"


TRAIN = f"day <= DATE '{TRAIN_END}'"
VALID = f"day BETWEEN DATE '{VALID_START}' AND DATE '{VALID_END}'"
TEST = f"day >= DATE '{TEST_START}'"
SPLIT_CASE = (f"CASE WHEN day BETWEEN DATE '1990-01-01' AND DATE '{TRAIN_END}' THEN 'train' "
              f"WHEN {VALID} THEN 'validation' "
              f"WHEN day BETWEEN DATE '{TEST_START}' AND DATE '2099-12-31' THEN 'test' END")


def metrics(actual: str = "actual", pred: str = "pred", digits: int = 6) -> str:
    """SELECT list matching ``evaluate.metric_aggs``."""
    e = f"({actual} - {pred})"
    return (f"COUNT({actual}) AS n, "
            f"ROUND(AVG(ABS({e})), {digits}) AS mae, "
            f"ROUND(SQRT(AVG({e} * {e})), {digits}) AS rmse, "
            f"ROUND(1.0 - SUM({e} * {e}) / (SUM({actual} * {actual}) - SUM({actual}) * SUM({actual}) / COUNT({actual})), {digits}) AS r2, "
            f"ROUND(AVG(CASE WHEN {actual} <> 0 THEN ABS({e}) / ABS({actual}) END) * 100, {digits}) AS mape, "
            f"COUNT(CASE WHEN {actual} <> 0 THEN 1 END) AS mape_n")


def corr(a: str, b: str) -> str:
    """Pairwise-complete Pearson correlation, null for a constant side
    (same formula as ``profile.safe_corr``)."""
    xa = f"CASE WHEN {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
    xb = f"CASE WHEN {a} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
    return (f"(covar_pop({xa}, {xb}) / NULLIF(stddev_pop({xa}) * stddev_pop({xb}), 0))")
