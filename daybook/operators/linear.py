"""Least squares through Gram matrices.

One aggregate pass computes n, X'X, X'y and y'y (per group when asked);
these sums combine map-side, so the pass scales with the rows and the
shuffle carries one small vector per partition and group.  Solving a
p x p system is tiny, fitted state: pooled models solve it in the driver,
per-group models solve it in ``applyInPandas`` (one row per group),
subset searches score every candidate subset in ``mapInPandas``.
Rank-deficient designs get the minimum-norm solution.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sizing import checked_broadcast


def gram_aggs(features: list[str], target: str) -> list[Column]:
    """Sums for X'X (with intercept), X'y, y'y and n as one aggregate list."""
    xs = [F.lit(1.0)] + [F.col(c).cast("double") for c in features]
    y = F.col(target).cast("double")
    out = [F.count(F.lit(1)).alias("n"), F.sum(y * y).alias("yy")]
    for i, j in itertools.combinations_with_replacement(range(len(xs)), 2):
        out.append(F.sum(xs[i] * xs[j]).alias(f"xx_{i}_{j}"))
    for i in range(len(xs)):
        out.append(F.sum(xs[i] * y).alias(f"xy_{i}"))
    return out


def gram(df: DataFrame, features: list[str], target: str, by: list[str] | None = None) -> DataFrame:
    """Gram sums over rows with no null feature or target (one pass)."""
    clean = df.dropna(subset=features + [target])
    return clean.groupBy(*(by or [])).agg(*gram_aggs(features, target))


def _unpack(row: dict, p: int) -> tuple[np.ndarray, np.ndarray, float, int]:
    a = np.zeros((p, p))
    for i, j in itertools.combinations_with_replacement(range(p), 2):
        a[i, j] = a[j, i] = row[f"xx_{i}_{j}"]
    b = np.array([row[f"xy_{i}"] for i in range(p)], dtype=float)
    return a, b, float(row["yy"]), int(row["n"])


def solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum-norm solution of the normal equations."""
    return np.linalg.lstsq(a, b, rcond=None)[0]


def fit_pooled(df: DataFrame, features: list[str], target: str) -> dict:
    """M3-M6: pooled OLS; returns intercept, coefficients, n, R^2 and
    adjusted R^2 from the one Gram pass (the only collect is the 1-row
    Gram)."""
    row = gram(df, features, target).first().asDict()
    p = len(features) + 1
    a, b, yy, n = _unpack(row, p)
    beta = solve(a, b)
    sse = yy - 2 * beta @ b + beta @ a @ beta
    sst = yy - b[0] ** 2 / n
    r2 = 1 - sse / sst if sst > 0 else float("nan")
    k = len(features)
    adj = 1 - (1 - r2) * (n - 1) / (n - k - 1) if n - k - 1 > 0 else float("nan")
    return {"intercept": float(beta[0]), "coef": dict(zip(features, map(float, beta[1:]))),
            "n": n, "r2": float(r2), "adj_r2": float(adj)}


def linear_predict(coef: dict, intercept: float) -> Column:
    """Score a fitted linear model as one column expression."""
    out = F.lit(float(intercept))
    for c, w in coef.items():
        out = out + F.lit(float(w)) * F.col(c).cast("double")
    return out


def coefficient_table(spark: SparkSession, fitted: dict) -> DataFrame:
    """Coefficients as rows with |coef| for ranking (signed kept)."""
    rows = [(k, float(v), abs(float(v))) for k, v in fitted["coef"].items()]
    return spark.createDataFrame(rows, "feature string, coef double, abs_coef double")


def fit_per_group(df: DataFrame, features: list[str], target: str, group: str,
                  min_rows: int | None = None) -> DataFrame:
    """One OLS per group.  Groups with fewer than ``min_rows`` rows
    (default: features + 2) fall back to the group mean (all slopes 0).
    Output: one row per group with ``b0`` (intercept), ``b1..bk`` and
    ``fallback``."""
    p = len(features) + 1
    min_rows = min_rows if min_rows is not None else p + 1
    g = gram(df, features, target, [group])
    cols = [f"b{i}" for i in range(p)]
    schema = ", ".join([f"{group} {dict(df.dtypes)[group]}"] + [f"{c} double" for c in cols]
                       + ["fallback boolean", "n long"])

    def solve_groups(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, r in pdf.iterrows():
            a, b, _, n = _unpack(r, p)
            if n < min_rows:
                beta = np.zeros(p)
                beta[0] = b[0] / n if n else np.nan
                fb = True
            else:
                beta, fb = solve(a, b), False
            out.append([r[group], *map(float, beta), fb, n])
        return pd.DataFrame(out, columns=[group, *cols, "fallback", "n"])

    return g.groupBy(group).applyInPandas(solve_groups, schema)


def score_per_group(rows: DataFrame, models: DataFrame, features: list[str], group: str,
                    name: str = "pred") -> DataFrame:
    """Join each row to its group's coefficients (size-checked broadcast)
    and evaluate b0 + sum(b_i x_i)."""
    j = rows.join(checked_broadcast(models), group, "left")
    pred = F.col("b0")
    for i, c in enumerate(features, start=1):
        pred = pred + F.col(f"b{i}") * F.col(c).cast("double")
    return j.withColumn(name, pred).drop(*[f"b{i}" for i in range(len(features) + 1)], "fallback", "n")


def score_subsets(spark: SparkSession, g_row: dict, features: list[str],
                  masks: DataFrame) -> DataFrame:
    """Adjusted R^2 of every candidate subset (bit mask over
    ``features``) from one Gram row.  The Gram is (k+1)^2 numbers and
    travels in the task closure; the candidates are a Spark table, so the
    2^k search is spread over the cluster.  Output ``(mask, size, r2,
    adj_r2)``."""
    p = len(features) + 1
    a, b, yy, n = _unpack(g_row, p)

    def score(it):
        for pdf in it:
            res = []
            for m in pdf["mask"].tolist():
                idx = [0] + [i + 1 for i in range(p - 1) if (m >> i) & 1]
                aa, bb = a[np.ix_(idx, idx)], b[idx]
                beta = solve(aa, bb)
                sse = yy - 2 * beta @ bb + beta @ aa @ beta
                sst = yy - b[0] ** 2 / n
                r2 = 1 - sse / sst
                k = len(idx) - 1
                adj = 1 - (1 - r2) * (n - 1) / (n - k - 1) if n - k - 1 > 0 else np.nan
                res.append((m, k, float(r2), float(adj)))
            yield pd.DataFrame(res, columns=["mask", "size", "r2", "adj_r2"])

    return masks.mapInPandas(score, "mask long, size int, r2 double, adj_r2 double")


def mask_names(features: list[str]) -> Column:
    """Feature names of a ``mask`` column, comma separated."""
    parts = [F.when((F.col("mask").bitwiseAND(1 << i)) != 0, F.lit(f)) for i, f in enumerate(features)]
    return F.concat_ws(",", *parts)


def prefix_masks(spark: SparkSession, k: int) -> DataFrame:
    """Masks of the first 1..k ranked features."""
    return spark.range(1, k + 1).select(
        F.expr("shiftleft(CAST(1 AS BIGINT), CAST(id AS INT)) - 1").alias("mask"))


def all_masks(spark: SparkSession, k: int, max_size: int | None = None) -> DataFrame:
    """Every non-empty subset of k features (optionally up to
    ``max_size`` features)."""
    m = spark.range(1, 1 << k).select(F.col("id").alias("mask"))
    if max_size is not None:
        m = m.where(F.bit_count("mask") <= max_size)
    return m
