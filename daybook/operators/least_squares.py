"""Least squares by orthogonal triangles (M6, M16) and subset search.

A Gram matrix squares the condition of a design and loses digits where
features sit far from zero.  Here every partition turns its rows into one
triangular factor (Householder QR, batch after batch), and factors of several
partitions are stacked and triangulated again, as often as needed; only
(k + 2)^2 numbers per partition move, and the last triangle is the whole fit.
Columns are centred and scaled by a first one-row aggregate.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Factors that one task stacks in the first merge.
FAN_IN = 256
# A pivot below this share of its column's length means that the column is a
# combination of those before it.
RANK_TOLERANCE = 1e-9


class RankDeficientDesign(ValueError):
    """A feature is a linear combination of others (or constant)."""


def triangle(rows: np.ndarray) -> np.ndarray:
    """R of the QR decomposition, square however few rows there are."""
    p = rows.shape[1]
    if len(rows) < p:
        rows = np.vstack([rows, np.zeros((p - len(rows), p))])
    return np.linalg.qr(rows, mode="r")


def centred(df: DataFrame, cols: list[str], by_scale: bool = True, flat: bool = False) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Rows without nulls in ``cols``, each column less its mean and over its
    standard deviation (1 where that is 0), with the means and deviations.
    With ``flat``, a column whose deviation is but rounding of its mean becomes
    0 throughout."""
    clean = df.select("*").dropna(subset=cols)
    row = clean.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
                    *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    mean = np.array([row[f"m{i}"] or 0.0 for i in range(len(cols))])
    scale = np.array([row[f"s{i}"] or 1.0 for i in range(len(cols))]) if by_scale else np.ones(len(cols))
    shifted = [((F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s))).alias(c) for c, m, s in zip(cols, mean, scale)]
    if flat:
        still = np.array([(row[f"s{i}"] or 0.0) <= 1e-13 * abs(m) for i, m in enumerate(mean)])
        shifted = [F.lit(0.0).alias(c) if at_rest else x for c, x, at_rest in zip(cols, shifted, still)]
        scale = np.where(still, 1.0, scale)
    return clean.select(*[c for c in clean.columns if c not in cols], *shifted), mean, scale


def group_triangles(df: DataFrame, cols: list[str], by: str | None = None) -> DataFrame:
    """``(key, n, factor)``: the triangle of [1, cols] per value of ``by`` (null:
    one for all rows), at most one row per key and FAN_IN partitions."""
    p = len(cols) + 1
    kind = dict(df.dtypes)[by] if by else "int"
    schema = f"key {kind}, part long, n long, factor binary"

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for pdf in batches:
            for key, rows in pdf.groupby("key", dropna=False) if by else [(0, pdf)]:
                x = np.column_stack([np.ones(len(rows)), rows[cols].to_numpy(float)])
                n, r = held.get(key, (0, np.zeros((0, p))))
                held[key] = n + len(rows), triangle(np.vstack([r, x]))
        part = TaskContext.get().partitionId() // FAN_IN
        out = [(k, part, n, r.tobytes()) for k, (n, r) in held.items()]
        yield pd.DataFrame(out, columns=["key", "part", "n", "factor"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = np.vstack([np.frombuffer(b).reshape(-1, p) for b in pdf["factor"]])
        return pd.DataFrame([(pdf["key"].iloc[0], pdf["part"].iloc[0], int(pdf["n"].sum()), triangle(rows).tobytes())],
                            columns=["key", "part", "n", "factor"])

    keyed = df.select(*([F.col(by).alias("key")] if by else []), *cols)
    parts = keyed.mapInPandas(reduce, schema).groupBy("key", "part").applyInPandas(merge, schema)
    return parts.withColumn("part", F.lit(0).cast("long")).groupBy("key", "part").applyInPandas(merge, schema).drop("part")


def weak_pivots(r: np.ndarray) -> np.ndarray:
    """True where a pivot vanishes against its column."""
    return np.abs(np.diag(r)) <= RANK_TOLERANCE * np.maximum(np.linalg.norm(r, axis=0), 1e-300)


def solved(r: np.ndarray, rhs: np.ndarray, names: list[str], least_norm: bool = False) -> np.ndarray:
    """Back substitution.  Where a pivot vanishes: the least-norm solution if
    ``least_norm``, else ``RankDeficientDesign``."""
    weak = weak_pivots(r)
    if not weak.any():
        return np.linalg.solve(r, rhs)
    if not least_norm:
        raise RankDeficientDesign(", ".join(n for n, w in zip(names, weak) if w))
    return np.linalg.lstsq(r, rhs, rcond=RANK_TOLERANCE)[0]


def below_heads(r: np.ndarray, h: int) -> np.ndarray:
    """What a triangle's first ``h`` columns leave of the others; where these
    columns are dependent, the rows of the directions they do not reach too."""
    if not weak_pivots(r[:h, :h]).any():
        return r[h:, h:]
    u, size, _ = np.linalg.svd(r[:h, :h])
    unreached = u[:, int((size > RANK_TOLERANCE * size[0]).sum()):]
    return triangle(np.vstack([unreached.T @ r[:h, h:], r[h:, h:]]))


def fit_triangular(df: DataFrame, features: list[str], target: str, least_norm: bool = False) -> dict:
    """M6: pooled least squares with intercept: intercept, coefficients, n, R^2,
    adjusted R^2.  Rows with a null are left out.  A design that is not of full
    rank raises ``RankDeficientDesign`` with the columns that cause it; with
    ``least_norm`` it gets, of the best fits, that with the least slopes of the
    scaled columns (0 for a constant one)."""
    rows, mean, scale = centred(df, [*features, target], flat=least_norm)
    row = group_triangles(rows, [*features, target]).first()
    k = len(features)
    r = np.frombuffer(row["factor"]).reshape(k + 2, k + 2)
    slope = solved(r[:k + 1, :k + 1], r[:k + 1, k + 1], ["1", *features], least_norm)
    coef = slope[1:] * scale[k] / scale[:k]
    off = r[:k + 1, :k + 1] @ slope - r[:k + 1, k + 1]          # nothing but rounding where the rank is full
    sse, sst, n = float(r[k + 1, k + 1] ** 2 + off @ off), float((r[1:, k + 1] ** 2).sum()), int(row["n"])
    r2 = 1 - sse / sst if sst > 0 else float("nan")
    return {"intercept": float(mean[k] + slope[0] * scale[k] - coef @ mean[:k]), "coef": dict(zip(features, map(float, coef))), "n": n,
            "r2": float(r2), "adj_r2": float(1 - (1 - r2) * (n - 1) / (n - k - 1)) if n > k + 1 else float("nan")}


def fit_shared_and_heads(df: DataFrame, shared: list[str], heads: list[str], target: str, group: str,
                         least_norm: bool = False) -> tuple[dict[str, float], DataFrame]:
    """One joint fit of slopes that all groups share and of an intercept
    and ``heads`` slopes of every group's own.

    Each group's triangle of [1, heads, shared, target] holds its heads' rows
    first.  What is below them no longer contains the heads: it is the group's
    share of the reduced (Schur) system of the shared slopes.  Those shares are
    stacked into one small triangle and solved; every group then solves its own
    heads against the shared part.  Returns the shared coefficients and a table
    ``(group, b0, heads..., n)``, one row per group.  Dependent columns raise
    ``RankDeficientDesign`` or, with ``least_norm``, get the least slopes, shared
    ones first.
    """
    cols = [*heads, *shared, target]
    rows, mean, scale = centred(df, cols, flat=least_norm)
    h, s, p = len(heads) + 1, len(shared), len(cols) + 1
    kind = dict(df.dtypes)[group]
    of_group = group_triangles(rows, cols, group).persist()
    try:
        def rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            r = np.zeros((0, s + 1))
            for pdf in batches:
                for b in pdf["factor"]:
                    r = triangle(np.vstack([r, below_heads(np.frombuffer(b).reshape(p, p), h)]))
            yield pd.DataFrame({"part": [TaskContext.get().partitionId() // FAN_IN], "factor": [triangle(r).tobytes()]})

        def merge(pdf: pd.DataFrame) -> pd.DataFrame:
            r = triangle(np.vstack([np.frombuffer(b).reshape(-1, s + 1) for b in pdf["factor"]]))
            return pd.DataFrame({"part": [0], "factor": [r.tobytes()]})

        schema = "part long, factor binary"
        small = of_group.mapInPandas(rest, schema).groupBy("part").applyInPandas(merge, schema)
        r = np.frombuffer(small.groupBy("part").applyInPandas(merge, schema).first()["factor"]).reshape(s + 1, s + 1)
        slope = solved(r[:s, :s], r[:s, s], shared, least_norm)

        def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = []
                for key, n, b in zip(pdf["key"], pdf["n"], pdf["factor"]):
                    f = np.frombuffer(b).reshape(p, p)
                    z = solved(f[:h, :h], f[:h, p - 1] - f[:h, h:p - 1] @ slope, [f"{group} {key}: {c}" for c in ["1", *heads]], least_norm)
                    head = z[1:] * scale[-1] / scale[:h - 1]
                    known = head @ mean[:h - 1] + (slope * scale[-1] / scale[h - 1:-1]) @ mean[h - 1:-1]
                    out.append([key, float(mean[-1] + z[0] * scale[-1] - known), *map(float, head), int(n)])
                yield pd.DataFrame(out, columns=[group, "b0", *(f"b_{c}" for c in heads), "n"])

        fields = ", ".join([f"{group} {kind}", "b0 double", *(f"b_{c} double" for c in heads), "n long"])
        models = df.sparkSession.createDataFrame(of_group.mapInPandas(own, fields).toArrow())       # one row a group
    finally:
        of_group.unpersist()
    return dict(zip(shared, map(float, slope * scale[-1] / scale[h - 1:-1]))), models


def best_subsets(df: DataFrame, features: list[str], target: str, best: int = 10, branches: int = 64) -> DataFrame:
    """The ``best`` subsets of any size by adjusted R^2, exactly, without
    looking at all 2^k of them: ``(rank, size, features, r2, adj_r2)``.

    Taking a feature out never lowers the residual sum.  A branch keeps some
    features for good and may drop others: with everything it may still keep its
    residual is least, and with only what it must keep its size is, so

        1 - residual(may keep) / (n - 1 - least size) * (n - 1) / total

    bounds the adjusted R^2 of all subsets in it.  The driver opens branches, best
    bound first, until there are ``branches``; these are a Spark table, and every
    task searches its branches depth first, cutting those whose bound is below
    the worst of its best so far.  The residuals come from the design's triangle.
    """
    rows, _, _ = centred(df, [*features, target])
    row = group_triangles(rows, [*features, target]).first()
    k, n = len(features), int(row["n"])
    r = np.frombuffer(row["factor"]).reshape(k + 2, k + 2)[1:, 1:]
    total = float((r[:, k] ** 2).sum())

    def residual(kept: tuple[int, ...]) -> float:
        if not kept:
            return total
        x = r[:, list(kept)]
        return float(((r[:, k] - x @ np.linalg.lstsq(x, r[:, k], rcond=None)[0]) ** 2).sum())

    def adjusted(res: float, size: int) -> float:
        return 1 - res / total * (n - 1) / (n - size - 1) if n - size - 1 > 0 else float("-inf")

    def opened(must: tuple[int, ...], may: tuple[int, ...]) -> list[tuple[float, tuple, tuple]]:
        """The two halves of a branch: its first open feature stays or goes."""
        first, rest = may[0], may[1:]
        out = []
        for m in ((*must, first), must):
            out.append((adjusted(residual((*m, *rest)), max(1, len(m))), m, rest))
        return out

    # the feature that hurts most when it goes is decided first
    whole = tuple(range(k))
    order = tuple(sorted(whole, key=lambda i: (-residual(tuple(j for j in whole if j != i)), i)))
    heap = [(-adjusted(residual(whole), 1), (), order)]
    while len(heap) < branches and any(may for _, _, may in heap):
        closed = [b for b in heap if not b[2]]
        open_ = [b for b in heap if b[2]]
        heapq.heapify(open_)
        _, must, may = heapq.heappop(open_)
        heap = closed + open_ + [(-b, m, rest) for b, m, rest in opened(must, may)]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top: list[tuple[float, tuple]] = []                 # (adjusted R^2, subset), a heap

        def visit(bound: float, must: tuple, may: tuple) -> None:
            if len(top) == best and bound < top[0][0] - 1e-12:
                return
            if may:
                for half in sorted(opened(must, may), key=lambda b: -b[0]):
                    visit(*half)
            elif must:
                found = (adjusted(residual(must), len(must)), tuple(sorted(must)))
                heapq.heappush(top, found) if len(top) < best else heapq.heappushpop(top, found)

        for pdf in batches:
            for bound, must, may in sorted(zip(pdf["bound"], pdf["must"], pdf["may"]), key=lambda b: -b[0]):
                visit(float(bound), tuple(map(int, must)), tuple(map(int, may)))
        yield pd.DataFrame([(len(s), ",".join(features[i] for i in s), 1 - residual(s) / total, a) for a, s in top],
                           columns=["size", "features", "r2", "adj_r2"])

    spark = df.sparkSession
    table = spark.createDataFrame([(-b, list(m), list(y)) for b, m, y in sorted(heap)], "bound double, must array<int>, may array<int>")
    found = table.repartition(max(1, min(branches, spark.sparkContext.defaultParallelism))).mapInPandas(
        search, "size int, features string, r2 double, adj_r2 double")
    top = found.orderBy(F.desc("adj_r2"), "features").limit(best).toArrow()                  # ``best`` rows
    rank = list(range(1, len(top) + 1))
    return spark.createDataFrame(top.add_column(0, "rank", [rank]).select(["rank", "size", "features", "r2", "adj_r2"]),
                                 "rank int, size int, features string, r2 double, adj_r2 double")
