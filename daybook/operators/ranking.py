"""Feature ranking (R1-R3, R6, R8): closed forms over correlation
aggregates, one pass for all features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import rnd
from .evaluate import adjusted_r2  # noqa: F401  (R6 lives with V10)
from .profile import safe_corr


def _f_score(r: Column, n: Column) -> Column:
    r2 = r * r
    return F.try_divide(r2, F.lit(1.0) - r2) * (n - 2)


def f_scores(df: DataFrame, features: list[str], target: str, by: list[str] | None = None,
             digits: int = 6) -> DataFrame:
    """R1 (all rows) / R2 input (per group): univariate F = r^2/(1-r^2)(n-2)
    per feature, n = rows where both sides are present.  A constant feature
    has a null correlation and scores 0."""
    aggs = []
    for i, c in enumerate(features):
        both = F.col(c).isNotNull() & F.col(target).isNotNull()
        aggs += [safe_corr(c, target).alias(f"r{i}"), F.count(F.when(both, 1)).alias(f"n{i}")]
    wide = df.groupBy(*(by or [])).agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 rnd(F.coalesce(_f_score(F.col(f"r{i}"), F.col(f"n{i}")), F.lit(0.0)),
                         digits).alias("f_score"))
        for i, c in enumerate(features)]))
    return wide.select(*(by or []), rows.alias("r")).select(*(by or []), "r.*")


def f_scores_max_over_groups(df: DataFrame, features: list[str], target: str,
                             group: str, digits: int = 6) -> DataFrame:
    """R2: per-group F scores, then the maximum over groups per feature."""
    per = f_scores(df, features, target, [group], digits)
    return per.groupBy("feature").agg(F.max("f_score").alias("f_score"))


def ranked(scores: DataFrame, n: int | None = None, score: str = "f_score") -> DataFrame:
    """Ranked list with ``rank`` (1 = best, ties by name); ``n`` keeps the
    top n.  One row per feature, so the window over all rows is small."""
    out = scores.withColumn("rank", F.row_number().over(Window.orderBy(F.col(score).desc(), "feature")))
    return (out.where(F.col("rank") <= n) if n else out).orderBy("rank")


def tree_importance(spark, model, features: list[str]) -> DataFrame:
    """MLlib tree ensemble feature importances as rows."""
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(features, map(float, imp))),
                                 "feature string, importance double")
