"""Forecasters (M1-M8, M15-M18) as Spark jobs.

Fitting is an aggregate (group means, Gram matrices) or MLlib; only the
fitted state (a few numbers per group) is small enough to be broadcast
back, and it is size-checked before that.  Scoring is a join or a column
expression, so it runs wherever the rows are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sizing import checked_broadcast


def fit_key_means(train: DataFrame, keys: list[str], value: str, name: str = "pred") -> DataFrame:
    """M1 fit: mean of ``value`` per key (e.g. weekday x group)."""
    return train.groupBy(*keys).agg(F.avg(value).alias(name))


def score_lookup(rows: DataFrame, model: DataFrame, keys: list[str],
                 how: str = "inner") -> DataFrame:
    """M1 score / J3: join the key means to the rows on the composite key.
    The actual travels with the row (reference defect D22).  The model has
    one row per key; it is broadcast after a size check."""
    return rows.join(checked_broadcast(model), keys, how)


def weekday_mean_forecast(train: DataFrame, rows: DataFrame, group: str = "grp",
                          day: str = "day", value: str = "units") -> DataFrame:
    """M1/M8: weekday x group mean forecaster; rows get ``pred``."""
    tr = train.withColumn("weekday", F.weekday(day))
    model = fit_key_means(tr, ["weekday", group], value)
    return score_lookup(rows.withColumn("weekday", F.weekday(day)), model, ["weekday", group])


# Coefficients of the reference's hand-set linear scorer
# (intercept, weekend, summer, and the group terms for groups 2, 3, 5).
FIXED_LINEAR = {"intercept": 85.08, "weekend": 23.87, "summer": 69.39,
                "group": {2: 306.89, 3: 60.44, 5: 177.19}}


def fixed_linear_score(day: Column, grp: Column, coef: dict = FIXED_LINEAR) -> Column:
    """M2: one SQL expression: intercept + weekend + summer + group term.
    Summer is the quarter-bin season (months 7-9, F13)."""
    g = None
    for k, v in coef["group"].items():
        g = F.when(grp == k, F.lit(v)) if g is None else g.when(grp == k, F.lit(v))
    g = g.otherwise(F.lit(0.0))
    weekend = (F.weekday(day) >= 5).cast("double")
    summer = F.month(day).isin(7, 8, 9).cast("double")
    return F.lit(coef["intercept"]) + coef["weekend"] * weekend + coef["summer"] * summer + g
