"""MLlib forecasters and the feature pipeline (F43, M3-M6, M14, M15, M17,
S15).  Training runs distributed in MLlib; model outputs are not
reproducible across engines (random forests, boosting), so their queries
carry a rows-only check and unit tests bound the error."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def feature_pipeline(numeric: list[str], binary: list[str], label: str, regressor,
                     scale: bool = True) -> Pipeline:
    """assemble numeric columns (optionally standardised), pass
    binary / one-hot columns through, then the regressor.  One-hot columns
    come from ``functions.encode.one_hot`` with a fixed level list, so every
    split gets the same vector layout."""
    stages = []
    if scale and numeric:
        stages.append(VectorAssembler(inputCols=numeric, outputCol="__num", handleInvalid="keep"))
        stages.append(StandardScaler(inputCol="__num", outputCol="__num_s", withMean=True,
                                     withStd=True))
        inputs = ["__num_s"] + binary
    else:
        inputs = numeric + binary
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    regressor.setFeaturesCol("features").setLabelCol(label).setPredictionCol("pred")
    stages.append(regressor)
    return Pipeline(stages=stages)


def ols(label: str) -> LinearRegression:
    """M3-M6: exact least squares (normal equations, no penalty)."""
    return LinearRegression(labelCol=label, regParam=0.0, elasticNetParam=0.0, solver="normal")


def random_forest(label: str, seed: int = 42, trees: int = 300) -> RandomForestRegressor:
    """300 trees, depth 8, at least 5 rows per leaf, sqrt features."""
    return RandomForestRegressor(labelCol=label, numTrees=trees, maxDepth=8, minInstancesPerNode=5,
                                 featureSubsetStrategy="sqrt", seed=seed)


def boosted(label: str, validation_col: str | None = None, seed: int = 42,
            max_iter: int = 100) -> GBTRegressor:
    """Non-linear pooled regressor with validation-based early stop
    (what the reference's neural models deliver, re-aimed to MLlib)."""
    g = GBTRegressor(labelCol=label, maxIter=max_iter, maxDepth=5, stepSize=0.1, seed=seed,
                     validationTol=0.01)
    if validation_col:
        g = g.setValidationIndicatorCol(validation_col)
    return g


def save_model(model: PipelineModel, path: str) -> None:
    """Persist a fitted pipeline (scaler, encoder layout, regressor)."""
    model.write().overwrite().save(path)


class ModelMismatch(ValueError):
    """A stored model was fitted on other columns or other rows."""


def fold_fingerprint(rows: DataFrame, features: list[str]) -> dict:
    """Schema of the features, and count, sum and xor of the rows' hashes: the
    same for the same rows in any order."""
    kinds = dict(rows.dtypes)
    h = F.xxhash64(*features)
    row = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("s"), F.bit_xor(h).alias("x")).first()
    return {"columns": [f"{c} {kinds[c]}" for c in features], "n": int(row["n"]), "sum": row["s"], "xor": row["x"]}


def save_checked(model: PipelineModel, path: str, rows: DataFrame, features: list[str]) -> None:
    """The fitted pipeline in ``path``/model, and what it was fitted on in
    ``path``/fold, both by Spark's writers."""
    save_model(model, f"{path}/model")
    spark = rows.sparkSession
    spark.createDataFrame([(json.dumps(fold_fingerprint(rows, features), sort_keys=True),)], "fold string").coalesce(1).write.text(f"{path}/fold")


def load_checked(path: str, rows: DataFrame, features: list[str]) -> PipelineModel:
    """The pipeline stored by ``save_checked``; ``ModelMismatch`` if ``rows`` are
    not the ones it was fitted on."""
    stored = json.loads(rows.sparkSession.read.text(f"{path}/fold").first()[0])
    found = fold_fingerprint(rows, features)
    differs = [k for k in stored if stored[k] != found[k]]
    if differs:
        raise ModelMismatch(f"{path}: {', '.join(differs)}")
    return load_model(f"{path}/model")


def permutation_losses(model: PipelineModel, rows: DataFrame, features: list[str], label: str, keys: list[str],
                       seed: int = 7) -> DataFrame:
    """``(feature, mse, shuffled_mse)``: the model's error on ``rows``, and
    with one feature's values dealt out anew among them.

    Every row appears once per feature, its value taken from the row whose place
    in an order by seeded hash equals its own place by key, so one pass scores
    all features.  ``keys`` name a row.
    """
    place = Window.partitionBy("feature").orderBy(*[f"_r.{k}" for k in keys])
    mixed = Window.partitionBy("feature").orderBy(F.xxhash64(F.lit(seed), "feature", *[f"_r.{k}" for k in keys]), *[f"_r.{k}" for k in keys])
    value = F.coalesce(*[F.when(F.col("feature") == c, F.col(f"_r.{c}").cast("double")) for c in features])
    copies = rows.select(F.struct(*dict.fromkeys([*keys, *features, label])).alias("_r"),
                         F.explode(F.array(*map(F.lit, features))).alias("feature"))
    at = copies.select("_r", "feature", F.row_number().over(place).alias("_at"))
    dealt = copies.select("feature", F.row_number().over(mixed).alias("_at"), value.alias("_v"))
    shuffled = at.join(dealt, ["feature", "_at"]).select(
        "feature", F.col(f"_r.{label}").alias(label),
        *[F.when(F.col("feature") == c, F.col("_v")).otherwise(F.col(f"_r.{c}")).cast("double").alias(c) for c in features])
    error = F.avg((F.col(label) - F.col("pred")) ** 2)
    plain = model.transform(rows).agg(error.alias("mse"))
    return (model.transform(shuffled).groupBy("feature").agg(error.alias("shuffled_mse"))
            .withColumn("mse", plain.scalar()).select("feature", "mse", "shuffled_mse"))


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fit_score(pipeline: Pipeline, train: DataFrame, rows: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """Fit on train, score ``rows`` (M17: same feature code for both, M18)."""
    model = pipeline.fit(train)
    return model, model.transform(rows)
