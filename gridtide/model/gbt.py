"""Gradient-boosted trees on Spark ML: features, fit, evaluation, versions."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtide.functions import feature_columns, numeric_columns
from gridtide.schemas import FORECAST_PREFIXES, GOLD_MODELS, HISTORY_PREFIXES, LABEL, TIME_FEATURES
from gridtide.session import ensure_checkpoint_dir
from gridtide.sources.tables import append_table, read_table, table_exists

# Settings of the fitted model.
TREES, LEARNING_RATE, DEPTH, SEED = 100, 0.1, 3, 42


def model_features(df: DataFrame) -> list[str]:
    """Numeric history, forecast and time columns of a training frame, in that order."""
    named = feature_columns(df, HISTORY_PREFIXES) + feature_columns(df, FORECAST_PREFIXES) + list(TIME_FEATURES)
    return numeric_columns(df, named)


def fit_gbt(
    train: DataFrame, features: list[str] | None = None, label: str = LABEL, trees: int = TREES, depth: int = DEPTH
) -> PipelineModel:
    """Fit assembler and trees in one pipeline. The rows stay on the executors."""
    ensure_checkpoint_dir(train.sparkSession)
    inputs = features or model_features(train)
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")
    regressor = GBTRegressor(
        featuresCol="features", labelCol=label, predictionCol="prediction", lossType="squared",
        maxIter=trees, stepSize=LEARNING_RATE, maxDepth=depth, seed=SEED, checkpointInterval=10,
    )
    return Pipeline(stages=[assembler, regressor]).fit(train.select(*inputs, label))


def evaluate(scored: DataFrame, label: str = LABEL, by: list[str] | None = None) -> DataFrame:
    """n, rmse and r2 of a scored frame, overall or per group, in one pass."""
    y, p = F.col(label).cast("double"), F.col("prediction")
    rows = scored.filter(y.isNotNull() & p.isNotNull())
    squares = F.sum((y - p) * (y - p))
    spread = F.var_pop(y) * F.count(y)
    return rows.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(squares / F.count(y)).alias("rmse"),
        F.when(spread > 0, 1 - squares / spread).alias("r2"),
    )


def rmse_r2(scored: DataFrame, label: str = LABEL) -> tuple[float, float]:
    """RMSE and R² by the library evaluator."""
    def metric(name: str) -> float:
        return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=name).evaluate(scored)

    return metric("rmse"), metric("r2")


def latest_version(spark: SparkSession, table: str = GOLD_MODELS) -> int:
    """Highest registered version, 0 if there is none."""
    if not table_exists(spark, table):
        return 0
    return read_table(spark, table).agg(F.max("version")).head()[0] or 0


def save_model(
    spark: SparkSession, model: PipelineModel, folder: str, metrics: DataFrame, table: str = GOLD_MODELS
) -> int:
    """Write the model and register it under the next version with its metrics (one row).

    The metrics are computed first, the model goes to a folder of its own, and the
    row that makes it a version comes last: a run that fails in between leaves a
    folder nobody refers to, and does not stand in the way of the next one.
    """
    values = metrics.head()
    path = f"{folder.rstrip('/')}/model-{uuid.uuid4()}"
    model.write().save(path)
    version = latest_version(spark, table) + 1
    inputs, trees = model.stages[0].getInputCols(), model.stages[-1]
    row = spark.createDataFrame([values], metrics.schema).select(
        F.lit(version).alias("version"),
        F.lit(path).alias("path"),
        F.lit(trees.getNumTrees).alias("trees"),
        F.lit(trees.getOrDefault("maxDepth")).alias("depth"),
        F.array(*[F.lit(c) for c in inputs]).alias("inputs"),
        F.current_timestamp().alias("created_at"),
        *metrics.columns,
    )
    append_table(row, table)
    return version


def load_latest(spark: SparkSession, table: str = GOLD_MODELS) -> tuple[PipelineModel, int]:
    """The model with the highest version."""
    version = latest_version(spark, table)
    if not version:
        raise LookupError("no model is registered")
    path = read_table(spark, table).filter(F.col("version") == version).select("path").head()[0]
    return PipelineModel.load(path), version
