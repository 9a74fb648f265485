"""Distributed training and scoring with pyspark.ml."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import date

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlake.functions.ordering import row_numbers
from merchlake.functions.scalars import money
from merchlake.operators.features import FEATURES, horizon_features

# The churn model's inputs. `days_since_last_order` also makes
# the label, so the model sees its own target; pass other features to avoid it.
CHURN_FEATURES = ["total_orders", "total_spend", "avg_order_value", "days_since_last_order", "total_returns"]

# Training rows that one task takes before there are more tasks than cores.
ROWS_PER_TASK = 500_000


def churn_labels(metrics: DataFrame, days: int = 90) -> DataFrame:
    """1 when the last order is more than `days` old; no order at all gives 0."""
    return metrics.withColumn("is_churned", F.when(F.col("days_since_last_order") > days, 1).otherwise(0))


def class_weight(labelled: DataFrame, label: str = "is_churned") -> DataFrame:
    """Negatives per positive, the weight of the rare class."""
    positive = F.sum(F.when(F.col(label) == 1, 1).otherwise(0))
    negative = F.sum(F.when(F.col(label) == 0, 1).otherwise(0))
    return labelled.agg((negative / F.greatest(positive, F.lit(1))).alias("pos_weight"))


def hash_split(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Mark a fixed share of keys as test rows.

    The hash of the key decides, independent of class and partitioning, so a
    re-run marks the same rows. The share is met on average only; see
    stratified_split for an exact one in every class.
    """
    slot = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(10_000))
    return df.withColumn("is_test", slot < int(test_share * 10_000))


def stratified_split(df: DataFrame, key: str, label: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Mark the share of each class, to the nearest row, as test rows.

    Inside a class the rows with the least hash of the (unique) key are taken. The
    ranks are computed range by range, so a class may be of any size. With one
    class only this is a plain split.
    """
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))
    ranked = row_numbers(df.withColumn("_order", order), [label], ["_order", key], name="_rn", total="_n")
    wanted = F.floor(F.col("_n") * F.lit(test_share) + F.lit(0.5))
    return ranked.withColumn("is_test", F.col("_rn") <= wanted).drop("_order", "_rn", "_n")


def for_training(rows: DataFrame, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """All rows in as many partitions as the session has cores, or more where tasks would hold over `per_task` rows.

    Boosted trees run a job per level of each tree, a thousand in all, whose time is that of starting their tasks.
    """
    wanted = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // per_task))
    return rows.coalesce(wanted)


def train_churn(
    metrics: DataFrame,
    features: Sequence[str] = CHURN_FEATURES,
    label: str = "is_churned",
    trees: int = 200,
    rate: float = 0.05,
    depth: int = 5,
    seed: int = 42,
) -> PipelineModel:
    """Boosted trees on rows without gaps, the positive class weighted up."""
    rows = metrics.select(*features, label).dropna()
    weight = class_weight(rows, label).first()["pos_weight"] or 1.0
    weighted = rows.withColumn("_weight", F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="_features"),
            GBTClassifier(
                labelCol=label,
                featuresCol="_features",
                weightCol="_weight",
                maxIter=trees,
                stepSize=rate,
                maxDepth=depth,
                seed=seed,
            ),
        ]
    ).fit(for_training(weighted))


def score_churn(model: PipelineModel, rows: DataFrame, features: Sequence[str] = CHURN_FEATURES) -> DataFrame:
    """Rows with `churn_probability` and `is_predicted_churn`."""
    scored = model.transform(rows.dropna(subset=list(features)))
    probability = vector_to_array("probability")[1]
    return scored.select(
        *rows.columns,
        probability.alias("churn_probability"),
        (probability > 0.5).cast("int").alias("is_predicted_churn"),
    )


class NotEnoughRows(ValueError):
    """Too few feature rows to train on."""


def train_forecast(
    features: DataFrame,
    target: str = "net_revenue",
    columns: Sequence[str] = FEATURES,
    trees: int = 300,
    rate: float = 0.05,
    depth: int = 6,
    subsample: float = 0.8,
    min_rows: int = 5,
    seed: int = 42,
) -> PipelineModel:
    if len(features.select(F.lit(1)).head(min_rows)) < min_rows:
        raise NotEnoughRows(f"at least {min_rows} feature rows are needed")
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(columns), outputCol="_features"),
            GBTRegressor(
                labelCol=target,
                featuresCol="_features",
                predictionCol="predicted_revenue",
                maxIter=trees,
                stepSize=rate,
                maxDepth=depth,
                subsamplingRate=subsample,
                seed=seed,
            ),
        ]
    ).fit(features)


def score_forecast(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).drop("_features")


def forecast(model: PipelineModel, daily: DataFrame, as_of: date, horizon: int = 7) -> DataFrame:
    """Predicted revenue per day of the horizon."""
    scored = score_forecast(model, horizon_features(daily, as_of, horizon))
    return scored.select("forecast_date", money("predicted_revenue").alias("predicted_revenue"))


def forecast_total(prediction: DataFrame) -> DataFrame:
    return prediction.agg(
        F.count(F.lit(1)).alias("horizon_days"), money(F.sum("predicted_revenue")).alias("total_revenue")
    )


def score_with(rows: DataFrame, predict: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply a vectorised model to Arrow batches on the executors; `predict` keeps the row count."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield predict(batch)

    return rows.mapInPandas(run, schema)
