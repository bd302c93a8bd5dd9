"""Demand models: MLlib boosted trees, and closed-form lines per category.

Both are used through the same two calls: ``attach`` joins what the model needs to each row
once, ``predict`` adds a ``prediction`` column without moving any data.
"""

from __future__ import annotations

import json
from abc import ABC, abstractmethod
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from weekloom.functions.moments import line
from weekloom.operators.features import CATEGORY, WEEK
from weekloom.session import checkpointed

TARGET = "units"
NOT_FEATURES = (WEEK, "split", TARGET, CATEGORY)
SENTINEL = -1.0
ROWS_PER_PARTITION = 50_000


class Predictor(Protocol):
    def attach(self, df: DataFrame) -> DataFrame: ...

    def predict(self, df: DataFrame) -> DataFrame: ...


class ExpressionPredictor(ABC):
    """A predictor that is one column expression over the features."""

    def attach(self, df: DataFrame) -> DataFrame:
        return df

    @abstractmethod
    def expression(self, features: Mapping[str, Column]) -> Column: ...

    def predict(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.expression({c: F.col(c) for c in df.columns}))


@dataclass
class TreeParams:
    """The boosting settings of the model that sees current revenue."""

    max_iter: int = 400
    step_size: float = 0.05
    max_depth: int = 6
    subsampling_rate: float = 0.8
    feature_subset: str = "0.8"
    seed: int = 42


# The settings of the model without current revenue.
NO_LEAK_PARAMS = TreeParams(max_iter=500, subsampling_rate=0.9, feature_subset="0.9")


@dataclass
class DemandModel:
    pipeline: PipelineModel
    features: list[str] = field(default_factory=list)

    def attach(self, df: DataFrame) -> DataFrame:
        return df

    def predict(self, df: DataFrame) -> DataFrame:
        helpers = {"category_index", "category_vector", "features"} | {f"{c}__{k}" for c in self.features for k in ("value", "absent")}
        scored = self.pipeline.transform(df)
        return scored.drop(*[c for c in helpers if c not in df.columns])

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        spark = SparkSession.getActiveSession()
        text = spark.createDataFrame([(json.dumps(self.features),)], "features string")
        text.write.mode("overwrite").text(f"{path}/features")

    @staticmethod
    def load(path: str) -> DemandModel:
        spark = SparkSession.getActiveSession()
        features = json.loads(spark.read.text(f"{path}/features").head().value)
        return DemandModel(PipelineModel.load(f"{path}/pipeline"), features)


def feature_columns(df: DataFrame, drop_current_revenue: bool = True) -> list[str]:
    """Numeric columns the model may see; kept with the model, never derived again."""
    dropped = set(NOT_FEATURES) | ({"revenue"} if drop_current_revenue else set())
    return [f.name for f in df.schema.fields if f.name not in dropped and isinstance(f.dataType, NumericType)]


def train_demand_model(
    table: DataFrame, drop_current_revenue: bool = True, params: TreeParams = NO_LEAK_PARAMS
) -> DemandModel:
    """Fit boosted trees on the rows marked "train".

    MLlib vectors cannot hold nulls, so each feature enters as value-or-sentinel plus an
    absence indicator; both are computed inside the saved pipeline.
    """
    sizes = table.agg(
        F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "valid").alias("valid")
    ).head()
    if not sizes.train or not sizes.valid:
        raise ValueError(f"both splits need rows: train={sizes.train}, valid={sizes.valid}")
    features = feature_columns(table, drop_current_revenue)
    values = ", ".join(f"coalesce(double({c}), {SENTINEL}D) AS {c}__value" for c in features)
    absent = ", ".join(f"double({c} IS NULL) AS {c}__absent" for c in features)
    inputs = ["category_vector"] + [f"{c}__{k}" for c in features for k in ("value", "absent")]
    stages = [
        SQLTransformer(statement=f"SELECT *, {values}, {absent} FROM __THIS__"),
        StringIndexer(
            inputCol=CATEGORY, outputCol="category_index", handleInvalid="keep", stringOrderType="alphabetAsc"
        ),
        OneHotEncoder(inputCol="category_index", outputCol="category_vector", handleInvalid="keep", dropLast=False),
        VectorAssembler(inputCols=inputs, outputCol="features"),
    ]
    trees = GBTRegressor(
        labelCol=TARGET,
        maxIter=params.max_iter,
        stepSize=params.step_size,
        maxDepth=params.max_depth,
        subsamplingRate=params.subsampling_rate,
        featureSubsetStrategy=params.feature_subset,
        seed=params.seed,
        checkpointInterval=10,
        cacheNodeIds=False,
    )
    # Every level of every tree is a job over these rows, so they lie in as few partitions as their number needs,
    # and come from a checkpoint: else each of these jobs takes the whole plan of the vectors along.
    train = table.where(F.col("split") == "train").select(CATEGORY, TARGET, *features)
    train = train.repartition(1 + sizes.train // ROWS_PER_PARTITION)
    inputs_model = Pipeline(stages=stages).fit(train)
    with checkpointed(inputs_model.transform(train).select(TARGET, "features")) as vectors:
        fitted = trees.fit(vectors)
    return DemandModel(PipelineModel(stages=[*inputs_model.stages, fitted]), features)


def fit_linear_by_group(df: DataFrame, y: str, x: str, group: str = CATEGORY) -> DataFrame:
    """Least-squares line per group; b=1, a=0 for fewer than two points or constant ``x``."""
    fit = line(y, x)
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(group).agg(
        F.coalesce(fit.intercept, F.lit(0.0)).alias("a"),
        F.coalesce(fit.slope, F.lit(1.0)).alias("b"),
    )


@dataclass
class LinearPredictor(ExpressionPredictor):
    """Line per category over one feature; categories without a line predict the feature."""

    params: DataFrame
    x: str
    group: str = CATEGORY

    def attach(self, df: DataFrame) -> DataFrame:
        lines = self.params.select(self.group, F.col("a").alias("_a"), F.col("b").alias("_b"))
        joined = df.join(lines, self.group, "left")
        return joined.withColumns({"_a": F.coalesce("_a", F.lit(0.0)), "_b": F.coalesce("_b", F.lit(1.0))})

    def expression(self, features: Mapping[str, Column]) -> Column:
        return F.col("_a") + F.col("_b") * features[self.x]


@dataclass
class RollingMeanPredictor(ExpressionPredictor):
    """Next units = mean of the last four known weeks."""

    x: str = "units_roll4"

    def expression(self, features: Mapping[str, Column]) -> Column:
        return F.coalesce(features[self.x], F.lit(0.0))


def score(model: Predictor, df: DataFrame) -> DataFrame:
    return model.predict(model.attach(df))


def fit_score_linear(df: DataFrame, y: str, x: str, group: str = CATEGORY) -> DataFrame:
    """Fit each group's line on its "train" rows and score all its rows in one window.

    Same numbers as fit_linear_by_group followed by score, without a second read of ``df``.
    Meant for series (bounded rows per group), not for raw facts.
    """
    w = W.partitionBy(group)
    usable = (F.col("split") == "train") & F.col(x).isNotNull() & F.col(y).isNotNull()
    ty, tx = F.when(usable, F.col(y)), F.when(usable, F.col(x))
    fit = line(ty, tx, over=w)
    lines = df.withColumns({"a": F.coalesce(fit.intercept, F.lit(0.0)), "b": F.coalesce(fit.slope, F.lit(1.0))})
    return lines.withColumn("prediction", F.col("a") + F.col("b") * F.col(x)).drop("a", "b")


def valid_predictions(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("split") == "valid").select(
        WEEK, CATEGORY, F.col(TARGET).alias("actual_units"), F.col("prediction").alias("pred_units")
    )
