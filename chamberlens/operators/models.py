"""Linear, forest and boosted regressions on Spark ML."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from chamberlens.functions.columns import quoted, rewritten, with_facts
from chamberlens.operators.forest import DeepForest

FEATURES = "features"
# Spark ML grows trees to at most this depth; "unlimited" is mapped to it there.
DEEPEST = 30


def assembler(columns: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=FEATURES)


def standardize(train: DataFrame, columns: list[str], *others: DataFrame) -> list[DataFrame]:
    """Centre and scale ``train`` and the other frames by the training rows' mean and
    population deviation. A constant column is only centred.

    The training moments are one scalar subquery row.
    """
    moments = train.selectExpr(
        *[f"avg({quoted(c)}) AS mean_{i}" for i, c in enumerate(columns)],
        *[f"CASE WHEN stddev_pop({quoted(c)}) = 0 THEN 1.0D ELSE stddev_pop({quoted(c)}) END AS dev_{i}" for i, c in enumerate(columns)],
    )
    scaled = {c: f"({quoted(c)} - _facts.mean_{i}) / _facts.dev_{i}" for i, c in enumerate(columns)}
    return [rewritten(with_facts(frame, moments), scaled).drop("_facts") for frame in (train, *others)]


def linear_estimator(target: str = "quality", **params) -> LinearRegression:
    """Plain least squares with intercept, solved in one pass by the normal equations."""
    return LinearRegression(
        featuresCol=FEATURES, labelCol=target, predictionCol="yhat", solver="normal", regParam=0.0, **params
    )


def forest_estimator(
    target: str = "quality",
    trees: int = 200,
    depth: int | None = None,
    min_leaf: int = 2,
    features: str = "all",
    bootstrap: bool = True,
    seed: int = 42,
    bins: int = 256,
    **params,
) -> RandomForestRegressor:
    """Random forest; ``depth=None`` means as deep as Spark ML allows."""
    return RandomForestRegressor(
        featuresCol=FEATURES,
        labelCol=target,
        predictionCol="yhat",
        numTrees=trees,
        maxDepth=DEEPEST if depth is None else depth,
        minInstancesPerNode=min_leaf,
        featureSubsetStrategy=features,
        bootstrap=bootstrap,
        maxBins=bins,
        seed=seed,
        **params,
    )


def deep_forest_estimator(target: str = "quality", trees: int = 200, min_leaf: int = 2, **params) -> DeepForest:
    """Random forest without a depth limit, with an exact least node size to split."""
    return DeepForest(featuresCol=FEATURES, labelCol=target, predictionCol="yhat", numTrees=trees, minLeaf=min_leaf, **params)


def boost_estimator(
    target: str = "quality",
    rounds: int = 300,
    rate: float = 0.05,
    depth: int = 5,
    subsample: float = 0.8,
    colsample: float = 0.8,
    seed: int = 42,
    **params,
) -> GBTRegressor:
    """Gradient-boosted trees without penalties; columns are sampled per node here.
    ``boost.RegularizedBoosting`` has the penalised form with columns per tree."""
    return GBTRegressor(
        featuresCol=FEATURES,
        labelCol=target,
        predictionCol="yhat",
        maxIter=rounds,
        stepSize=rate,
        maxDepth=depth,
        subsamplingRate=subsample,
        featureSubsetStrategy=str(colsample),
        seed=seed,
        **params,
    )


def fit(estimator, train: DataFrame, columns: list[str], target: str = "quality") -> PipelineModel:
    """Assemble the features and fit; only features and target enter the fit."""
    stage = assembler(columns)
    return PipelineModel([stage, estimator.fit(stage.transform(train.select(*columns, target)))])


def predict(model: Transformer, df: DataFrame, key: str = "date_time", target: str = "quality") -> DataFrame:
    """(key, y, yhat) of the scored rows."""
    return model.transform(df).select(key, F.col(target).cast("double").alias("y"), "yhat")
