"""Equity model: training, evaluation and batch scoring with Spark ML.

A random-forest regressor over the 22 model inputs predicts the win share.
Training, evaluation and scoring stay distributed: Spark ML grows the trees
from partition-level statistics (no table is collected to the driver), the
metrics are column aggregates, and scoring is a column over the inputs.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, MODEL_FEATURES, TARGET, EngineConfig
from ..functions.cards import validate_hands
from .features import model_inputs, stateless_features
from .forest import DEEPEST, grow_forest, plain, scores
from .relative import join_lookup

PACKED_ROWS = 1_000_000  # from here on rows are packed for the fit; as Spark ML keeps them they take some 600 MB


def build_pipeline(cfg: EngineConfig = DEFAULT_CONFIG, features=MODEL_FEATURES, target: str = TARGET,
                   num_trees: int | None = None, seed: int = 42, bootstrap: bool = True) -> Pipeline:
    """G1: VectorAssembler + RandomForestRegressor (all inputs tried at every split; trees see a bootstrap sample each,
    or all rows)."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")
    # nodes are grown in groups whose statistics stay in a core's cache, as every row adds to a place per tree and input (they
    # are shuffled once per partition and group), and rows go down the tree again, instead of a stored node per row and
    # tree, rewritten in every pass; neither changes the model
    forest = RandomForestRegressor(featuresCol="_features", labelCol=target, predictionCol="prediction",
                                   maxDepth=cfg.max_depth, numTrees=num_trees or cfg.num_trees,
                                   featureSubsetStrategy="all", maxBins=cfg.max_bins, seed=seed, bootstrap=bootstrap,
                                   cacheNodeIds=False, maxMemoryInMB=8)
    return Pipeline(stages=[assembler, forest])


def train(df: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG, features=MODEL_FEATURES, target: str = TARGET,
          num_trees: int | None = None, bootstrap: bool = True) -> PipelineModel:
    """G1: fit on rows with a label; by Spark ML, or level by level over packed rows if there are many."""
    pipeline, known = build_pipeline(cfg, features, target, num_trees, bootstrap=bootstrap), df.filter(F.col(target).isNotNull())
    rows, low, high = known.agg(F.count(F.lit(1)), F.min(target).cast("double"), F.max(target).cast("double")).first()
    if rows < PACKED_ROWS or not math.isfinite(high - low) or cfg.max_depth > DEEPEST or not plain(known, features):
        return pipeline.fit(known)
    return grow_forest(pipeline, known, rows, low, high)


def evaluate(df: DataFrame, label: str = TARGET, prediction: str = "prediction") -> DataFrame:
    """One row (n, mse, r2) in one aggregation.

    r2 = 1 - SSE / SST with SST = n * var_pop(label); Spark's variance
    aggregate is the numerically stable (centred) one, so no second pass or
    join with the mean is needed.
    """
    y, p = F.col(label), F.col(prediction)
    sse = F.sum((y - p) * (y - p))
    n = F.count(F.lit(1))
    return df.agg(n.alias("n"), (sse / n).alias("mse"), (1.0 - sse / (F.var_pop(y) * n)).alias("r2"))


def predict(model: PipelineModel | None, df: DataFrame) -> DataFrame:
    """Add ``prediction``; an untrained model is an error."""
    if model is None:
        raise ValueError("predict needs a fitted model, got None")
    prediction = scores(model, df)
    if prediction is None:
        return model.transform(df).drop("_features")
    return df.select("*", prediction)


def batch_score(model: PipelineModel, lookup: DataFrame, requests: DataFrame, features=MODEL_FEATURES,
                keep: tuple = ()) -> tuple[DataFrame, DataFrame]:
    """Validate -> row features -> lookup join -> inputs -> predict.

    Returns (scored, rejected): scored has ``keep`` columns, the inputs and
    ``equity``; rejected holds requests that failed validation.
    """
    valid, rejected = validate_hands(requests)
    feats = join_lookup(stateless_features(valid), lookup)
    inputs = model_inputs(feats, features, keep=tuple(keep))
    scored = predict(model, inputs).withColumnRenamed("prediction", TARGET)
    return scored, rejected
