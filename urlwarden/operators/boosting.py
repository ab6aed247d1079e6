"""Boosting round by round, which stops when the validation rows say so.

Each round fits one regression tree to the gradient of the logarithmic loss at the
margins so far, which are a column beside the vectors. Every few rounds the column
is checkpointed, so that neither the plan nor what a lost executor costs grows with
the rounds. Nothing is fitted beyond the round at which patience ends.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlwarden.operators.metrics import roc_auc
from urlwarden.session import checkpoint_dir

CHECKPOINT_ROUNDS = 10


@dataclass
class Boosted:
    model: GBTClassificationModel       # up to the best round
    fitted: int                         # rounds that were fitted
    best_iter: int                      # from 0; the last round without validation
    curve: list[tuple[int, float | None]] = field(default_factory=list)  # iter, AUC of the validation rows


def gradient(margin: Column, label: Column) -> Column:
    """Of twice the logarithmic loss, downwards; ``label`` is -1 or 1."""
    return 4 * label / (1 + F.exp(2 * label * margin))


def model_of(trees: list[DecisionTreeRegressionModel], weights: list[float], features: int, uid: str = "boosted") -> GBTClassificationModel:
    """A classification model of fitted trees."""
    context = SparkContext._active_spark_context
    java = context._gateway.new_array(context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    scales = context._gateway.new_array(context._jvm.double, len(trees))
    for k, (tree, weight) in enumerate(zip(trees, weights)):
        java[k], scales[k] = tree._java_obj, weight
    model = context._jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"{uid}_{len(trees)}", java, scales, features, 2)
    return GBTClassificationModel(model).setFeaturesCol("features_vector")


def boost(
    frame: DataFrame, iterations: int, learning_rate: float, depth: int, max_bins: int = 64, subsample: float = 1.0, seed: int = 127,
    validation: str | None = None, patience: int = 0, on_round: Callable[[int, float | None], None] | None = None,
) -> Boosted:
    """Fit on ``features_vector, label``. Rows with ``validation`` true are not learned from: their AUC after each round
    picks the best one, and ``patience`` rounds without a better one end the fitting. ``on_round(iter, auc)`` is told of each."""
    checkpoint_dir(frame.sparkSession)
    held = F.coalesce(F.col(validation), F.lit(False)) if validation else F.lit(False)
    state = frame.where(F.col("label").isNotNull()).select(
        "features_vector", (2 * F.col("label") - 1).cast("double").alias("y"), held.alias("held"), F.lit(0.0).alias("margin")).checkpoint()
    trees: list[DecisionTreeRegressionModel] = []
    weights: list[float] = []
    curve: list[tuple[int, float | None]] = []
    best_iter, best_auc = -1, -1.0
    for k in range(iterations):
        target = F.col("y") if k == 0 else gradient(F.col("margin"), F.col("y"))
        learned = state.where("NOT held").withColumn("target", target)
        if subsample < 1:
            learned = learned.sample(False, subsample, seed + k)
        tree = DecisionTreeRegressor(
            featuresCol="features_vector", labelCol="target", predictionCol="step", maxDepth=depth, maxBins=max_bins,
            seed=seed, cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=512).fit(learned)
        trees.append(tree)
        weights.append(1.0 if k == 0 else learning_rate)
        state = tree.transform(state).withColumn("margin", F.col("margin") + weights[-1] * F.col("step")).drop("step")
        if (k + 1) % CHECKPOINT_ROUNDS == 0:
            state = state.checkpoint()
        if validation:
            judged = state.where("held").select(((F.col("y") + 1) / 2).cast("int").alias("label"), F.col("margin").alias("score"))
            auc = roc_auc(judged).first()["auc"]
            curve.append((k, auc))
            if auc is not None and auc > best_auc:
                best_iter, best_auc = k, auc
        if on_round:
            on_round(k, curve[-1][1] if curve else None)
        if validation and patience and best_iter >= 0 and k - best_iter >= patience:
            break
    best = best_iter if best_iter >= 0 else len(trees) - 1
    features = trees[0].numFeatures if trees else 0
    return Boosted(model_of(trees[:best + 1], weights[:best + 1], features), len(trees), best, curve)
