"""Training, choosing and applying boosted trees."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlwarden.functions.vocab import BIGINT_FEATURES, DOUBLE_FEATURES, FEATURE_NAMES
from urlwarden.operators.boosting import boost, model_of
from urlwarden.operators.cascade import Scorer
from urlwarden.operators.metrics import binary_metrics, roc_auc
from urlwarden.operators.scaling import SCALED, moments, scaler
from urlwarden.operators.splits import stratified_holdout, stratified_kfold
from urlwarden.session import checkpoint_dir, stored

# The tuned settings of the published model.
PUBLISHED_PARAMS = {
    "iterations": 2481, "learning_rate": 0.04931391502294503, "depth": 10,
    "random_seed": 127, "early_stopping_rounds": 100,
}
TEST_FRACTION, FOLDS, SEED = 0.2, 5, 127
ROUNDED = "f32_"  # before the names of columns rounded to 32 bits
FIT_ROWS = 200_000  # rows of a task that fits: their bins stay in memory


@dataclass(frozen=True)
class GbtParams:
    """Settings with a counterpart in Spark ML; the published values unless said
    otherwise. Trees are fitted one after the other, so pass fewer rounds for a
    quick look. ``early_stopping_rounds`` ends the fitting that many rounds after
    the best one on the validation rows and keeps the model up to that; 0 fits and
    keeps all rounds."""

    iterations: int = PUBLISHED_PARAMS["iterations"]
    learning_rate: float = PUBLISHED_PARAMS["learning_rate"]
    depth: int = PUBLISHED_PARAMS["depth"]
    early_stopping_rounds: int = PUBLISHED_PARAMS["early_stopping_rounds"]
    max_bins: int = 64
    subsample: float = 1.0
    min_gain: float = 0.0
    seed: int = PUBLISHED_PARAMS["random_seed"]


def as_float32(df: DataFrame) -> DataFrame:
    """Round the wide columns to 32-bit floats; the others fit exactly."""
    return df.withColumns({n: F.col(n).cast("float") for n in sorted(DOUBLE_FEATURES | BIGINT_FEATURES)})


def feature_stages(scaling: DataFrame | None = None) -> list[Transformer]:
    """Pipeline stages that add ``features_vector`` in contract order, at 32-bit
    precision. Rounded columns go beside the given ones, which stay as they are.
    With the ``moments`` of the features, a stage scales them by these; without,
    the vector holds the features themselves."""
    wide = sorted(DOUBLE_FEATURES | BIGINT_FEATURES)
    rounded = ", ".join(f"CAST({n} AS FLOAT) AS {ROUNDED}{n}" for n in wide)
    inputs = {n: ROUNDED + n if n in wide else n for n in FEATURE_NAMES}
    stages: list[Transformer] = [SQLTransformer(statement=f"SELECT *, {rounded} FROM __THIS__")]
    if scaling is not None:
        stages.append(scaler(scaling, inputs))
        inputs = {n: SCALED + n for n in FEATURE_NAMES}
    return [*stages, VectorAssembler(inputCols=list(inputs.values()), outputCol="features_vector", handleInvalid="keep")]


def feature_vector(df: DataFrame, scaling: DataFrame | None = None) -> DataFrame:
    """Add ``features_vector`` in contract order, at 32-bit precision, scaled by moments if they are given."""
    return PipelineModel(feature_stages(scaling)).transform(df).select(*df.columns, "features_vector")


def feature_array(df: DataFrame) -> DataFrame:
    """Add ``vector ARRAY<FLOAT>`` in contract order; null for rejected rows."""
    values = F.array(*(F.col(n).cast("float") for n in FEATURE_NAMES))
    return df.withColumn("vector", F.when(F.col(FEATURE_NAMES[0]).isNotNull(), values))


def fit_parts(frame: DataFrame) -> DataFrame:
    """``frame`` in parts of ``FIT_ROWS``. Stored vectors are so much smaller than in memory that a part of a file would
    hold too many; those few that all cores share stay as they are."""
    rows = frame.count()
    if rows <= FIT_ROWS * frame.sparkSession.sparkContext.defaultParallelism:
        return frame
    return frame.withColumn("__row", F.monotonically_increasing_id()).repartition(-(-rows // FIT_ROWS), "__row").drop("__row")


def fit_gbt(frame: DataFrame, params: GbtParams = GbtParams(), validation: str | None = None) -> GBTClassificationModel:
    """Fit on ``features_vector, label``; rows with ``validation`` true only
    decide where to stop. With patience, no round beyond is fitted."""
    checkpoint_dir(frame.sparkSession)
    if validation and params.early_stopping_rounds and params.min_gain <= 0:
        return boost(
            frame, params.iterations, params.learning_rate, params.depth, params.max_bins, params.subsample, params.seed,
            validation, params.early_stopping_rounds).model
    classifier = GBTClassifier(
        featuresCol="features_vector", labelCol="label", maxIter=params.iterations,
        stepSize=params.learning_rate, maxDepth=params.depth, maxBins=params.max_bins,
        subsamplingRate=params.subsample, seed=params.seed, validationTol=params.min_gain,
        checkpointInterval=10, cacheNodeIds=True, maxMemoryInMB=512,
    )
    if not validation:
        return classifier.fit(fit_parts(frame))
    if params.min_gain > 0:
        return classifier.setValidationIndicatorCol(validation).fit(fit_parts(frame))
    return classifier.fit(fit_parts(frame.where(~F.col(validation))))


def truncated(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model after its first ``rounds`` trees."""
    if rounds >= model.getNumTrees:
        return model
    return model_of(model.trees[:rounds], model.treeWeights[:rounds], model.numFeatures, model.uid)


def score(df: DataFrame, model: Transformer) -> DataFrame:
    """Add ``prediction, probability_phishing, probability_legitimate``."""
    if "features_vector" not in df.columns and not isinstance(model, PipelineModel):
        df = feature_vector(df)
    given = [c for c in df.columns if c != "features_vector"]
    probability = vector_to_array(F.col("probability"))
    return (
        model.transform(df)
        .select(*given, F.col("prediction").cast("int").alias("prediction"), probability.alias("__p"))
        .select(*given, "prediction", F.get("__p", F.lit(1)).alias("probability_phishing"),
                F.get("__p", F.lit(0)).alias("probability_legitimate"))
    )


def ml_scorer(model: Transformer) -> Scorer:
    return lambda features: score(features, model)


@dataclass
class KFoldResult:
    aucs: DataFrame                 # fold INT (from 1), auc DOUBLE
    best_fold: int
    best_auc: float
    best_model: GBTClassificationModel
    models: list[GBTClassificationModel] = field(default_factory=list)


def kfold_train(frame: DataFrame, params: GbtParams = GbtParams(), folds: int = FOLDS) -> KFoldResult:
    """One model per fold of ``features_vector, label, fold``; the best by AUC
    on its own validation fold is kept as it is, without a refit."""
    spark = frame.sparkSession
    scores, models = [], []
    best_fold, best_auc = -1, 0.0
    for fold in range(folds):
        flagged = frame.withColumn("is_validation", F.col("fold") == fold)
        model = fit_gbt(flagged, params, "is_validation")
        held_out = score(frame.where(F.col("fold") == fold), model)
        auc = roc_auc(held_out, "label", "probability_phishing").first()["auc"]
        models.append(model)
        scores.append((fold + 1, auc))
        if auc is not None and auc > best_auc:
            best_fold, best_auc = fold + 1, auc
    if best_fold < 0:
        raise ValueError("no fold has both classes")
    aucs = spark.createDataFrame(scores, "fold int, auc double")
    return KFoldResult(aucs, best_fold, best_auc, models[best_fold - 1], models)


def top_features(weights: DataFrame, top_n: int = 20) -> DataFrame:
    """The ``top_n`` rows of ``feature, importance``, ties by name."""
    return weights.orderBy(F.desc("importance"), "feature").limit(top_n)


def select_best_fold(aucs: DataFrame) -> DataFrame:
    """Highest AUC above zero; the first fold wins ties."""
    return aucs.where(F.col("auc") > 0).orderBy(F.desc("auc"), "fold").limit(1)


def feature_importance(model: GBTClassificationModel, spark, top_n: int = 20) -> DataFrame:
    """The ``top_n`` features by importance; the model holds 73 numbers."""
    rows = [(name, float(model.featureImportances[i])) for i, name in enumerate(FEATURE_NAMES)]
    return top_features(spark.createDataFrame(rows, "feature string, importance double"), top_n)


@dataclass
class TrainingRun:
    model: PipelineModel
    kfold: KFoldResult
    metrics: dict[str, float]
    train_size: int
    test_size: int
    holdout: DataFrame              # scored test rows
    params: GbtParams


def train(features: DataFrame, params: GbtParams = GbtParams(), folds: int = FOLDS,
          test_fraction: float = TEST_FRACTION, seed: int = SEED, scale: bool = False) -> TrainingRun:
    """Split, k-fold, choose, evaluate. ``features``: url, label, 73 columns.
    ``scale`` fits a scaler on them, which becomes a stage of the model.

    The vectors are stored once: every fold reads them again, and a lost
    executor must not mean extracting features anew.
    """
    usable = features.where(F.col(FEATURE_NAMES[0]).isNotNull())
    scaling = stored(moments(usable, FEATURE_NAMES)) if scale else None
    vectors = stored(feature_vector(usable, scaling).select("url", F.col("label").cast("int").alias("label"), "features_vector"))
    parts = stratified_holdout(vectors, test_fraction, seed)
    training = stratified_kfold(parts.where(F.col("split") == "train"), folds, f"{seed}|fold")
    chosen = kfold_train(training, params, folds)
    holdout = score(parts.where(F.col("split") == "test"), chosen.best_model)
    row = binary_metrics(holdout).first().asDict()
    metrics = {k: float(row[k]) for k in ("accuracy", "precision", "recall", "f1_score")}
    metrics["roc_auc"] = roc_auc(holdout, "label", "probability_phishing").first()["auc"]
    sizes = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    model = PipelineModel([*feature_stages(scaling), chosen.best_model])
    return TrainingRun(model, chosen, metrics, sizes.get("train", 0), sizes.get("test", 0), holdout, params)
