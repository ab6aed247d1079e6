"""Saving and loading trained pipelines with their metadata.

A version is one folder that holds both, and ``latest`` a file that names one. Both
come into place by a rename, the version first: whatever fails in between, readers
see the former version whole. On stores without an atomic rename of one file the
pointer may be missing for a moment, never half written.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession

from urlwarden.functions.vocab import FEATURE_NAMES
from urlwarden.operators.scaling import SCALED
from urlwarden.operators.training import ROUNDED, TrainingRun
from urlwarden.session import delete, move

METADATA_SCHEMA = (
    "version string, timestamp string, dataset string, train_size bigint, test_size bigint, best_fold int, "
    "metrics struct<accuracy double, precision double, recall double, f1_score double, roc_auc double>, "
    "model_params map<string,string>, feature_names array<string>, model_type string"
)
LATEST = "latest"


def version_name(best_fold: int, now: datetime | None = None) -> str:
    return f"v{(now or datetime.now()):%Y%m%d_%H%M%S}_best_fold{best_fold}"


def write_pointer(spark: SparkSession, root: str, version: str) -> None:
    """Let ``latest`` name ``version``, by one rename of a file."""
    jvm = spark.sparkContext._jvm
    draft = f"{root}/.{LATEST}-{uuid.uuid4().hex}"
    path = jvm.org.apache.hadoop.fs.Path(draft)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(version.encode()))
    out.close()
    move(spark, draft, f"{root}/{LATEST}", overwrite=True)


def current_version(spark: SparkSession, root: str) -> str:
    return spark.read.text(f"{root}/{LATEST}", wholetext=True).first()["value"]


def folder_of(spark: SparkSession, root: str, version: str) -> str:
    return f"{root}/versions/{current_version(spark, root) if version == LATEST else version}"


def save_model(run: TrainingRun, root: str, dataset: str, now: datetime | None = None) -> str:
    """Write pipeline and metadata as a new version, then let ``latest`` name it. A version is never written twice."""
    moment = now or datetime.now()
    root = root.rstrip("/")
    version = version_name(run.kfold.best_fold, moment)
    spark = run.holdout.sparkSession
    m = run.metrics
    row = (
        version, f"{moment:%Y%m%d_%H%M%S}", dataset, run.train_size, run.test_size, run.kfold.best_fold,
        tuple(m[k] for k in ("accuracy", "precision", "recall", "f1_score", "roc_auc")),
        {k: str(v) for k, v in asdict(run.params).items()}, list(FEATURE_NAMES), "gbt",
    )
    draft = f"{root}/.draft-{uuid.uuid4().hex}"
    try:
        run.model.write().save(f"{draft}/model")
        spark.createDataFrame([row], METADATA_SCHEMA).coalesce(1).write.json(f"{draft}/metadata")
        move(spark, draft, f"{root}/versions/{version}")
    except Exception:
        delete(spark, draft)
        raise
    write_pointer(spark, root, version)
    return version


def load_model(root: str, version: str = LATEST) -> PipelineModel:
    return PipelineModel.load(f"{folder_of(SparkSession.active(), root.rstrip('/'), version)}/model")


def read_metadata(spark: SparkSession, root: str, version: str = LATEST) -> DataFrame:
    return spark.read.schema(METADATA_SCHEMA).json(f"{folder_of(spark, root.rstrip('/'), version)}/metadata")


def feature_order(model: PipelineModel) -> list[str]:
    names = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    return [name.removeprefix(SCALED).removeprefix(ROUNDED) for name in names]
