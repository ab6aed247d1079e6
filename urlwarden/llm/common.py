"""Helpers that the operators of this package share."""

from __future__ import annotations

import pickle
import sys
import uuid
from collections.abc import Callable, Iterable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from urlwarden.session import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    The lineage ends there, so that a lost executor costs a re-read and what is
    used twice is worked out once. The folder goes when the driver ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/settled-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def schema_like(df: DataFrame, columns: dict[str, str], more: Iterable[tuple[str, str]] = ()) -> StructType:
    """Fields of ``df`` under new names (``{new: old}``), then ``more`` as (name, DDL type)."""
    fields = [StructField(new, df.schema[old].dataType) for new, old in columns.items()]
    rest = StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in more)).fields if more else []
    return StructType(fields + rest)


def text_of(column: str):
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def document_key(id_col: str, text_col: str) -> list[Column]:
    """``k1, k2``: numbers that rows share only if they have equal ids and texts."""
    text = F.col(text_col).cast("string")
    return [F.xxhash64(F.col(id_col), text).alias("k1"), F.hash(text, F.col(id_col)).alias("k2")]


def worker_store() -> dict:
    """A dictionary that lives as long as the Python worker does."""
    return sys.__dict__.setdefault("_urlwarden_store", {})


def sent(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast ``value``, whose classes may be of this package. The function
    returned gives it to tasks; a Python worker unpacks it once."""
    key, box = uuid.uuid4().hex, spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def received() -> Any:
        kept = worker_store()
        if kept.get("sent", (None,))[0] != key:
            kept["sent"] = key, pickle.loads(box.value)
        return kept["sent"][1]

    return received


def in_one_task(spark: SparkSession, work: Callable[[], Any]) -> Any:
    """Run bounded work on an executor, where linear algebra keeps to the task's one core."""
    def run(batches):
        import pyarrow as pa

        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(work())], pa.binary())], names=["done"])

    return pickle.loads(spark.range(1, numPartitions=1).mapInArrow(run, "done binary").first()["done"])
