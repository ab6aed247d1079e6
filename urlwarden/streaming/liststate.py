"""The state of a list that changes, as a table with a version per batch.

A version holds each domain's last change after a batch and is named by the batch's
id. It is written aside and comes into place by one rename, so a batch that fails
leaves the former version, and a batch that is repeated starts from the one before
it. Nothing of it lives in the driver: a restarted query reads the last version.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlwarden.session import delete, move

STATE_SCHEMA = "domain string, seq bigint, added boolean"
KEPT_VERSIONS = 3
NAME = "version="


def last_changes(changes: DataFrame) -> DataFrame:
    """``domain, seq, added``: each domain's last change. Of a boolean and a number,
    so that it stays a hash aggregate."""
    added = F.col("op") == "add" if "op" in changes.columns else F.col("added")
    return changes.groupBy("domain").agg(F.max("seq").alias("seq"), F.max_by(added, "seq").alias("added"))


@dataclass(frozen=True)
class ListState:
    spark: SparkSession
    path: str

    def folder(self, version: int) -> str:
        return f"{self.path.rstrip('/')}/{NAME}{version}"

    def versions(self) -> list[int]:
        root = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        system = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not system.exists(root):
            return []
        names = [entry.getPath().getName() for entry in system.listStatus(root)]
        return sorted(int(name.removeprefix(NAME)) for name in names if name.startswith(NAME))

    def before(self, batch_id: int) -> int | None:
        """The version that batch ``batch_id`` starts from."""
        return max((v for v in self.versions() if v < batch_id), default=None)

    def read(self, version: int | None) -> DataFrame:
        if version is None:
            return self.spark.createDataFrame([], STATE_SCHEMA)
        return self.spark.read.schema(STATE_SCHEMA).parquet(self.folder(version))

    def latest(self) -> DataFrame:
        return self.read(max(self.versions(), default=None))

    def seen(self, version: int | None) -> int | None:
        """The highest ``seq`` that a version holds."""
        return self.read(version).agg(F.max("seq")).first()[0]

    def advance(self, batch_id: int, changes: DataFrame) -> int | None:
        """Apply ``domain, op, seq`` as batch ``batch_id``; the version that holds afterwards. Without changes no version is written."""
        base = self.before(batch_id)
        draft = f"{self.path.rstrip('/')}/.draft-{uuid.uuid4().hex}"
        fresh = last_changes(changes)
        if fresh.isEmpty():
            return base
        last_changes(self.read(base).unionByName(fresh)).write.parquet(draft)
        if batch_id in self.versions():  # of a run that ended before the batch counted as done
            delete(self.spark, self.folder(batch_id))
        move(self.spark, draft, self.folder(batch_id))
        for old in [v for v in self.versions() if v <= batch_id][:-KEPT_VERSIONS]:
            delete(self.spark, self.folder(old))
        return batch_id
