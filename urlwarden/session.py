"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The feature projection is wide. One generated method for all of it would pass
# the JVM's 8,000-byte limit for compiled methods and then run interpreted;
# with this limit Spark emits the projection as several small methods instead.
SQL_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
CLEANING = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}

LOCAL_HEAP = "10g"

# A shuffle starts with this many parts at least, which Spark then joins up to the advisory size: the rows of
# a task are bounded by that size and not by the input over a fixed number of parts.
FIRST_PARTS = 1_000
PART_BYTES = 16 << 20
READ_BYTES = 32 << 20  # of a file in a task, which counts its rows by key in memory
MOST_TRAVELLING = 200_000  # rows of a measured table that go to every task
MOST_TRAVELLING_BYTES = 64 << 20


def build_session(master: str | None = None, app_name: str = "urlwarden", extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.driver.memory", LOCAL_HEAP)
    settings = SQL_SETTINGS | CLEANING | {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"} | (extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def tune(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings above to a session made elsewhere."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", SQL_SETTINGS["spark.sql.codegen.hugeMethodLimit"])
    parts = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.conf.set(parts, str(max(FIRST_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    for name, most in (("spark.sql.adaptive.advisoryPartitionSizeInBytes", PART_BYTES), ("spark.sql.files.maxPartitionBytes", READ_BYTES)):
        if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > most:
            spark.conf.set(name, str(most))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster.

    Only a local session, one process without executors of its own, may go
    without one; it then gets a temporary folder, which ends with the process.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="urlwarden-checkpoint-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def delete(spark: SparkSession, path: str, at_end: bool = False) -> None:
    """Remove a file or folder on any file system Spark reaches, now or when the driver ends."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if at_end:
        system.deleteOnExit(target)
    else:
        system.delete(target, True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, compressed by column, and read back. It goes when the driver ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    delete(spark, path, at_end=True)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def may_travel(table: DataFrame) -> bool:
    """Whether a stored table is measured to be small enough for every task, in a session that broadcasts at all."""
    if table.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return False
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    measured = table.agg(F.count("*").alias("rows"), size.alias("bytes")).first()
    return measured["rows"] <= MOST_TRAVELLING and measured["bytes"] <= MOST_TRAVELLING_BYTES


def travelling(table: DataFrame) -> DataFrame:
    """A stored table to be joined, sent to every task if it may travel."""
    return F.broadcast(table) if may_travel(table) else table


def move(spark: SparkSession, source: str, target: str, overwrite: bool = False) -> None:
    """One rename on whatever file system the paths are on."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE if overwrite else kind.NONE
    path = jvm.org.apache.hadoop.fs.Path(source)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    goal = jvm.org.apache.hadoop.fs.Path(target)
    files.mkdir(goal.getParent(), None, True)
    files.rename(path, goal, options)
