"""Verdicts, counters and list changes over streams of page loads.

The functions take a streaming or a plain frame alike. Domain lists are
prepared before a query starts; a list that changes is a versioned table
(``liststate``), brought up to date per micro-batch by ``run_with_changing_whitelist``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from urlwarden.functions.hosts import strip_www, with_hostname
from urlwarden.operators.cascade import Scorer, verdict_cascade
from urlwarden.operators.listmatch import DomainLists, prepare_lists
from urlwarden.operators.metrics import session_counters
from urlwarden.session import delete
from urlwarden.streaming.liststate import ListState, last_changes

EVENT_SCHEMA = "tab_id bigint, status string, url string, ts timestamp"
OPS_SCHEMA = "seq bigint, op string, value string"
KEPT_SNAPSHOTS = 3
COUNTERS_SCHEMA = "sites_checked bigint, phishing_blocked bigint, safe_visited bigint, batch bigint"


def navigation_stream(spark: SparkSession, source: str, fmt: str = "json", schema: str = EVENT_SCHEMA, **options) -> DataFrame:
    """Events from files (json, parquet, csv) or, with options, Kafka values in JSON."""
    if fmt == "kafka":
        raw = spark.readStream.format("kafka").option("subscribe", source).options(**options).load()
        return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("e")).select("e.*")
    return spark.readStream.schema(schema).options(**options).format(fmt).load(source)


def completed_loads(events: DataFrame) -> DataFrame:
    return events.where((F.col("status") == "complete") & F.startswith("url", F.lit("http")))


def stream_verdicts(events: DataFrame, lists: DomainLists, scorer: Scorer | None = None) -> DataFrame:
    return verdict_cascade(completed_loads(events), lists, scorer)


def stream_counters(verdicts: DataFrame) -> DataFrame:
    """Running totals; as a stream use output mode ``complete`` or ``update``."""
    return session_counters(verdicts)


def persist_counters(counters: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write the totals after each batch under the batch's own folder, so a
    repeated batch overwrites itself. The newest ``KEPT_SNAPSHOTS`` stay."""
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id).cast("bigint")).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if batch_id >= KEPT_SNAPSHOTS:
            delete(batch.sparkSession, f"{path}/batch={batch_id - KEPT_SNAPSHOTS}")

    return (
        counters.writeStream.outputMode("complete").foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def load_counters(spark: SparkSession, path: str) -> DataFrame:
    """The totals after the last batch."""
    snapshots = spark.read.schema(COUNTERS_SCHEMA).parquet(path)
    return snapshots.orderBy(F.desc("batch")).limit(1).drop("batch")


def whitelist_changes(ops: DataFrame) -> DataFrame:
    """``seq, op, domain``: an added address gives its host without ``www.``, a
    removed host is taken word for word. Unreadable addresses change nothing."""
    adds = with_hostname(ops.where(F.col("op") == "add"), "value", "host")
    added = adds.select("seq", "op", strip_www(F.col("host")).alias("domain")).where(F.col("domain").isNotNull())
    removed = ops.where(F.col("op") == "remove").select("seq", "op", F.col("value").alias("domain"))
    return added.unionByName(removed)


def whitelist_state(ops: DataFrame) -> DataFrame:
    """Domains on the list after all changes: the last change of each decides."""
    return listed(last_changes(whitelist_changes(ops)))


def listed(state: DataFrame) -> DataFrame:
    return state.where("added").select("domain")


def run_with_changing_whitelist(
    events: DataFrame, read_ops: Callable[[], DataFrame], safe: DataFrame, blacklist: DataFrame,
    sink: Callable[[DataFrame, int], None], checkpoint: str, scorer: Scorer | None = None, state: ListState | None = None, **trigger,
) -> StreamingQuery:
    """Per micro-batch: apply the changes since the last one, judge, hand to ``sink``.

    The list is a table with a version per batch that changed it (``state``, beside the checkpoint unless given), so a
    restarted query goes on from the last version, and a repeated batch from the version before it. Only
    changes of a higher ``seq`` than the version has seen are read; without one the prepared lists stay.
    """
    kept = state or ListState(events.sparkSession, f"{checkpoint.rstrip('/')}-list")
    prepared: dict = {}  # the lists of the version in use

    def judge(batch: DataFrame, batch_id: int) -> None:
        base = kept.before(batch_id)
        seen = kept.seen(base)
        fresh = read_ops() if seen is None else read_ops().where(F.col("seq") > seen)
        version = kept.advance(batch_id, whitelist_changes(fresh))
        if version not in prepared:
            prepared.clear()
            prepared[version] = prepare_lists(listed(kept.read(version)), safe, blacklist)
        sink(stream_verdicts(batch, prepared[version], scorer), batch_id)

    return (
        events.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def keep_whitelist(ops: DataFrame, state: ListState, checkpoint: str, **trigger) -> StreamingQuery:
    """Apply a stream of changes to the list, batch by batch, in whatever order they come."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        state.advance(batch_id, whitelist_changes(batch))

    return (
        ops.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
