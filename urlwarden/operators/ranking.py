"""Ranks and positions in a total order, from counts.

Rows are counted per sort key first, so that a key costs one row however often it
occurs. The counts are cut into ranges of equal size, as many as their number asks
for; a range is summed by one task, the ranges' totals by a small table. What comes
out is joined back by key: both sides of that join are stored or aggregated tables
that it shuffles itself, so Spark may split the rows of a hot key among tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlwarden.session import checkpoint_dir

PIECE_KEYS = 200_000  # sort keys summed by one task


def hash_order(key: str, seed: int | str) -> Column:
    """The sort key of a row: its hash, then the key itself."""
    return F.concat(F.md5(F.concat(F.col(key), F.lit(f"|{seed}"))), F.col(key))


def pieces_for(keys: int, cores: int) -> int:
    return max(cores, -(-keys // PIECE_KEYS))


def running(counts: DataFrame, by: list[str], order: list[str], n: str) -> DataFrame:
    """``counts`` (one row per ``by`` and ``order``) with ``before``: the sum of ``n`` over smaller keys of the same ``by``."""
    spark = counts.sparkSession
    checkpoint_dir(spark)
    stored = counts.checkpoint()
    pieces = pieces_for(stored.count(), spark.sparkContext.defaultParallelism)
    cut = stored.repartitionByRange(pieces, *by, *order).withColumn("__piece", F.spark_partition_id()).checkpoint()
    totals = cut.groupBy(*by, "__piece").agg(F.sum(n).alias("__n"))
    earlier = Window.partitionBy(*by).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "__piece", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(*by, "__piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("__inside", F.coalesce(F.sum(n).over(inside), F.lit(0)))
    same = [placed[c].eqNullSafe(offsets[c]) for c in by] + [placed["__piece"] == offsets["__piece"]]
    return placed.join(offsets, same).select(*(placed[c] for c in counts.columns), (F.col("__offset") + F.col("__inside")).alias("before"))


def positions(df: DataFrame, seed: int = 42, key: str = "url", column: str = "position") -> DataFrame:
    """Add each row's place, from 0, in the order of ``shuffled``: by the key's hash and the key, nulls first.

    Rows with equal keys follow one another in no given order. They are told apart by the partition they are
    stored in, so the rows of a hot key are numbered partition by partition.
    """
    given = df.columns
    checkpoint_dir(df.sparkSession)
    stored = df.withColumn("__o", F.coalesce(hash_order(key, seed), F.lit(""))).checkpoint().withColumn("__p", F.spark_partition_id())
    before = running(stored.groupBy("__o", "__p").agg(F.count("*").alias("__c")), [], ["__o", "__p"], "__c").checkpoint()
    inside = F.row_number().over(Window.partitionBy("__o", "__p").orderBy(F.lit(0)))
    return stored.withColumn("__i", inside).join(before, ["__o", "__p"]).select(
        *given, (F.col("before") + F.col("__i") - 1).cast("bigint").alias(column))
