"""Merging labelled address sources: projection, labels, union, de-duplication.

Rows travel as ``url, label, source, seq`` where ``seq`` is one DECIMAL(38,0) that
orders rows by source, then by position in the source, whatever 64-bit number
that is.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlwarden.functions.vocab import (
    PHISHING_LABELS, PRIMARY_LABEL_ALIASES, PRIMARY_URL_ALIASES,
    SECONDARY_LABEL_ALIASES, SECONDARY_URL_ALIASES,
)

log = logging.getLogger(__name__)

ORDER = "decimal(38,0)"  # fixed-length, so that aggregates over it stay hash aggregates
SOURCE_STEP = 1 << 64  # more than any two 64-bit positions are apart


def pick_column(columns: Iterable[str], aliases: Sequence[str], ignore_case: bool = False) -> str | None:
    """First of ``columns``, in their own order, that is one of ``aliases``."""
    return next((c for c in columns if (c.lower() if ignore_case else c) in aliases), None)


def require_column(df: DataFrame, name: str) -> DataFrame:
    if name not in df.columns:
        raise KeyError(f"column {name!r} not found; columns are {df.columns}")
    return df


def project(df: DataFrame, url_col: str, label_col: str, order_col: str | None = None) -> DataFrame:
    position = F.col(order_col).cast("bigint") if order_col else F.monotonically_increasing_id()
    return df.select(F.col(url_col).alias("url"), F.col(label_col).alias("label"), position.alias("row_ord"))


def project_primary(df: DataFrame, order_col: str | None = None) -> DataFrame:
    """``url, label, row_ord``; missing columns are an error."""
    url, label = pick_column(df.columns, PRIMARY_URL_ALIASES), pick_column(df.columns, PRIMARY_LABEL_ALIASES)
    if not (url and label):
        raise KeyError(f"no address or label column among {df.columns}")
    return project(df, url, label, order_col)


def project_secondary(df: DataFrame, order_col: str | None = None) -> DataFrame | None:
    """As above, ignoring case; a source without the columns is skipped."""
    url = pick_column(df.columns, SECONDARY_URL_ALIASES, ignore_case=True)
    label = pick_column(df.columns, SECONDARY_LABEL_ALIASES, ignore_case=True)
    if not (url and label):
        log.warning("source skipped, no address or label column among %s", df.columns)
        return None
    return project(df, url, label, order_col)


def label_is_text(df: DataFrame, label_col: str = "label") -> bool:
    """Whether a column read as strings would load as text.

    One aggregate to a single row. Columns that are all numbers, or all
    true/false without gaps, are not text.
    """
    if df.schema[label_col].dataType.typeName() != "string":
        return False
    label = F.col(label_col)
    row = df.agg(
        F.count_if(label.isNotNull() & label.try_cast("double").isNull()).alias("words"),
        F.count_if(F.coalesce(~label.isin("True", "TRUE", "true", "False", "FALSE", "false"), F.lit(True))).alias("not_bool"),
    ).first()
    return row["words"] > 0 and row["not_bool"] > 0


def normalise_label(label: Column, is_text: bool) -> Column:
    """1/0 for text labels (unknown words and nulls are 0), else the number."""
    if is_text:
        return F.when(F.lower(label.cast("string")).isin(*PHISHING_LABELS), 1.0).otherwise(0.0)
    truth = F.lower(label.cast("string"))
    return F.when(truth == "true", 1.0).when(truth == "false", 0.0).otherwise(label.try_cast("double"))


def normalised(df: DataFrame, is_text: bool | None = None) -> DataFrame:
    decided = label_is_text(df) if is_text is None else is_text
    return df.withColumn("label", normalise_label(F.col("label"), decided))


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Concatenate projected sources in the given order, adding ``source, seq``."""
    if not sources:
        raise ValueError("no source could be read")
    merged = None
    for rank, (name, df) in enumerate(sources.items()):
        part = df.select(
            "url", "label", F.lit(name).alias("source"),
            (F.lit(str(rank * SOURCE_STEP)).cast(ORDER) + F.col("row_ord").cast(ORDER)).cast(ORDER).alias("seq"),
        )
        merged = part if merged is None else merged.unionByName(part)
    return merged


def dedup_first(df: DataFrame, key: str = "url", order: str = "seq") -> DataFrame:
    """The first row of each key; null is one key.

    An aggregate rather than a ranking window: each task reduces a repeated key
    to one row before the shuffle, so a key that holds a third of all rows costs
    no more than any other. Numeric and decimal columns keep it a hash aggregate.
    """
    others = [c for c in df.columns if c not in (key, order)]
    firsts = (F.min_by(c, order).alias(c) for c in others)
    return df.groupBy(key).agg(*firsts, F.min(order).alias(order)).select(*df.columns)


def drop_missing(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["url", "label"])


def shuffled(df: DataFrame, seed: int = 42, key: str = "url") -> DataFrame:
    """A total order that depends on key and seed only, not on partitioning; ``ranking.positions`` numbers it."""
    return df.orderBy(F.md5(F.concat(F.col(key), F.lit(f"|{seed}"))), key)


def merge_sources(sources: dict[str, DataFrame], seed: int | None = 42) -> DataFrame:
    """Union, first row per address, drop gaps, shuffle -> ``url, label INT``."""
    merged = require_column(union_sources(sources), "url").select("url", "label", "seq")
    clean = drop_missing(dedup_first(merged)).select("url", F.col("label").cast("int").alias("label"))
    return clean if seed is None else shuffled(clean, seed)


def row_counts(df: DataFrame, by: str = "source") -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("rows"))


def class_distribution(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows and share per label; the window sees one row per label."""
    everything = Window.partitionBy()
    return (
        df.where(F.col(label_col).isNotNull())
        .groupBy(F.col(label_col).alias("label")).agg(F.count("*").alias("rows"))
        .withColumn("share", F.col("rows") / F.sum("rows").over(everything))
    )
