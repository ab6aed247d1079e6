"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlwarden.llm.common import read, settle
from urlwarden.llm.linededup import without_shared_lines
from urlwarden.llm.packing import pack
from urlwarden.llm.quality import THRESHOLD, fit, scored
from urlwarden.llm.queries import BYTE_BPE
from urlwarden.llm.simhash import one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject. It learns from the labels that there are."""
    model = fit(docs, read(spark, sf_dir, "labels"))
    return scored(docs, model).where(F.col("score") >= THRESHOLD).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sources share stay in one document only."""
    cleaned = without_shared_lines(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    return one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 ids; the rows are the pieces in them."""
    return pack(docs, BYTE_BPE)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("simhash", simhash),
    ("packing", packing),
]

#: SQL has neither the classifier nor the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, settle(docs) if k else docs, sf_dir)
    return docs
