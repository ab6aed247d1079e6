"""Fitted trees as a table, and what is worked out from the table.

One row per node. Node 0 is a tree's root; a row goes to ``lower`` if its feature is
at most the threshold, else to ``upper``; a leaf has feature -1. The margin of a row is
the sum of weight times leaf value over all trees.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from urlwarden.session import checkpoint_dir, delete

NODES = "tree int, node int, feature int, threshold double, lower int, upper int, value double, weight double"
MOST_NODES = 4_000_000  # some 40 bytes each in every task


def tree_table(model: GBTClassificationModel) -> DataFrame:
    """``tree, node, feature, threshold, lower, upper, value, weight`` of a model, read from its saved form."""
    spark = SparkSession.active()
    folder = f"{checkpoint_dir(spark).rstrip('/')}/trees-{uuid.uuid4().hex}"
    delete(spark, folder, at_end=True)
    model.write().save(folder)
    nodes = spark.read.parquet(f"{folder}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    weights = spark.read.parquet(f"{folder}/treesMetadata").toDF("tree", "about", "weight").drop("about")
    inner = F.col("leftChild") >= 0
    return nodes.join(F.broadcast(weights), "tree").select(  # one row per tree
        "tree", F.col("id").alias("node"), F.when(inner, F.col("split.featureIndex")).otherwise(-1).alias("feature"),
        F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("lower"), F.when(inner, F.col("rightChild")).alias("upper"),
        F.col("prediction").alias("value"), "weight")


@dataclass
class Forest:
    """The table as arrays, nodes of all trees one after the other."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    lower: np.ndarray
    upper: np.ndarray
    value: np.ndarray  # times the weight


def forest(nodes: DataFrame) -> Forest:
    """Small enough to travel to every task, or an error."""
    count = nodes.count()
    if count > MOST_NODES:
        raise ValueError(f"{count} nodes; {MOST_NODES} travel to the tasks at most, score with the model itself")
    table = nodes.select(*(F.col(c) for c in ("tree", "node", "feature", "threshold", "lower", "upper", "value", "weight"))).toArrow()
    tree, node, feature, threshold, lower, upper, value, weight = (
        table.column(k).fill_null(0).to_numpy() if c != "threshold" else table.column(k).fill_null(0.0).to_numpy()
        for k, c in enumerate(table.column_names))
    order = np.lexsort((node, tree))
    roots = np.flatnonzero(np.r_[True, np.diff(tree[order]) > 0]) if count else np.empty(0, np.int64)
    base = np.repeat(roots, np.diff(np.r_[roots, count]))
    if (node[order] != np.arange(count) - base).any():
        raise ValueError("a tree's nodes count from 0 without gaps")
    return Forest(roots, feature[order], threshold[order], base + lower[order], base + upper[order], (value * weight)[order])


def _stepping(trees: Forest):
    # Nested on purpose: it travels to the workers by value, so they do not need this package.
    parts = trees.roots, trees.feature, trees.threshold, trees.lower, trees.upper, trees.value

    def margins(rows: np.ndarray) -> Iterator[np.ndarray]:
        """The margin of each row after each tree."""
        roots, feature, threshold, lower, upper, value = parts
        total, place = np.zeros(len(rows)), np.arange(len(rows))
        for root in roots:
            at = np.full(len(rows), root)
            while True:
                asked = feature[at]
                inner = asked >= 0
                if not inner.any():
                    break
                small = rows[place, np.where(inner, asked, 0)] <= threshold[at]
                at = np.where(inner, np.where(small, lower[at], upper[at]), at)
            total = total + value[at]
            yield total

    return margins


def matrix_of(column: str = "features_vector") -> Column:
    return F.when(F.col(column).isNotNull(), vector_to_array(F.col(column)))


def margin(trees: Forest, features: Column) -> Column:
    """The sum over all trees, for an array of features; null for a null array."""
    margins = _stepping(trees)

    def total(vectors: pa.Array) -> pa.Array:
        known = np.flatnonzero(np.asarray(vectors.is_valid()))
        out = np.zeros(len(vectors))
        if len(known):
            some = vectors.take(pa.array(known))
            rows = some.flatten().to_numpy(zero_copy_only=False).reshape(len(known), -1)
            for out_known in margins(rows):
                out[known] = out_known
        return pa.array(out, mask=np.asarray(vectors.is_null()))

    return F.arrow_udf(total, DoubleType())(features)


def score_by_table(df: DataFrame, nodes: DataFrame, vector: str = "features_vector") -> DataFrame:
    """Add ``prediction, probability_phishing, probability_legitimate`` by the table of nodes; a row without a vector has none."""
    given = [c for c in df.columns if c != vector]
    told = df.withColumn("__m", margin(forest(nodes), matrix_of(vector)))
    phishing = 1 / (1 + F.exp(-2 * F.col("__m")))
    return told.select(*given, (F.col("__m") > 0).cast("int").alias("prediction"), phishing.alias("probability_phishing"),
                       (1 - phishing).alias("probability_legitimate"))


def margin_cells(frame: DataFrame, trees: Forest, kept: list[int], bits: int, above: int) -> DataFrame:
    """``iter, parent, cell, pos, neg, loss``: rows of each class per cell of their margin, batch by batch.

    A cell is the first ``bits`` bits of the margin in an order-keeping form, its parent the first ``above`` of them; with
    all 64 a cell is one margin. ``loss`` adds up the logarithmic loss.
    """
    margins, wanted = _stepping(trees), set(kept)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["iter", "parent", "cell", "pos", "neg", "loss"]
        for batch in batches:
            if not batch.num_rows:
                continue
            label = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(label), -1)
            found = []
            for k, total in enumerate(margins(rows)):
                if k not in wanted:
                    continue
                raw = (total + 0.0).view(np.uint64)
                key = np.where(raw >> np.uint64(63) == 1, ~raw, raw | np.uint64(1 << 63))
                cell, place = np.unique(key >> np.uint64(64 - bits), return_inverse=True)
                pos = np.bincount(place, label, len(cell)).astype(np.int64)
                neg = np.bincount(place, 1 - label, len(cell)).astype(np.int64)
                loss = np.bincount(place, np.logaddexp(0, -2 * (2 * label - 1) * total), len(cell))
                parent = cell >> np.uint64(bits - above) if above else np.zeros_like(cell)
                signed = (cell ^ np.uint64(1 << 63)).view(np.int64) if bits == 64 else cell.astype(np.int64)
                found.append((np.full(len(cell), k, np.int32), parent.astype(np.int64), signed, pos, neg, loss))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(part)) for part in zip(*found)], names=names)

    usable = frame.where(F.col("label").isNotNull() & F.col("features_vector").isNotNull())
    return usable.select(F.col("label").cast("int").alias("label"), matrix_of().alias("vector")).mapInArrow(
        cells, "iter int, parent bigint, cell bigint, pos bigint, neg bigint, loss double")
