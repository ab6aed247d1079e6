"""Learning curves: metrics per boosting round, and where to stop."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urlwarden.operators.trees import forest, margin_cells, tree_table
from urlwarden.session import checkpoint_dir

PATIENCE = 100
CELL_BITS = (24, 44, 64)  # of a margin's 64: cells of 1/4096 of a power of two, then finer ones, then single margins
MOST_BROADCAST = 1_000_000  # cells of 12 bytes that may travel to every task
WIDE = "decimal(18,0)"


def learning_curve(model: GBTClassificationModel | DataFrame, frame: DataFrame, dataset: str = "test", every: int = 1) -> DataFrame:
    """``dataset, iter, AUC, Logloss`` on ``features_vector, label``, for a model or its table of trees.

    ``every`` keeps rounds 0, ``every``, twice that and so on, and the last. Rows become histograms of their margins
    in each task: what is shuffled is one row per kept round and cell, however many rows there are. The AUC is
    exact: a cell with rows of both classes is cut into finer ones, in one more pass over the rows for all such
    cells, until a cell holds one class or one margin.
    """
    trees = forest(tree_table(model) if isinstance(model, GBTClassificationModel) else model)
    last = len(trees.roots) - 1
    kept = [k for k in range(last + 1) if k % every == 0 or k == last]
    checkpoint_dir(frame.sparkSession)
    levels, mixed, above, total = [], None, 0, None
    for bits in CELL_BITS:
        cells = margin_cells(frame, trees, kept, bits, above)
        if mixed is not None:
            asked = mixed.count()
            if not asked:
                break
            cells = cells.join(F.broadcast(mixed) if asked <= MOST_BROADCAST else mixed, ["iter", "parent"], "left_semi")
        counts = cells.groupBy("iter", "parent", "cell").agg(*(F.sum(c).alias(c) for c in ("pos", "neg", "loss"))).checkpoint()
        mixed = counts.where("pos > 0 AND neg > 0").select("iter", F.col("cell").alias("parent"))
        total = counts if total is None else total
        before = Window.partitionBy("iter", "parent").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        below = F.coalesce(F.sum("neg").over(before), F.lit(0))
        levels.append(counts.select("iter", (2 * F.col("pos").cast(WIDE) * below.cast(WIDE)).cast("decimal(38,0)").alias("twice")))
        above = bits
    else:  # cells of one margin: ties count half
        levels.append(counts.select("iter", (F.col("pos").cast(WIDE) * F.col("neg").cast(WIDE)).cast("decimal(38,0)").alias("twice")))
    wins = reduce(DataFrame.unionByName, levels).groupBy("iter").agg(F.sum("twice").cast("double").alias("twice"))
    sums = total.groupBy("iter").agg(*(F.sum(c).cast("double").alias(c) for c in ("pos", "neg", "loss")))
    return sums.join(wins, "iter").select(
        F.lit(dataset).alias("dataset"), "iter", F.try_divide("twice", 2 * F.col("pos") * F.col("neg")).alias("AUC"),
        (F.col("loss") / (F.col("pos") + F.col("neg"))).alias("Logloss"))


def learning_curves(model: GBTClassificationModel, frames: dict[str, DataFrame], every: int = 1) -> DataFrame:
    """The curves of several sets, such as the training and the evaluation rows, in one frame."""
    curves = [learning_curve(model, frame, name, every) for name, frame in frames.items()]
    return reduce(DataFrame.unionByName, curves)


def best_iteration(curve: DataFrame, patience: int = PATIENCE, by: Sequence[str] = ()) -> DataFrame:
    """``best_iter, best_auc, stop_iter`` per curve.

    Training stops at the first round that is ``patience`` rounds past the best
    one; without such a round it stops at the last. A curve has at most as many
    rows as there were rounds.
    """
    by = list(by)
    so_far = Window.partitionBy(*by).orderBy("iter")
    earlier = so_far.rowsBetween(Window.unboundedPreceding, -1)
    previous = F.max("AUC").over(earlier)
    improved = previous.isNull() | (F.col("AUC") > previous)
    marked = curve.select(*by, "iter", "AUC", F.when(improved, F.col("iter")).alias("__improved"))
    tracked = marked.select(*by, "iter", F.max("__improved").over(so_far).alias("best_iter"), F.max("AUC").over(so_far).alias("best_auc"))
    stops = F.col("iter") - F.col("best_iter") >= patience
    first_stop = F.min(F.when(stops, F.col("iter")))
    whole = Window.partitionBy(*by)
    ended = tracked.withColumn("stop_iter", F.coalesce(first_stop.over(whole), F.max("iter").over(whole)))
    return ended.where(F.col("iter") == F.col("stop_iter")).select(*by, "best_iter", "best_auc", "stop_iter")
