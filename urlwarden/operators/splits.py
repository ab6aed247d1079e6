"""Stratified hold-out and k-fold by exact rank of a keyed hash.

Rows of a class are ordered by ``md5(key|seed)``; every part is a contiguous run of
ranks, so it is told by the keys at which parts end. Rows are counted per class and
first digits of the hash, which shows the cell of hashes in which a part ends; only
the rows of such cells are ranked by their keys. What goes to the rows is a table of
one row per class: they are neither sorted nor, while that table is small, shuffled.
A key that holds a third of all rows is one count, and any number of classes is
handled alike; sizes and cuts stay tables.

The input is read four times, so hand over stored data rather than a long computation.
Rows with equal keys always land in the same part; rows without a class land in none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlwarden.operators.ranking import hash_order
from urlwarden.session import stored, travelling

CELL_ROWS = 200  # rows of a class in a cell of hashes, while a class has 16 ** CELL_DIGITS cells at most
CELL_DIGITS = 4
MOST_CELL_ROWS = 20_000  # rows of a class in a cell of hashes, but for equal keys


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    """``__y, n``: rows per class."""
    return df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("__y")).agg(F.count("*").alias("n"))


def digits_for(rows: int) -> int:
    """Hexadecimal digits that cut a class of so many rows into cells."""
    def cut(size: int) -> int:
        return next(d for d in range(33) if rows <= size * 16 ** d)

    return max(min(cut(CELL_ROWS), CELL_DIGITS), cut(MOST_CELL_ROWS))


def last_keys(keyed: DataFrame, ends: DataFrame, digits: int) -> DataFrame:
    """``__y, __cuts``: for ``ends`` (``__y, k, end``) the largest key ``__o`` of each class that has a rank of ``end`` at
    most (from 1, equal keys share the least), or an empty text, which is before all keys."""
    celled = keyed.withColumn("__cell", F.substring("__o", 1, digits))
    cells = celled.groupBy("__y", "__cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("__y").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    ending = placed.join(ends.where("end > 0"), "__y").where("before < end AND end <= before + n")
    ending = stored(ending.select("__y", "__cell", "before", "k", "end"))
    chosen = ending.select("__y", "__cell", "before").distinct()
    keys = celled.join(travelling(chosen), ["__y", "__cell"]).groupBy("__y", "__cell", "before", "__o").agg(F.count("*").alias("n"))
    smaller = Window.partitionBy("__y", "__cell").orderBy("__o").rowsBetween(Window.unboundedPreceding, -1)
    ranked = keys.select("__y", "__cell", "__o", (F.col("before") + F.coalesce(F.sum("n").over(smaller), F.lit(0))).alias("earlier"))
    found = ranked.join(ending.drop("before"), ["__y", "__cell"]).where("earlier < end").groupBy("__y", "k").agg(F.max("__o").alias("__last"))
    every = found.unionByName(ends.where("end <= 0").select("__y", "k", F.lit("").alias("__last")))
    return every.groupBy("__y").agg(F.collect_list("__last").alias("__cuts"))


def dealt(df: DataFrame, label: str, key: str, seed: int | str, ended: Callable[[DataFrame], DataFrame], part: Column, name: str) -> DataFrame:
    """``df`` with the column ``name``: ``part``, worked out from ``__passed``, the number of ends that ``ended`` makes of
    ``__y, n``, the rows per class, and that the row's rank is beyond. Null without a class or key."""
    keyed = df.select(F.col(label).alias("__y"), hash_order(key, seed).alias("__o")).where("__y IS NOT NULL AND __o IS NOT NULL")
    sizes = stored(keyed.groupBy("__y").agg(F.count("*").alias("n")))
    largest = sizes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    cuts = stored(last_keys(keyed, stored(ended(sizes)), digits_for(largest)))
    rows = df.withColumns({"__y": F.col(label), "__o": hash_order(key, seed)}).join(travelling(cuts), "__y", "left")
    passed = F.coalesce(F.size(F.filter("__cuts", lambda cut: cut < F.col("__o"))), F.lit(0))
    known = F.col("__y").isNotNull() & F.col("__o").isNotNull()
    return rows.withColumn("__passed", F.when(known, passed)).select(*df.columns, F.when(known, part).alias(name))


def holdout_sizes(sizes: DataFrame, test_fraction: float) -> DataFrame:
    """``__y, test``: the test part rounds up in all; the train part is shared
    out by largest remainder (ties to the lower class). One row per class."""
    everything = Window.partitionBy()
    total = F.sum("n").over(everything)
    shares = sizes.select("__y", "n", total.alias("total")).withColumn("train", F.col("total") - F.ceil(F.lit(test_fraction) * F.col("total")))
    product = F.col("n").cast("decimal(38,0)") * F.col("train").cast("decimal(19,0)")
    shares = shares.withColumns({"q": F.floor(product / F.col("total")).cast("bigint"), "rem": (product % F.col("total")).cast("bigint")})
    extra = F.col("train") - F.sum("q").over(everything)
    favoured = F.row_number().over(Window.orderBy(F.desc("rem"), "__y")) <= extra
    return shares.select("__y", (F.col("n") - F.col("q") - favoured.cast("int")).alias("test"))


def fold_ends(sizes: DataFrame, folds: int) -> DataFrame:
    """``__y, k, end``: the ranks at which folds but the last end; sizes differ by one at most, larger ones first."""
    k = F.explode(F.sequence(F.lit(1), F.lit(folds - 1))) if folds > 1 else F.explode(F.array().cast("array<int>"))
    size = F.floor(F.col("n") / folds) * F.col("k") + F.least(F.col("n") % folds, F.col("k"))
    return sizes.select("__y", "n", k.alias("k")).select("__y", "k", size.cast("bigint").alias("end"))


def stratified_holdout(
    df: DataFrame, test_fraction: float = 0.2, seed: int | str = 127, label: str = "label", key: str = "url",
) -> DataFrame:
    """Add ``split``: ``test`` for the first ranks of each class, else ``train``."""
    def ended(sizes: DataFrame) -> DataFrame:
        return holdout_sizes(sizes, test_fraction).select("__y", F.lit(1).alias("k"), F.col("test").cast("bigint").alias("end"))

    return dealt(df, label, key, seed, ended, F.when(F.col("__passed") == 0, "test").otherwise("train"), "split")


def stratified_kfold(
    df: DataFrame, folds: int = 5, seed: int | str = 127, label: str = "label", key: str = "url",
) -> DataFrame:
    """Add ``fold`` 0..folds-1 with balanced classes."""
    return dealt(df, label, key, seed, lambda sizes: fold_ends(sizes, folds), F.col("__passed").cast("int"), "fold")


def split_sizes(df: DataFrame, by: str = "split") -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("rows"))
