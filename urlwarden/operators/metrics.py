"""Classification metrics and counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL_BITS = 16  # of a score's place by which a window is bounded: it holds 2^16 rows of a group at most


def _or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    y, z = F.col(label), F.col(prediction)
    return df.agg(
        F.count_if((y == 1) & (z == 1)).alias("tp"), F.count_if((y == 0) & (z == 1)).alias("fp"),
        F.count_if((y == 1) & (z == 0)).alias("fn"), F.count_if((y == 0) & (z == 0)).alias("tn"),
    )


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: ``tp fp fn tn accuracy precision recall f1_score``."""
    tp, fp, fn, tn = map(F.col, ("tp", "fp", "fn", "tn"))
    scored = confusion_counts(df, label, prediction).withColumns({
        "accuracy": _or_zero(tp + tn, tp + fp + fn + tn),
        "precision": _or_zero(tp, tp + fp),
        "recall": _or_zero(tp, tp + fn),
    })
    return scored.withColumn("f1_score", _f1(F.col("precision"), F.col("recall")))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Actual label against predicted counts, always two rows."""
    return confusion_counts(df, label, prediction).select(
        F.expr("stack(2, 0, tn, fp, 1, fn, tp) as (label, predicted_0, predicted_1)")
    )


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class, accuracy, macro and weighted averages."""
    per_class = (
        confusion_counts(df, label, prediction)
        .select(F.expr("stack(2, '0', tn, fn, fp, '1', tp, fp, fn) as (entry, hit, wrong, missed)"))
        .select(
            "entry", "hit", (F.col("hit") + F.col("missed")).alias("support"),
            _or_zero(F.col("hit"), F.col("hit") + F.col("wrong")).alias("precision"),
            _or_zero(F.col("hit"), F.col("hit") + F.col("missed")).alias("recall"),
        )
        .withColumn("f1_score", _f1(F.col("precision"), F.col("recall")))
    )
    names = ("precision", "recall", "f1_score")
    total = F.sum("support")
    accuracy = _or_zero(F.sum("hit"), total)
    summary = per_class.agg(
        total.alias("support"),
        accuracy.alias("accuracy"),
        *(F.avg(n).alias(f"macro_{n}") for n in names),
        *(_or_zero(F.sum(F.col(n) * F.col("support")), total).alias(f"weighted_{n}") for n in names),
    ).select(F.expr(
        "stack(3, 'accuracy', accuracy, accuracy, accuracy, support,"
        " 'macro avg', macro_precision, macro_recall, macro_f1_score, support,"
        " 'weighted avg', weighted_precision, weighted_recall, weighted_f1_score, support)"
        " as (entry, precision, recall, f1_score, support)"
    ))
    return per_class.select("entry", *names, "support").unionByName(summary)


def place(number: Column) -> Column:
    """A whole number for every double, in the same order and equal only for equal ones: its exponent, then its
    fraction, as a double is laid out. NaN comes last, as in Spark's order; the zeros are one."""
    size, least = F.abs(number), F.lit(-1022).cast("bigint")
    near = F.floor(F.log2(size))  # of a rounded logarithm, so it may be one off
    power = F.pow(F.lit(2.0), near)
    exponent = F.greatest(F.when(size < power, near - 1).when(size >= 2 * power, near + 1).otherwise(near), least)
    fraction = (size / F.pow(F.lit(2.0), exponent) * F.lit(2.0 ** 52)).cast("bigint")
    bits = F.when(F.isnan(number), F.lit(2047 * 2 ** 52 + 1)).when(size == float("inf"), F.lit(2047 * 2 ** 52)).when(
        size == 0, F.lit(0).cast("bigint")).otherwise((exponent + 1022) * F.lit(2 ** 52) + fraction)
    return F.when(number < 0, -bits).otherwise(bits)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counted half, per ``by`` group.

    Rows are first reduced to one per distinct score. The running count of
    negatives is then taken level by level over cells of the score's place among
    all doubles, ``CELL_BITS`` of it at a time. So no window holds more than one
    cell of 2^16 rows, however many scores there are and however near to one another.
    """
    by = list(by)
    y = F.col(label)
    level = (
        df.where(y.isNotNull() & F.col(score).isNotNull())
        .groupBy(*by, F.col(score).cast("double").alias("__s"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
        .select(*by, place(F.col("__s")).alias("__at"), "pos", "neg")
    )
    twice = _product("pos", F.col("neg"))
    for bits in range(CELL_BITS, 65, CELL_BITS):
        cell = [F.shiftright("__at", CELL_BITS).alias("__cell")] if bits < 64 else []
        level = level.select(*by, "__at", "pos", "neg", twice.alias("twice"), *cell)
        kept = [*by, "__cell"] if cell else by
        before = Window.partitionBy(*kept).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
        level = (
            level.withColumn("twice", F.col("twice") + 2 * _product("pos", F.coalesce(F.sum("neg").over(before), F.lit(0))))
            .groupBy(*kept)
            .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum(F.col("twice").cast("decimal(38,0)")).cast("decimal(38,0)").alias("twice"))
            .withColumnRenamed("__cell", "__at")
        )
        twice = F.col("twice")
    pairs = F.col("pos").cast("double") * F.col("neg").cast("double")
    return level.select(*by, F.try_divide(F.col("twice").cast("double"), 2 * pairs).alias("auc"))


def _product(name: str, other: Column) -> Column:
    return (F.col(name).cast("decimal(18,0)") * other.cast("decimal(18,0)")).cast("decimal(38,0)")


def phishing_summary(df: DataFrame, flag: str = "is_phishing") -> DataFrame:
    return df.agg(F.count_if(F.col(flag)).alias("phishing"), F.count("*").alias("total"))


def session_counters(verdicts: DataFrame, weight: Column | None = None) -> DataFrame:
    """``sites_checked, phishing_blocked, safe_visited``; errors and missing
    verdicts count only as checked. ``weight`` counts a row several times."""
    one = F.lit(1).cast("bigint") if weight is None else weight

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, one)), F.lit(0)).cast("bigint")

    return verdicts.agg(
        total(F.lit(True)).alias("sites_checked"),
        total(F.col("result") == "phishing").alias("phishing_blocked"),
        total(F.col("result") == "safe").alias("safe_visited"),
    )
