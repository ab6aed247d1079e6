"""Moments of columns, and a pipeline stage that centres and scales by them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALED = "std_"  # before the names of scaled columns


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, n, mean, deviation, least, most`` of each column, from one pass. Nulls are left out; the deviation is
    that of all rows, not of a sample. A column without values has ``n`` 0 and nulls."""
    sums = []
    for k, name in enumerate(columns):
        c = F.col(name).cast("double")
        sums += [F.count(c).alias(f"n{k}"), F.avg(c).alias(f"a{k}"), F.stddev_pop(c).alias(f"d{k}"), F.min(c).alias(f"l{k}"), F.max(c).alias(f"m{k}")]
    rows = ", ".join(f"'{name}', n{k}, a{k}, d{k}, l{k}, m{k}" for k, name in enumerate(columns))
    return df.agg(*sums).select(F.expr(f"stack({len(columns)}, {rows}) AS (feature, n, mean, deviation, least, most)"))


def scaler(table: DataFrame, given: dict[str, str] | None = None) -> SQLTransformer:
    """A stage that adds ``std_`` columns: less the mean, over the deviation. ``table`` is that of ``moments``, a row per
    column; ``given`` names the columns to read where they differ from the features. A column that never varies
    becomes 0, and nulls stay. The numbers are part of the stage, so it is saved and loaded with its pipeline."""
    columns = []
    for row in table.orderBy("feature").collect():
        name = (given or {}).get(row["feature"], row["feature"])
        centred = f"(CAST(`{name}` AS DOUBLE) - {row['mean']!r}D)" if row["n"] else f"CAST(`{name}` AS DOUBLE)"
        scale = f" / {row['deviation']!r}D" if row["deviation"] else " * 0D" if row["n"] else ""
        columns.append(f"{centred}{scale} AS `{SCALED}{row['feature']}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")
