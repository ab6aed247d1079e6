"""Reading labelled tables, address lists and domain lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urlwarden.functions.hosts import with_hostname
from urlwarden.functions.vocab import CSV_MISSING, PREFERRED_FILES
from urlwarden.sources import records

OUTER_SPACE = r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, OUTER_SPACE, "")


def read_labelled(spark: SparkSession, path: str, fmt: str | None = None, multiline: bool = True, in_ranges: bool = False) -> DataFrame:
    """CSV, Parquet or JSON by extension; text columns stay strings.

    Blank cells and the usual marks for a missing value are null in text columns
    of any format. ``multiline`` allows line breaks inside quoted CSV cells and
    JSON written as one array, at one task per file; switch it off for files of one
    record per line. ``in_ranges`` reads large files of either kind by many tasks,
    which find the records' ends first (``records``); all columns are text then.
    """
    fmt = fmt or path.rstrip("/").rsplit(".", 1)[-1].lower()
    if in_ranges and fmt in ("csv", "json"):
        raw = (records.read_csv if fmt == "csv" else records.read_json)(spark, path)
    elif fmt == "csv":
        raw = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=multiline)
    elif fmt == "parquet":
        raw = spark.read.parquet(path)
    elif fmt == "json":
        raw = spark.read.json(path, multiLine=multiline, primitivesAsString=True)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return without_missing(raw)


def without_missing(df: DataFrame) -> DataFrame:
    """Null for cells of text columns that stand for a missing value."""
    texts = {f.name for f in df.schema if f.dataType.typeName() == "string"}
    cells = (F.col(f"`{c}`") for c in df.columns)
    return df.select(*(
        F.when((cell != "") & ~cell.isin(*CSV_MISSING), cell).alias(c) if c in texts else cell.alias(c) for c, cell in zip(df.columns, cells)))


def as_parquet(spark: SparkSession, source: str, folder: str, fmt: str | None = None) -> DataFrame:
    """A source that one task must read, stored in pieces on the first call."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if not marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker):
        read_labelled(spark, source, fmt).write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``name, path`` of the files in a folder; contents are not read."""
    listing = spark.read.format("binaryFile").load(folder).select("path")
    return listing.select(F.substring_index("path", "/", -1).alias("name"), "path")


def file_priority(name: Column) -> Column:
    """Smaller is better; null for files that hold no data."""
    rank = F.when(name == PREFERRED_FILES[0], 0)
    for i, preferred in enumerate(PREFERRED_FILES[1:], start=1):
        rank = rank.when(name == preferred, i)
    return (
        rank.when(F.endswith(name, F.lit(".csv")) & F.contains(F.lower(name), F.lit("full")), 3)
        .when(F.endswith(name, F.lit(".csv")), 4)
        .when(F.endswith(name, F.lit(".parquet")), 5)
        .when(F.endswith(name, F.lit(".json")) & ~F.startswith(name, F.lit(".")), 6)
    )


def choose_source_file(files: DataFrame) -> DataFrame:
    """The best file of a listing, as one row (none if there is no data file)."""
    ranked = files.withColumn("priority", file_priority(F.col("name"))).where(F.col("priority").isNotNull())
    return ranked.orderBy("priority", "name").limit(1)


def clean_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Trim a text column and drop the rows left blank."""
    return lines.withColumn(column, trimmed(F.col(column))).where(F.col(column) != "")


def read_url_list(spark: SparkSession, path: str, column: str = "url") -> DataFrame:
    """One address per line, trimmed, blanks dropped."""
    return clean_lines(spark.read.text(path)).withColumnRenamed("value", column)


def read_safe_domains(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of domains per file, read in byte ranges."""
    return records.json_strings(spark, path).select(F.col("value").alias("domain")).distinct()


def blocked_domains(lines: DataFrame, column: str = "value") -> DataFrame:
    """Host names of block-list lines; lines that are no address stay as they are."""
    bare = F.regexp_replace(trimmed(F.col(column)), r'\A"|"\z', "")
    cleaned = lines.select(bare.alias("line")).where(F.col("line") != "")
    address = F.when(F.startswith("line", F.lit("http")), F.col("line")).otherwise(F.concat(F.lit("https://"), F.col("line")))
    hosts = with_hostname(cleaned.withColumn("address", address), "address", "host")
    return hosts.select(F.coalesce("host", "line").alias("domain")).distinct()


def read_blacklist(spark: SparkSession, path: str) -> DataFrame:
    return blocked_domains(spark.read.text(path, lineSep="\n"))


def read_learning_curve(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``iter, AUC, Logloss``; a training log has no AUC."""
    raw = spark.read.csv(path, sep="\t", header=True)
    auc = F.col("AUC").cast("double") if "AUC" in raw.columns else F.lit(None).cast("double")
    return raw.select(F.col("iter").cast("int").alias("iter"), auc.alias("AUC"), F.col("Logloss").cast("double").alias("Logloss"))


def long_curve(curve: DataFrame, fold: int) -> DataFrame:
    """``fold, iter, metric, value``."""
    return curve.select(
        F.lit(fold).alias("fold"), "iter", F.expr("stack(2, 'AUC', AUC, 'Logloss', Logloss) as (metric, value)"),
    ).where(F.col("value").isNotNull())
