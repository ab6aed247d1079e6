"""Writing merged corpora and predictions, and the reusable feature table."""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlwarden.functions.features import url_features

FILE_ROWS = 50_000  # of a file of predictions, some 75 MB of text


def write_merged(df: DataFrame, path: str, fmt: str = "csv") -> None:
    writer = df.select("url", "label").write.mode("overwrite")
    if fmt == "csv":
        writer.csv(path, header=True, quote='"', escape='"')
    else:
        writer.format(fmt).save(path)


def write_predictions(records: DataFrame, folder: str, now: datetime | None = None, compression: str = "gzip") -> str:
    """CSV under ``results_<time>.csv`` with the features as JSON text. That repeats 73 names in each row, so the files
    are compressed; each is read by one task, so they hold ``FILE_ROWS`` rows at most."""
    path = f"{folder.rstrip('/')}/results_{(now or datetime.now()):%Y%m%d_%H%M%S}.csv"
    flat = records.withColumn("features", F.to_json("features"))
    flat.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).csv(path, header=True, quote='"', escape='"', compression=compression)
    return path


def corpus_fingerprint(corpus: DataFrame) -> str:
    """Names, types and an order-free sum over all cells: equal for equal corpora only."""
    cells = [F.xxhash64(*corpus.columns, F.lit(seed)).cast("decimal(38,0)") for seed in ("a", "b")]
    row = corpus.agg(F.count("*"), *(F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,0)") for c in cells)).first()
    return hashlib.sha256(repr((corpus.dtypes, *map(str, row))).encode()).hexdigest()[:32]


def materialise_features(corpus: DataFrame, path: str) -> DataFrame:
    """Features of a corpus as Parquet, reused while the corpus is the same.

    Every corpus has a folder named by its fingerprint, so one with another label
    or another column is extracted anew and never shows another's rows. A folder
    counts once its manifest stands, which is written last.
    """
    spark: SparkSession = corpus.sparkSession
    folder = f"{path.rstrip('/')}/{corpus_fingerprint(corpus)}"
    manifest = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest/_SUCCESS")
    if not manifest.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(manifest):
        url_features(corpus).write.mode("overwrite").parquet(f"{folder}/features")
        written = spark.read.parquet(f"{folder}/features").agg(F.count("*").alias("row_count"))
        written.coalesce(1).write.mode("overwrite").json(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/features")
