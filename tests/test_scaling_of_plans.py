"""Steps whose shuffles and tasks must not grow beside the input."""

import hashlib
import json
import math
import random
import struct
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from urlwarden.operators import listmatch, metrics, splits, training
from urlwarden.session import FIRST_PARTS, PART_BYTES, may_travel, stored, tune
from urlwarden.sources import records


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("cell, digits", [(200, 4), (1, 4), (1, 0)])
def test_folds_are_those_of_ranks_and_rows_stay(spark, monkeypatch, cell, digits):
    monkeypatch.setattr(splits, "CELL_ROWS", cell)
    monkeypatch.setattr(splits, "CELL_DIGITS", digits)
    rng = random.Random(cell)
    rows = [(f"u{rng.randrange(300)}", rng.choice("aab")) for _ in range(500)] + [("hot", "a")] * 300 + [("one", "c"), (None, "a"), ("u", None)]
    df = stored(spark.createDataFrame(rows, "url string, label string"))
    found = splits.stratified_kfold(df, 4)
    assert "hashpartitioning" not in plan_of(found) and "SortMergeJoin" not in plan_of(found)
    got = {(r.url, r.label): r.fold for r in found.collect()}
    assert found.count() == len(rows) and got[None, "a"] is None and got["u", None] is None
    for label in "abc":
        of = [u for u, y in rows if y == label and u is not None]
        hashed = sorted((hashlib.md5(f"{u}|127".encode()).hexdigest(), u) for u in of)
        n = len(of)
        ends = [k * (n // 4) + min(k, n % 4) for k in (1, 2, 3)]
        for u in set(of):
            rank = 1 + sum(h < (hashlib.md5(f"{u}|127".encode()).hexdigest(), u) for h in hashed)
            assert got[u, label] == sum(rank > end for end in ends)


def test_cells_of_hashes_stay_few():
    assert [splits.digits_for(n) for n in (0, 200, 201, 3200, 10**6, 10**9, 10**10, 10**12)] == [0, 0, 1, 1, 4, 4, 5, 7]


def test_shuffles_start_with_many_parts(spark):
    tune(spark)
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= FIRST_PARTS
    assert int(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes").rstrip("b")) <= PART_BYTES
    wide = spark.range(2_000_000).repartition(12).groupBy("id").agg(F.count("*").alias("n"))
    assert wide.select(F.spark_partition_id().alias("p")).distinct().count() > int(spark.conf.get("spark.sql.shuffle.partitions")) / 2


def test_fits_run_in_parts_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(training, "FIT_ROWS", 10)
    frame = spark.createDataFrame([(Vectors.dense([float(k)]), k % 2) for k in range(400)], ["features_vector", "label"]).coalesce(1)
    parts = training.fit_parts(frame)
    sizes = parts.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 40 and sizes[1] > 20 and parts.columns == frame.columns
    assert training.fit_parts(frame.limit(50)).count() == 50


def test_hits_of_big_lists_travel_while_they_are_few(spark):
    lists = [spark.createDataFrame([(d,) for d in some], "domain string") for some in (["h1.x1.com"], ["x2.com"], ["h3.x3.com"])]
    big = listmatch.prepare_lists(*lists, max_rows=0)
    hosts = spark.createDataFrame([(f"h{k}.x{k % 9}.com",) for k in range(300)] + [(None,)], "hostname string")
    flagged = listmatch.with_list_flags(hosts, big)
    assert "SortMergeJoin" not in plan_of(flagged) and "hashpartitioning" not in plan_of(flagged)
    got = {r.hostname: tuple(r)[1:] for r in flagged.collect()}
    assert len(got) == 301 and got["h1.x1.com"] == (True, False, False) and got["h3.x3.com"] == (False, False, True)
    assert all(got[h] == (False, True, False) for h in got if h and h.endswith(".x2.com")) and got[None] == (False, False, False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not may_travel(stored(hosts))
        assert {r.hostname: tuple(r)[1:] for r in listmatch.with_list_flags(hosts, big).collect()} == got
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_whole_records_are_not_shuffled(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text("u,v\n" + "".join(f'{name}{k},"x\n{k}"\n{name}{k}b,y\n' for k in range(50)))
    found = records.csv_records(spark, str(tmp_path))
    assert plan_of(found).count("Exchange hashpartitioning") <= 1  # of records that lie in several byte ranges
    numbers = found.groupBy("file").agg(F.count("*").alias("n"), F.count_distinct("record").alias("k"), F.max("record").alias("last")).collect()
    assert [(r.n, r.k, r.last) for r in numbers] == [(101, 101, 100)] * 2
    assert records.read_csv(spark, str(tmp_path)).where("v LIKE 'x\n%'").count() == 100


def test_places_of_scores_are_those_of_doubles(spark):
    rng, by_bits = random.Random(3), lambda b: struct.unpack("<d", struct.pack("<q", b))[0]
    near = [math.nextafter(2.0 ** k, way) for k in range(-1074, 1024) for way in (0, math.inf)] + [2.0 ** k for k in range(-1074, 1024)]
    some = [x for x in [0.0, math.inf, sys.float_info.max, *near, *(by_bits(rng.getrandbits(63)) for _ in range(3000))] if x == x]
    rows = [(x, struct.unpack("<q", struct.pack("<d", x))[0]) for x in some]
    rows += [(-x, -b) for x, b in rows]
    df = spark.createDataFrame(rows, "score double, want bigint")
    assert df.where(metrics.place(F.col("score")) != F.col("want")).count() == 0
    last = spark.createDataFrame([(math.nan,), (math.inf,)], "score double").orderBy(F.desc(metrics.place(F.col("score")))).first().score
    assert math.isnan(last)


def test_auc_of_tiny_scores_holds_few_rows_in_a_window(spark):
    """Scores of 1e-26 all fell into one cell before, and so into one window."""
    rng = random.Random(4)
    rows = [(rng.choice([-1, 1]) * rng.random() * 1e-26, rng.randrange(2)) for _ in range(2000)]
    df = stored(spark.createDataFrame(rows, "score double, label int"))
    cells = df.select(metrics.place(F.col("score")).alias("at")).groupBy(F.shiftright("at", metrics.CELL_BITS)).count()
    assert cells.agg(F.max("count")).first()[0] <= 2
    order = sorted(rows)
    neg, above = 0, 0
    for _, y in order:
        neg, above = neg + (y == 0), above + (neg if y else 0)
    assert metrics.roc_auc(df).first().auc == pytest.approx(above / (neg * (len(rows) - neg)), abs=1e-12)


FOLD_AUCS = """
import sys
repo, top = sys.argv[1:]
sys.path.insert(0, repo)
from pyspark.sql import SparkSession
from urlwarden.plans.registry import QUERIES
spark = SparkSession.builder.master("local[8]").config(map={
    "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.sql.session.timeZone": "UTC", "spark.sql.shuffle.partitions": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.checkpoint.dir": top + "/shared", "spark.local.dir": top + "/local", "spark.sql.warehouse.dir": top + "/tables",
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + top + "/events",
    "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"}).getOrCreate()
spark.range(0, 240_000, numPartitions=4).selectExpr(
    "id AS l_orderkey", "int(id % 7) AS l_linenumber", "if(xxhash64(id) % 3 = 0, 'R', 'N') AS l_returnflag",
    "0.01D AS l_discount", "0.02D AS l_tax", "double(pmod(xxhash64(id, 1), 1000000007)) AS l_extendedprice").write.parquet(top + "/lineitem.parquet")
print(*QUERIES["fold_aucs_best"].plan(spark, top).first())
"""


def test_tasks_of_fold_aucs_read_no_more_than_parts_hold(tmp_path):
    """A task read 10.8 MB of these rows while shuffles had few parts and rows were ranked; now twice the size that parts are joined up to, at most."""
    (tmp_path / "events").mkdir()
    repo = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", FOLD_AUCS, repo, str(tmp_path)], capture_output=True, text=True, timeout=300, check=True)
    fold, auc = done.stdout.split()[-2:]
    assert 1 <= int(fold) <= 5 and 0.48 < float(auc) < 0.52
    events = (json.loads(line) for file in (tmp_path / "events").iterdir() for line in file.open())
    reads = [e["Task Metrics"]["Shuffle Read Metrics"] for e in events if e["Event"] == "SparkListenerTaskEnd"]
    assert max(r["Local Bytes Read"] + r["Remote Bytes Read"] for r in reads) < 1 << 20
