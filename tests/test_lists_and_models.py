"""Prefiltered lists, list state that survives a restart, atomic model versions, scaled vectors."""

import pytest
from pyspark.sql import functions as F

from urlwarden.functions.features import url_features
from urlwarden.functions.vocab import FEATURE_NAMES
from urlwarden.operators import listmatch, prefilter, scaling, training
from urlwarden.sources import models
from urlwarden.streaming import liststate, navigation


def domains(spark, names):
    return spark.createDataFrame([(n,) for n in names], "domain string")


def test_filter_has_every_key_and_few_others(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("d"), "id", F.lit(".com")).alias("domain"))
    made = prefilter.build(keys, "domain", 20_000)
    assert made.size == 5_000 and made.words.count() == 1 and len(made.words.first()["words"]) == 5_000
    probes = spark.range(60_000).select("id", F.array(F.concat(F.lit("d"), "id", F.lit(".com")), F.lit(None).cast("string")).alias("keys"))
    told = prefilter.maybe_any(probes, made, F.col("keys"), "maybe").groupBy((F.col("id") < 20_000).alias("inside")).agg(F.avg(F.col("maybe").cast("int")).alias("share"))
    shares = {r["inside"]: r["share"] for r in told.collect()}
    assert shares[True] == 1.0 and shares[False] < 0.03
    none = prefilter.maybe_any(probes.limit(1), made, F.lit(None).cast("array<string>"), "maybe").first()
    assert none["maybe"] is False


def test_filter_merges_and_is_not_built_too_large(spark, monkeypatch):
    keys = spark.range(300).select(F.col("id").cast("string").alias("domain"))
    one, many = (prefilter.build(keys.repartition(n), "domain", 300).words.first()["words"] for n in (1, 9))
    assert one == many
    monkeypatch.setattr(prefilter, "MAX_WORDS", 10)
    assert prefilter.build(keys, "domain", 300) is None


def test_prefiltered_rows_and_hits(spark):
    listed = [f"site{k}.example.com" for k in range(0, 3000, 3)]
    safe, white, black = domains(spark, listed + ["parent.org"]), domains(spark, ["mine.net", None]), domains(spark, ["site1.example.com"])
    big = listmatch.prepare_lists(white, safe, black, max_rows=0)
    small = listmatch.prepare_lists(white, safe, black)
    assert not big.small and big.prefilter is not None and small.prefilter is None
    hosts = [f"www.site{k}.example.com" for k in range(3000)] + ["a.b.parent.org", "mine.net", None, "", "parent.org.evil.io"] + ["hot.unlisted.io"] * 3000
    visits = spark.createDataFrame([(k, h) for k, h in enumerate(hosts)], "id bigint, hostname string").repartition(6).checkpoint()
    flags = [{tuple(r) for r in listmatch.with_list_flags(visits, lists).collect()} for lists in (big, small)]
    assert flags[0] == flags[1] and len(flags[0]) == len(hosts)
    maybe = listmatch.may_be_listed(visits, big, "hostname").where("__maybe")
    hits = sum(any(r[2:]) for r in flags[0])
    assert hits <= maybe.count() < hits + 0.03 * len(hosts)
    assert maybe.where("hostname = 'hot.unlisted.io'").count() in (0, 3000)


def test_state_of_a_list_survives_a_restart(spark, tmp_path):
    events, ops_dir, read = tmp_path / "events", tmp_path / "ops", []

    def visit(k):
        spark.createDataFrame([(k, "complete", "http://evil.io/")], "tab_id bigint, status string, url string").coalesce(1).write.mode("append").json(str(events))

    def change(*rows):
        spark.createDataFrame(list(rows), navigation.OPS_SCHEMA).coalesce(1).write.mode("append").parquet(str(ops_dir))

    def run():
        """A new query, which knows nothing of the one before it."""
        stream = navigation.navigation_stream(spark, str(events), schema="tab_id bigint, status string, url string")
        navigation.run_with_changing_whitelist(
            stream, lambda: spark.read.parquet(str(ops_dir)), domains(spark, ["s.org"]), domains(spark, ["evil.io"]),
            lambda df, i: read.append((i, [r["reason"] for r in df.collect()])), str(tmp_path / "ck")).awaitTermination()
        return read[-1][1]

    change((1, "add", "http://other.com"), (2, "add", "broken"))
    visit(1)
    assert run() == ["blacklist"]
    state = liststate.ListState(spark, f"{tmp_path / 'ck'}-list")
    assert state.versions() == [0] and state.seen(0) == 1
    change((3, "add", "http://evil.io/x"))
    visit(2)
    assert run() == ["whitelist"]
    assert state.versions() == [0, 1] and state.seen(1) == 3 and state.read(1).count() == 2
    visit(3)  # no change: no new version
    assert run() == ["whitelist"] and state.versions() == [0, 1]
    change((4, "remove", "evil.io"))
    visit(4)
    assert run() == ["blacklist"] and {r["domain"] for r in navigation.listed(state.latest()).collect()} == {"other.com"}


def test_a_restart_reads_new_changes_only(spark, tmp_path):
    state = liststate.ListState(spark, str(tmp_path / "list"))
    rows = spark.range(1, 2001).select(F.col("id").alias("seq"), F.lit("add").alias("op"), F.concat(F.lit("d"), (F.col("id") % 700)).alias("domain"))
    state.advance(0, rows.where("seq <= 1500"))
    again = liststate.ListState(spark, str(tmp_path / "list"))
    assert again.seen(again.before(1)) == 1500
    fresh = rows.where(F.col("seq") > again.seen(again.before(1)))
    assert fresh.count() == 500 and again.advance(1, fresh) == 1
    assert again.latest().count() == 700 and again.seen(1) == 2000
    assert again.advance(2, fresh.limit(0)) == 1 and again.versions() == [0, 1]


def test_a_repeated_batch_starts_from_the_version_before(spark, tmp_path):
    state = liststate.ListState(spark, str(tmp_path / "list"))
    columns = "seq bigint, op string, domain string"
    for batch in range(5):
        state.advance(batch, spark.createDataFrame([(batch, "add", f"d{batch}")], columns))
    assert state.versions() == [2, 3, 4]
    state.advance(4, spark.createDataFrame([(9, "remove", "d0"), (4, "add", "e4")], columns))
    assert {r["domain"] for r in navigation.listed(state.latest()).collect()} == {"d1", "d2", "d3", "e4"} and state.versions() == [2, 3, 4]
    assert state.advance(5, spark.createDataFrame([], columns)) == 4


def test_stream_of_changes_in_any_order(spark, tmp_path):
    rows = [(k, "remove" if k % 5 == 0 else "add", f"d{k % 11}" if k % 5 == 0 else f"http://www.d{k % 11}/x") for k in range(60)]
    ops = spark.createDataFrame(rows, navigation.OPS_SCHEMA)
    state = liststate.ListState(spark, str(tmp_path / "list"))
    for part in (ops.where("seq % 3 = 1"), ops.where("seq % 3 <> 1")):
        part.repartition(2).write.mode("append").parquet(str(tmp_path / "ops"))
        stream = spark.readStream.schema(navigation.OPS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "ops"))
        navigation.keep_whitelist(stream, state, str(tmp_path / "ck")).awaitTermination()
    assert {r["domain"] for r in navigation.listed(state.latest()).collect()} == {r["domain"] for r in navigation.whitelist_state(ops).collect()}


@pytest.fixture(scope="module")
def run(spark):
    urls = spark.range(240).select(F.concat(F.lit("http://h"), F.col("id"), F.when(F.col("id") % 2 == 0, ".tk/login").otherwise(".com/")).alias("url"),
                                   (F.col("id") % 2 == 0).cast("int").alias("label"))
    features = url_features(urls).checkpoint()
    params = training.GbtParams(iterations=2, depth=2, learning_rate=0.5, early_stopping_rounds=0)
    return features, training.train(features, params, folds=2, scale=True)


def test_a_failure_between_the_steps_leaves_the_old_version(spark, tmp_path, monkeypatch, run):
    from datetime import datetime

    root = str(tmp_path / "models")
    first = models.save_model(run[1], root, "a", datetime(2026, 1, 1))
    assert models.current_version(spark, root) == first
    wanted = models.read_metadata(spark, root).first()
    plain = models.write_pointer
    monkeypatch.setattr(models, "write_pointer", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        models.save_model(run[1], root, "b", datetime(2026, 1, 2))
    assert models.current_version(spark, root) == first and models.read_metadata(spark, root).first() == wanted
    monkeypatch.setattr(models, "write_pointer", plain)
    monkeypatch.setattr(models, "move", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        models.save_model(run[1], root, "c", datetime(2026, 1, 3))
    monkeypatch.undo()
    assert models.current_version(spark, root) == first and models.load_model(root).stages
    assert not [p for p in (tmp_path / "models").iterdir() if p.name.startswith(".draft")]
    second = models.save_model(run[1], root, "d", datetime(2026, 1, 4))
    assert models.current_version(spark, root) == second and models.read_metadata(spark, root, first).first() == wanted
    with pytest.raises(Exception):
        models.save_model(run[1], root, "e", datetime(2026, 1, 4))
    assert models.read_metadata(spark, root).first()["dataset"] == "d"


def test_scaled_pipeline_is_saved_and_scores_alike(spark, tmp_path, run):
    features, trained = run
    assert any(scaling.SCALED in s.getStatement() for s in trained.model.stages if hasattr(s, "getStatement"))
    trained.model.write().save(str(tmp_path / "m"))
    from pyspark.ml import PipelineModel

    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert tuple(models.feature_order(loaded)) == FEATURE_NAMES
    one, two = ({r["url"]: r["probability_phishing"] for r in training.score(features, m).collect()} for m in (trained.model, loaded))
    assert one == two and len(one) == 240
    assert training.feature_stages()[1].getInputCols()[0] == training.feature_stages()[1].getInputCols()[0].removeprefix(scaling.SCALED)


def test_moments_and_scaler_of_odd_columns(spark):
    df = spark.createDataFrame([(1.0, None, 5), (3.0, None, 5), (None, None, 5)], "a double, b double, c int")
    table = scaling.moments(df, ["a", "b", "c"])
    got = {r["feature"]: tuple(r)[1:] for r in table.collect()}
    assert got == {"a": (2, 2.0, 1.0, 1.0, 3.0), "b": (0, None, None, None, None), "c": (3, 5.0, 0.0, 5.0, 5.0)}
    scaled = scaling.scaler(table).transform(df)
    assert [tuple(r) for r in scaled.select("std_a", "std_b", "std_c").collect()] == [(-1.0, None, 0.0), (1.0, None, 0.0), (None, None, 0.0)]
    assert scaling.moments(df.limit(0), ["a"]).first()["n"] == 0
