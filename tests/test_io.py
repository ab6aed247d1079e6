"""Sources, sinks, streams, training and model storage."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from urlwarden.functions.features import url_features
from urlwarden.functions.vocab import FEATURE_NAMES
from urlwarden.operators import curves, explain, listmatch, training
from urlwarden.sources import models, readers, writers
from urlwarden.streaming import navigation


def test_labelled_formats(spark, tmp_path):
    (tmp_path / "a.csv").write_text('url,label\n"x,""y""",1\nb.com,NA\n"two\nlines",0\n')
    (tmp_path / "a.json").write_text(json.dumps([{"text": "a.com", "label": 1}, {"text": "b.com", "label": 0}]))
    rows = [tuple(r) for r in readers.read_labelled(spark, str(tmp_path / "a.csv")).collect()]
    assert rows == [('x,"y"', "1"), ("b.com", None), ("two\nlines", "0")]
    assert {(r.text, r.label) for r in readers.read_labelled(spark, str(tmp_path / "a.json")).collect()} == {("a.com", "1"), ("b.com", "0")}
    writers.write_merged(spark.createDataFrame([("q", 1)], "url string, label int"), str(tmp_path / "m.parquet"), "parquet")
    assert readers.read_labelled(spark, str(tmp_path / "m.parquet")).count() == 1
    with pytest.raises(ValueError):
        readers.read_labelled(spark, "a.xml")


@pytest.mark.parametrize("names,best", [
    (["z.csv", "combined_full.json", "urls.json"], "combined_full.json"), (["b.csv", "My_FULL.csv"], "My_FULL.csv"),
    (["b.parquet", "a.csv"], "a.csv"), ([".x.json", "y.json"], "y.json"), (["readme.md"], None),
])
def test_file_choice(spark, names, best):
    files = spark.createDataFrame([(n,) for n in names], "name string")
    chosen = [r.name for r in readers.choose_source_file(files).collect()]
    assert chosen == ([best] if best else [])


def test_file_listing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("url,label\n")
    assert [r.name for r in readers.list_files(spark, str(tmp_path)).collect()] == ["a.csv"]


def test_text_lists(spark, tmp_path):
    (tmp_path / "urls.txt").write_text("https://a.com\n\n  b.com \r\n\t\n")
    assert [r.url for r in readers.read_url_list(spark, str(tmp_path / "urls.txt")).collect()] == ["https://a.com", "b.com"]
    (tmp_path / "safe.json").write_text('["a.com",\n "b.com", "a.com"]')
    assert {r.domain for r in readers.read_safe_domains(spark, str(tmp_path / "safe.json")).collect()} == {"a.com", "b.com"}
    (tmp_path / "block.csv").write_text('"http://Evil.com/x"\nbad.io/path\n\n not a host \n"quoted.net"\r\nurl,date\n')
    assert {r.domain for r in readers.read_blacklist(spark, str(tmp_path / "block.csv")).collect()} == {
        "evil.com", "bad.io", "not a host", "quoted.net", "url,date"}


def test_learning_curve_file(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("iter\tAUC\tLogloss\n0\t0.95\t0.6\n5\t0.96\t0.4\n")
    (tmp_path / "l.tsv").write_text("iter\tLogloss\n0\t0.61\n")
    assert readers.long_curve(readers.read_learning_curve(spark, str(tmp_path / "t.tsv")), 1).count() == 4
    assert tuple(readers.read_learning_curve(spark, str(tmp_path / "l.tsv")).first()) == (0, None, 0.61)


def test_feature_table_is_reused_only_for_the_same_corpus(spark, tmp_path):
    path = str(tmp_path / "features")
    one = spark.createDataFrame([("a.com", 1), ("b.com", 0)], "url string, label int")
    assert writers.materialise_features(one, path).columns == ["url", "label", *FEATURE_NAMES]
    first = {p for p in (tmp_path / "features").rglob("*")}
    writers.materialise_features(one, path)
    assert {p for p in (tmp_path / "features").rglob("*")} == first
    swapped = spark.createDataFrame([("a.com", 0), ("b.com", 1)], "url string, label int")
    assert {r.url: r.label for r in writers.materialise_features(swapped, path).collect()} == {"a.com": 0, "b.com": 1}
    assert {r.url: r.label for r in writers.materialise_features(one, path).collect()} == {"a.com": 1, "b.com": 0}
    other = spark.createDataFrame([("a.com", 1), ("c.com", 0)], "url string, label int")
    assert {r.url for r in writers.materialise_features(other, path).collect()} == {"a.com", "c.com"}


def test_train_save_load_score(spark, tmp_path):
    urls = spark.range(400).select(F.concat(
        F.when(F.col("id") % 2 == 0, "https://login-verify").otherwise("https://plain"), F.col("id").cast("string"), F.lit(".com/a")).alias("url"),
        (F.col("id") % 2 == 0).cast("int").alias("label"))
    run = training.train(url_features(urls), training.GbtParams(iterations=2, depth=2), folds=2)
    assert run.train_size == 320 and run.test_size == 80 and run.metrics["roc_auc"] > 0.9
    assert run.kfold.best_fold == 1  # equal folds: the first wins
    version = models.save_model(run, str(tmp_path), "fixture", datetime(2026, 1, 2, 3, 4, 5))
    assert version == "v20260102_030405_best_fold1"
    loaded = models.load_model(str(tmp_path))
    assert tuple(models.feature_order(loaded)) == FEATURE_NAMES
    info = models.read_metadata(spark, str(tmp_path), version).first()
    assert info.best_fold == 1 and info.metrics.roc_auc == run.metrics["roc_auc"] and len(info.feature_names) == 73
    odd = spark.createDataFrame([(f"http://x{k}.com/{'ab%41' * k}?{k / 7}",) for k in range(40)], "url string")
    features = url_features(odd.union(urls.select("url").limit(5)))
    kept = training.score(features, run.kfold.best_model).select("url", "probability_phishing").collect()
    assert training.score(features, loaded).select("url", "probability_phishing").collect() == kept
    vectors = training.feature_vector(features).select("url", "features_vector").collect()
    assert loaded.transform(features).select("url", "features_vector").collect() == vectors
    record = explain.prediction_record(training.score(url_features(urls.limit(5)), loaded))
    assert record.columns == ["url", "prediction", "is_phishing", "probability_phishing", "probability_legitimate",
                              "confidence", "risk_level", "explanation", "features"]
    out = writers.write_predictions(record, str(tmp_path), datetime(2026, 1, 2))
    assert out.endswith("results_20260102_000000.csv") and spark.read.csv(out, header=True).count() == 5
    curve = curves.learning_curve(run.kfold.best_model, training.feature_vector(url_features(urls)))
    assert sorted(r.iter for r in curve.collect()) == list(range(len(run.kfold.best_model.trees)))
    assert training.feature_importance(run.kfold.best_model, spark, 3).count() == 3
    both = curves.learning_curves(run.kfold.best_model, {"learn": training.feature_vector(url_features(urls)), "test": run.holdout.sparkSession.createDataFrame(
        training.feature_vector(url_features(urls)).select("label", "features_vector").limit(50).collect())}, every=5)
    assert {r.dataset for r in both.collect()} == {"learn", "test"}


def test_patience_shortens_a_model(spark):
    urls = spark.range(300).select(F.concat(F.lit("http://h"), F.col("id").cast("string"), F.lit(".com")).alias("url"), (F.col("id") % 2).cast("int").alias("label"))
    frame = training.feature_vector(url_features(urls)).withColumn("held", F.col("url").like("%7%"))
    whole = training.fit_gbt(frame, training.GbtParams(iterations=6, depth=2, learning_rate=0.5, early_stopping_rounds=0), "held")
    cut = training.fit_gbt(frame, training.GbtParams(iterations=6, depth=2, learning_rate=0.5, early_stopping_rounds=1), "held")
    assert cut.getNumTrees <= whole.getNumTrees == 6
    shorter = training.truncated(whole, 2)
    assert shorter.getNumTrees == 2 and training.score(frame, shorter).count() == 300
    margins = curves.learning_curve(whole, frame).where("iter = 1").first()
    assert curves.learning_curve(shorter, frame).where("iter = 1").first() == margins


def test_missing_cells_of_any_format(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"url": "", "label": 1}, {"url": null, "label": 0}, {"url": "NA", "label": 1}, {"url": "x.com", "label": "null"}, {"url": "y.com", "label": 1}]')
    frame = readers.read_labelled(spark, str(tmp_path / "a.json"))
    assert [(r.url, r.label) for r in frame.collect()] == [(None, "1"), (None, "0"), (None, "1"), ("x.com", None), ("y.com", "1")]
    stored = readers.as_parquet(spark, str(tmp_path / "a.json"), str(tmp_path / "stored"))
    assert stored.collect() == readers.as_parquet(spark, "nowhere.json", str(tmp_path / "stored")).collect()
    frame.write.parquet(str(tmp_path / "b.parquet"))
    assert readers.read_labelled(spark, str(tmp_path / "b.parquet")).where("url IS NOT NULL").count() == 2


def test_few_snapshots_stay(spark, tmp_path):
    for k in range(6):
        events(spark).limit(1).write.mode("append").json(str(tmp_path / "events"))
    lists = listmatch.prepare_lists(*(one_column(spark, d) for d in ("good.com", "safe.org", "evil.io")))
    stream = navigation.navigation_stream(spark, str(tmp_path / "events"), maxFilesPerTrigger=1)
    counters = navigation.stream_counters(navigation.stream_verdicts(stream, lists))
    navigation.persist_counters(counters, str(tmp_path / "counters"), str(tmp_path / "ck")).awaitTermination()
    assert len(list((tmp_path / "counters").glob("batch=*"))) == navigation.KEPT_SNAPSHOTS
    assert navigation.load_counters(spark, str(tmp_path / "counters")).first().sites_checked == 6


def events(spark):
    return spark.createDataFrame([
        (1, "complete", "http://good.com/a", 0), (1, "loading", "http://evil.io/", 1), (2, "complete", "http://evil.io/", 2),
        (2, "complete", "chrome://settings", 3), (3, "complete", "http://other.net/", 4),
    ], "tab_id bigint, status string, url string, n int").selectExpr("tab_id", "status", "url", "timestamp_seconds(n) AS ts")


def one_column(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "domain string")


def test_stream_counters(spark, tmp_path):
    events(spark).repartition(3).write.json(str(tmp_path / "events"))
    lists = listmatch.prepare_lists(one_column(spark, "good.com"), one_column(spark, "safe.org"), one_column(spark, "evil.io"))
    stream = navigation.navigation_stream(spark, str(tmp_path / "events"), maxFilesPerTrigger=1)
    counters = navigation.stream_counters(navigation.stream_verdicts(stream, lists))
    navigation.persist_counters(counters, str(tmp_path / "counters"), str(tmp_path / "ck")).awaitTermination()
    assert tuple(navigation.load_counters(spark, str(tmp_path / "counters")).first()) == (3, 1, 1)


def test_changing_whitelist(spark, tmp_path):
    events(spark).write.json(str(tmp_path / "events"))
    ops = spark.createDataFrame([
        (1, "add", "https://www.evil.io/x"), (2, "add", "http://gone.com"), (3, "remove", "gone.com"), (4, "add", "broken"),
        (5, "add", "http://kept.com"), (6, "remove", "www.kept.com"),
    ], navigation.OPS_SCHEMA)
    assert {r.domain for r in navigation.whitelist_state(ops).collect()} == {"evil.io", "kept.com"}
    stream = navigation.navigation_stream(spark, str(tmp_path / "events"))
    navigation.run_with_changing_whitelist(
        stream, lambda: ops, one_column(spark, "s.org"), one_column(spark, "evil.io"),
        lambda df, i: df.write.mode("overwrite").parquet(str(tmp_path / "out" / f"batch={i}")), str(tmp_path / "ck"),
    ).awaitTermination()
    got = {r.url: r.reason for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got["http://evil.io/"] == "whitelist" and got["http://other.net/"] == "model_not_loaded"
