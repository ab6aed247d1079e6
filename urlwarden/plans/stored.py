"""Queries that write through the library and read back, over files, models and list state."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from urlwarden.functions.features import url_features
from urlwarden.functions.vocab import FEATURE_NAMES
from urlwarden.operators import boosting, explain, ingest, scaling, training
from urlwarden.operators.metrics import binary_metrics, roc_auc
from urlwarden.plans import corpora, fitted
from urlwarden.plans.oracle import features_sql
from urlwarden.plans.registry import (
    _NORMALISED_SQL, _OPS_SQL, _SCORED_SQL, _scratch, merged, register, rounded, whitelist_ops,
)
from urlwarden.sources import models, readers, records, writers
from urlwarden.streaming import liststate, navigation

# What stands for a missing cell, as the reader takes it.
_MISSING = """text IS NULL OR text IN ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA',
'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"""


@register("csv_in_ranges", f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS digest, length(text) AS n_chars FROM documents WHERE NOT ({_MISSING})")
def csv_in_ranges(spark, sf_dir):
    """Whole documents as quoted cells with line breaks, read by the tasks that find the records' ends."""
    folder = _scratch(spark, "csv")
    docs = corpora.spread(corpora.table(spark, sf_dir, "documents").select("doc_id", "text"))
    docs.write.csv(folder, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    back = readers.read_labelled(spark, folder, "csv", in_ranges=True).where("text IS NOT NULL")
    return back.select("doc_id", F.md5("text").alias("digest"), F.length("text").cast("bigint").alias("n_chars"))


@register("json_in_ranges", "SELECT page_id, md5(url || html) AS digest, length(html) AS n_chars FROM pages")
def json_in_ranges(spark, sf_dir):
    """Pages with their source text, braces and quotes in it, as JSON objects."""
    folder = _scratch(spark, "json")
    corpora.spread(corpora.table(spark, sf_dir, "pages").select("page_id", "url", "html")).write.json(folder)
    back = records.read_json(spark, folder, ["page_id", "url", "html"])
    return back.select(F.col("page_id").cast("bigint").alias("page_id"), F.md5(F.concat("url", "html")).alias("digest"),
                       F.length("html").cast("bigint").alias("n_chars"))


@register("merged_file", f"WITH {_NORMALISED_SQL} SELECT url, CAST(label AS VARCHAR) AS label FROM merged")
def merged_file(spark, sf_dir):
    """The merged corpus written and read again."""
    folder = _scratch(spark, "merged")
    writers.write_merged(merged(spark, sf_dir), folder)
    return readers.read_labelled(spark, folder, "csv", in_ranges=True).select("url", "label")


@register("predictions_file", f"""{_SCORED_SQL} SELECT md5(url) AS url, prediction, CAST(prediction = 1 AS VARCHAR) AS is_phishing,
round(score, 6) AS probability_phishing, CAST(url_length AS BIGINT) AS length_feature, CAST(has_sensitive_words AS BIGINT) AS words_feature FROM scored""")
def predictions_file(spark, sf_dir):
    """Prediction records as a results file, read again, two features out of their JSON text. Some addresses hold line ends."""
    features = url_features(corpora.addresses(spark, sf_dir).where("url <> ''"))
    found = explain.prediction_record(corpora.rule_scorer(features), "en")
    path = writers.write_predictions(found, _scratch(spark, "results"), datetime(2026, 1, 1))
    back = records.read_csv(spark, path)

    def feature(name: str):
        return F.get_json_object("features", f"$.{name}").cast("bigint")

    return rounded(back.select(
        F.md5("url").alias("url"), F.col("prediction").cast("int").alias("prediction"), "is_phishing",
        F.col("probability_phishing").cast("double").alias("probability_phishing"),
        feature("url_length").alias("length_feature"), feature("has_sensitive_words").alias("words_feature")))


@register("curve_file", """WITH curve AS (SELECT CAST(l_orderkey % 97 AS INTEGER) AS iter, avg(l_discount) AS AUC, avg(l_tax) AS Logloss FROM lineitem GROUP BY 1)
SELECT 1 AS fold, iter, 'AUC' AS metric, round(AUC, 6) AS value FROM curve UNION ALL SELECT 1, iter, 'Logloss', round(Logloss, 6) FROM curve""")
def curve_file(spark, sf_dir):
    """A learning curve as the tab-separated log of a training run, read again in long form."""
    folder = _scratch(spark, "curve")
    items = corpora.table(spark, sf_dir, "lineitem")
    curve = items.groupBy((F.col("l_orderkey") % 97).cast("int").alias("iter")).agg(F.avg("l_discount").alias("AUC"), F.avg("l_tax").alias("Logloss"))
    curve.write.csv(folder, sep="\t", header=True)
    return rounded(readers.long_curve(readers.read_learning_curve(spark, folder), 1))


@register("paired_rows", f"""WITH {features_sql(('url_length', 'has_port'), keep=('url',), addresses=corpora.ADDRESSES_SQL)}, {_NORMALISED_SQL}
SELECT url, label, url_length, has_port FROM merged JOIN (SELECT DISTINCT * FROM feats) USING (url) WHERE url_length IS NOT NULL""")
def paired_rows(spark, sf_dir):
    """Features and labels stay in one row: no join pairs them. The address column must be there."""
    corpus = ingest.require_column(merged(spark, sf_dir), "url")
    known = corpora.addresses(spark, sf_dir).select("url").distinct()
    features = url_features(corpus.join(known, "url", "left_semi"), features=("url_length", "has_port"))
    return features.select("url", "label", "url_length", "has_port").where("url_length IS NOT NULL")


def stump_run(spark, sf_dir):
    """A training run over marks, as ``save_model`` takes it."""
    marks = fitted.marked(spark, sf_dir)
    done = boosting.boost(marks.where("NOT held"), fitted.ROUNDS, fitted.RATE, depth=1)
    columns = marks.drop("features_vector").join(
        url_features(marks.select("url"), features=fitted.MARKS), "url").checkpoint()
    model = PipelineModel([VectorAssembler(inputCols=list(fitted.MARKS), outputCol="features_vector"), done.model])
    holdout = training.score(columns.where("held"), model).checkpoint()
    row = binary_metrics(holdout).first().asDict()
    numbers = {k: float(row[k]) for k in ("accuracy", "precision", "recall", "f1_score")}
    numbers["roc_auc"] = roc_auc(holdout, "label", "probability_phishing").first()["auc"]
    fold = training.KFoldResult(spark.createDataFrame([(1, numbers["roc_auc"])], "fold int, auc double"), 1, numbers["roc_auc"], done.model)
    params = training.GbtParams(iterations=fitted.ROUNDS, learning_rate=fitted.RATE, depth=1)
    run = training.TrainingRun(model, fold, numbers, marks.where("NOT held").count(), holdout.count(), holdout, params)
    return run, columns


_LEARNED = f"""{fitted._STUMPS}, {fitted.curve_sql(fitted.ROUNDS, 'nv')},
judged AS (SELECT sum(nt) AS train_size, sum(nv) AS test_size, sum(nv) FILTER (m > 0 AND y = 1) AS tp, sum(nv) FILTER (m <= 0 AND y = -1) AS tn FROM m{fitted.ROUNDS})"""


@register("model_round_trip", f"""{_LEARNED} SELECT 'v20260101_000000_best_fold1' AS version, 'addresses' AS dataset, train_size::BIGINT AS train_size,
test_size::BIGINT AS test_size, round((tp + tn) / test_size, 6) AS accuracy, round(AUC, 6) AS roc_auc, '1' AS depth, {len(FEATURE_NAMES)}::INTEGER AS features,
(train_size + test_size)::BIGINT AS scored, 0::BIGINT AS different FROM judged, curve WHERE iter = {fitted.ROUNDS - 1}""")
def model_round_trip(spark, sf_dir):
    """Saved, then saved again without its pointer, then read through ``latest``: the first version, scoring as before."""
    run, rows = stump_run(spark, sf_dir)
    root = _scratch(spark, "models")
    models.save_model(run, root, "addresses", datetime(2026, 1, 1))
    models.save_model(run, root, "later", datetime(2026, 1, 2))
    models.write_pointer(spark, root, "v20260101_000000_best_fold1")
    loaded = models.load_model(root)
    before, after = (training.score(rows, m).select("url", F.col("probability_phishing").alias(name)) for m, name in ((run.model, "a"), (loaded, "b")))
    same = before.join(after, "url").agg(F.count("*").alias("scored"), F.count_if(F.col("a") != F.col("b")).alias("different"))
    info = models.read_metadata(spark, root)
    return rounded(info.select(
        "version", "dataset", "train_size", "test_size", "metrics.accuracy", "metrics.roc_auc", F.col("model_params")["depth"].alias("depth"),
        F.size("feature_names").alias("features")).join(F.broadcast(same)))  # one row each


@register("feature_moments", f"""WITH {features_sql(FEATURE_NAMES, addresses=corpora.ADDRESSES_SQL, exact=True)}, rows AS (SELECT * FROM feats WHERE url <> '')
{' UNION ALL '.join(f"SELECT '{n}' AS feature, count({n}) AS n, round(avg({n}::DOUBLE), 4) AS mean, round(stddev_pop({n}::DOUBLE), 4) AS deviation, round(min({n})::DOUBLE, 4) AS least, round(max({n})::DOUBLE, 4) AS most FROM rows" for n in FEATURE_NAMES)}""")
def feature_moments(spark, sf_dir):
    """What a scaler is fitted on, from one pass."""
    features = url_features(corpora.addresses(spark, sf_dir).where("url <> ''"))
    table = scaling.moments(features, FEATURE_NAMES)
    return table.select("feature", "n", *(F.round(c, 4).alias(c) for c in ("mean", "deviation", "least", "most")))


@register("scaled_scores", f"""{fitted._STUMPS} SELECT url, round(1 / (1 + exp(-2 * m)), 6) AS plain, round(1 / (1 + exp(-2 * m)), 6) AS scaled
FROM marked JOIN (SELECT DISTINCT {', '.join(fitted.MARKS)}, m FROM m{fitted.ROUNDS}) USING ({', '.join(fitted.MARKS)})""")
def scaled_scores(spark, sf_dir):
    """Trees over marks and over scaled marks give every address the same score."""
    run, rows = stump_run(spark, sf_dir)
    scale = scaling.scaler(scaling.moments(rows.where("NOT held"), fitted.MARKS))
    assemble = VectorAssembler(inputCols=[scaling.SCALED + m for m in fitted.MARKS], outputCol="features_vector")
    front = PipelineModel([scale, assemble])
    checked = front.transform(rows).select("url", "label", "held", "features_vector").checkpoint()
    model = boosting.boost(checked.where("NOT held"), fitted.ROUNDS, fitted.RATE, depth=1).model
    plain = training.score(rows, run.model).select("url", F.col("probability_phishing").alias("plain"))
    scaled = training.score(rows, PipelineModel([scale, assemble, model])).select("url", F.col("probability_phishing").alias("scaled"))
    return rounded(plain.join(scaled, "url"))


@register("whitelist_stream", f"WITH {_OPS_SQL} SELECT domain, CAST(max(seq) AS BIGINT) AS seq FROM changes GROUP BY domain HAVING max_by(op, seq) = 'add'")
def whitelist_stream(spark, sf_dir):
    """The list after a stream of changes in two runs of the query, the second knowing only the stored state."""
    folder = _scratch(spark, "list")
    ops = whitelist_ops(spark, sf_dir)
    for part in (0, 1):
        ops.where(F.col("seq") % 2 == part).write.mode("append").parquet(f"{folder}/ops")
        stream = spark.readStream.schema(navigation.OPS_SCHEMA).option("maxFilesPerTrigger", 4).parquet(f"{folder}/ops")
        state = liststate.ListState(spark, f"{folder}/state")
        navigation.keep_whitelist(stream, state, f"{folder}/checkpoint").awaitTermination()
    return liststate.ListState(spark, f"{folder}/state").latest().where("added").select("domain", "seq")
