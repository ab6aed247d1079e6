"""Queries that train, with SQL that trains again.

Boosted stumps over marks that are 0 or 1 can be fitted by SQL: rows fall into a few
hundred patterns, and a round is the mark whose two halves have the largest sum of
squared gradient sums over sizes. So what is learned, the round at which patience
ends, the curves and the scores are checked, not only that training runs.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlwarden.functions.features import url_features
from urlwarden.operators import curves, splits, training, trees
from urlwarden.operators.boosting import Boosted, boost
from urlwarden.plans import corpora
from urlwarden.plans.oracle import features_sql
from urlwarden.plans.registry import register, rounded
from urlwarden.session import stored

MARKS = ("has_ip_address", "has_at_symbol", "has_https", "has_port", "has_email_format", "has_sensitive_words", "has_suspicious_tld", "has_url_shortener")
TRUTH_FEATURES = ("has_sensitive_words", "has_multiple_domains", "url_length", "has_suspicious_tld")
RATE, ROUNDS, PATIENCE = 0.4, 6, 2
FOLDS, FOLD_ROUNDS = 3, 2
HELD = "substr(md5(url), 1, 1) < '4'"


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url, label, held, features_vector`` of the distinct addresses, the vector of ``MARKS`` alone."""
    features = url_features(corpora.addresses(spark, sf_dir).select("url").where("url <> ''").distinct())
    rows = features.where(F.col(MARKS[0]).isNotNull()).select("url", F.expr(corpora.TRUTH).alias("label"), F.expr(HELD).alias("held"), *MARKS)
    assembled = VectorAssembler(inputCols=list(MARKS), outputCol="features_vector").transform(rows)
    return stored(assembled.select("url", "label", "held", "features_vector"))


def fit(frame: DataFrame, rounds: int = ROUNDS, validation: str | None = "held", patience: int = 0) -> Boosted:
    return boost(frame, rounds, RATE, depth=1, validation=validation, patience=patience)


# Training by SQL: `rows` has url, label, f (which fit), learns (whether that fit learns from it) and the marks.
_MARKED_SQL = f"""{features_sql(tuple(dict.fromkeys((*MARKS, *TRUTH_FEATURES))), keep=('url',), addresses=corpora.ADDRESSES_SQL)},
marked AS (SELECT DISTINCT url, {corpora.TRUTH} AS label, {', '.join(MARKS)} FROM feats WHERE url <> '' AND {MARKS[0]} IS NOT NULL)"""


def stumps_sql(rows: str, rounds: int) -> str:
    """Common table expressions ``b0, b1, ...`` (``f, j, lo, hi``: the mark, counted from 0, and the leaves of a round) and
    ``m0, m1, ...`` (``f``, the marks, ``y``, rows learned from and held, the margin ``m`` before that round, the gradient ``r``)."""
    marks = ", ".join(MARKS)
    parts = [f"""patterns AS (SELECT f, {marks}, 2 * label - 1 AS y, count(*) FILTER (learns) AS nt, count(*) FILTER (NOT learns) AS nv
    FROM ({rows}) GROUP BY ALL),
m0 AS (SELECT *, 0::DOUBLE AS m, y::DOUBLE AS r FROM patterns)"""]
    for k in range(rounds):
        sides = ", ".join(f"{{'j': {j}, 'x': {name}}}" for j, name in enumerate(MARKS))
        parts.append(f"""
b{k} AS (SELECT f, j, s0 / n0 AS lo, s1 / n1 AS hi FROM (
    SELECT f, side.j AS j, sum(nt * r) FILTER (side.x = 0) AS s0, sum(nt * r) FILTER (side.x = 1) AS s1,
        sum(nt) FILTER (side.x = 0) AS n0, sum(nt) FILTER (side.x = 1) AS n1
    FROM (SELECT f, nt, r, unnest([{sides}]) AS side FROM m{k}) GROUP BY ALL) WHERE n0 > 0 AND n1 > 0
    QUALIFY row_number() OVER (PARTITION BY f ORDER BY s0 * s0 / n0 + s1 * s1 / n1 DESC, j) = 1),
m{k + 1} AS (SELECT * REPLACE (4 * y / (1 + exp(2 * y * m)) AS r) FROM (
    SELECT m{k}.* REPLACE (m + {1.0 if k == 0 else RATE} * CASE WHEN [{marks}][j + 1] = 1 THEN hi ELSE lo END AS m) FROM m{k} JOIN b{k} USING (f)))""")
    return ",".join(parts)


def curve_sql(rounds: int, weight: str) -> str:
    """``curve`` (``f, iter, AUC, Logloss``) over rows counted by ``weight``."""
    each = " UNION ALL ".join(f"SELECT f, {k} AS iter, y, m, {weight} AS n FROM m{k + 1} WHERE {weight} > 0" for k in range(rounds))
    return f"""staged AS ({each}),
levels AS (SELECT f, iter, m, coalesce(sum(n) FILTER (y = 1), 0) AS pos, coalesce(sum(n) FILTER (y = -1), 0) AS neg, sum(n * ln(1 + exp(-2 * y * m))) AS loss
    FROM staged GROUP BY ALL),
below AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY f, iter ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM levels),
curve AS (SELECT f, iter, sum(pos * (2 * before + neg))::DOUBLE / nullif(2 * sum(pos) * sum(neg), 0) AS AUC, sum(loss) / sum(pos + neg) AS Logloss
    FROM below GROUP BY f, iter)"""


_ONE_FIT = f"SELECT *, 0 AS f, NOT ({HELD}) AS learns FROM marked"
_STUMPS = f"WITH {_MARKED_SQL}, {stumps_sql(_ONE_FIT, ROUNDS)}"
_MARK_NAMES = f"[{', '.join(repr(m) for m in MARKS)}]"
_ALL_STUMPS = " UNION ALL ".join(
    f"SELECT {k}::INTEGER AS tree, {_MARK_NAMES}[j + 1] AS feature, 0.5::DOUBLE AS threshold, round(lo, 6) AS lower_value, "
    f"round(hi, 6) AS upper_value, {1.0 if k == 0 else RATE}::DOUBLE AS weight FROM b{k}" for k in range(ROUNDS))


@register("boosted_stumps", f"{_STUMPS} {_ALL_STUMPS}")
def boosted_stumps(spark, sf_dir):
    """The fitted trees, read from the table of their nodes."""
    marks = marked(spark, sf_dir)
    nodes = trees.tree_table(fit(marks.where("NOT held"), validation=None).model)
    leaves = nodes.select("tree", F.col("node").alias("leaf"), "value")
    lower, upper = (leaves.toDF("tree", side, f"{side}_value") for side in ("lower", "upper"))
    names = F.array(*map(F.lit, MARKS))
    told = nodes.where("feature >= 0").join(lower, ["tree", "lower"]).join(upper, ["tree", "upper"])
    return rounded(told.select("tree", F.get(names, "feature").alias("feature"), "threshold", "lower_value", "upper_value", "weight"))


@register("boosting_stop", f"""{_STUMPS}, {curve_sql(ROUNDS, 'nv')},
so_far AS (SELECT iter, max(AUC) OVER (ORDER BY iter) AS best FROM curve),
bests AS (SELECT iter, best, (SELECT min(c.iter) FROM curve c WHERE c.AUC = s.best) AS best_iter FROM so_far s),
ends AS (SELECT coalesce(min(iter) FILTER (iter - best_iter >= {PATIENCE}), max(iter)) AS stop FROM bests)
SELECT (stop + 1)::INTEGER AS fitted, best_iter::INTEGER AS best_iter, round(best, 6) AS best_auc FROM bests JOIN ends ON iter = stop""")
def boosting_stop(spark, sf_dir):
    """Rounds fitted until patience ends, and the best one."""
    done = fit(marked(spark, sf_dir), patience=PATIENCE)
    best = [(done.fitted, done.best_iter, done.curve[done.best_iter][1])]
    return rounded(spark.createDataFrame(best, "fitted int, best_iter int, best_auc double"))


@register("stump_curves", f"""{_STUMPS}, {curve_sql(ROUNDS, 'nt')}
SELECT 'learn' AS dataset, iter::INTEGER AS iter, round(AUC, 6) AS AUC, round(Logloss, 6) AS Logloss FROM curve
UNION ALL SELECT dataset, iter, AUC, Logloss FROM (WITH {curve_sql(ROUNDS, 'nv')}
SELECT 'test' AS dataset, iter::INTEGER AS iter, round(AUC, 6) AS AUC, round(Logloss, 6) AS Logloss FROM curve)""")
def stump_curves(spark, sf_dir):
    """Both curves of a model from histograms of its margins."""
    marks = marked(spark, sf_dir)
    nodes = trees.tree_table(fit(marks.where("NOT held"), validation=None).model)
    return rounded(curves.learning_curves(nodes, {"learn": marks.where("NOT held"), "test": marks.where("held")}))


@register("stump_scores", f"""{_STUMPS} SELECT url, (m > 0)::INTEGER AS prediction, round(1 / (1 + exp(-2 * m)), 6) AS probability_phishing,
round(1 - 1 / (1 + exp(-2 * m)), 6) AS probability_legitimate
FROM marked JOIN (SELECT DISTINCT {', '.join(MARKS)}, m FROM m{ROUNDS}) USING ({', '.join(MARKS)})""")
def stump_scores(spark, sf_dir):
    """Every address scored by the table of trees."""
    marks = marked(spark, sf_dir)
    nodes = trees.tree_table(fit(marks.where("NOT held"), validation=None).model)
    return rounded(trees.score_by_table(marks.drop("label", "held"), nodes))


_FOLD_RANKS = """folded AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY md5(url || '|127') || url) - 1) AS r0, count(*) OVER (PARTITION BY label) AS n FROM marked),
dealt AS (SELECT *, CASE WHEN r0 < (n % 3) * (n // 3 + 1) THEN r0 // (n // 3 + 1) ELSE n % 3 + (r0 - (n % 3) * (n // 3 + 1)) // greatest(n // 3, 1) END AS fold FROM folded)"""
_FOLD_FITS = "SELECT d.*, f.f, d.fold <> f.f AS learns FROM dealt d CROSS JOIN (SELECT unnest(range(3)) AS f) f"


@register("stump_folds", f"""WITH {_MARKED_SQL}, {_FOLD_RANKS}, {stumps_sql(_FOLD_FITS, FOLD_ROUNDS)}, {curve_sql(FOLD_ROUNDS, 'nv')}
SELECT (f + 1)::INTEGER AS fold, round(AUC, 6) AS auc, AUC = max(AUC) OVER () AS best FROM curve WHERE iter = {FOLD_ROUNDS - 1}""")
def stump_folds(spark, sf_dir):
    """One model for each fold, judged on the fold."""
    frame = splits.stratified_kfold(marked(spark, sf_dir).drop("held"), FOLDS)
    params = training.GbtParams(iterations=FOLD_ROUNDS, learning_rate=RATE, depth=1, early_stopping_rounds=0)
    run = training.kfold_train(frame, params, FOLDS)
    return rounded(run.aucs.withColumn("best", F.col("auc") == F.lit(run.best_auc)))
