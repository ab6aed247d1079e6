"""Tables of trees, curves from histograms, and boosting that stops."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from urlwarden.operators import boosting, curves, splits, training, trees
from urlwarden.operators.metrics import roc_auc
from urlwarden.plans import registry


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.random((600, 4)), 1)
    y = (x[:, 0] + 0.6 * x[:, 1] + 0.4 * rng.random(600) > 1.0).astype(int)
    data = [(row.tolist(), int(label), bool(k % 4 == 0)) for k, (row, label) in enumerate(zip(x, y))]
    frame = spark.createDataFrame(data, "vector array<double>, label int, held boolean")
    return frame.select(array_to_vector("vector").alias("features_vector"), "label", "held").checkpoint()


@pytest.fixture(scope="module")
def model(rows):
    return GBTClassifier(featuresCol="features_vector", maxIter=7, maxDepth=3, stepSize=0.3, seed=5).fit(rows)


def test_table_of_trees_scores_as_the_model(rows, model):
    nodes = trees.tree_table(model)
    assert nodes.columns == ["tree", "node", "feature", "threshold", "lower", "upper", "value", "weight"]
    keyed = rows.withColumn("k", F.monotonically_increasing_id())
    by_table = trees.score_by_table(keyed, nodes).orderBy("k").collect()
    by_model = training.score(keyed, model).orderBy("k").collect()
    for a, b in zip(by_table, by_model, strict=True):
        assert a["prediction"] == b["prediction"]
        assert a["probability_phishing"] == pytest.approx(b["probability_phishing"], abs=1e-12)
    empty = trees.score_by_table(keyed.limit(1).withColumn("features_vector", F.lit(None).cast(rows.schema["features_vector"].dataType)), nodes)
    assert empty.first()["probability_phishing"] is None


def test_too_many_nodes_do_not_travel(model, monkeypatch):
    monkeypatch.setattr(trees, "MOST_NODES", 10)
    with pytest.raises(ValueError):
        trees.forest(trees.tree_table(model))


@pytest.mark.parametrize("bits", [(24, 44, 64), (3, 14, 64)])
def test_curve_is_exact_at_any_cell_width(rows, model, monkeypatch, bits):
    monkeypatch.setattr(curves, "CELL_BITS", bits)
    got = {r["iter"]: r for r in curves.learning_curve(model, rows).collect()}
    assert sorted(got) == list(range(7))
    for k in range(7):
        cut = training.truncated(model, k + 1)
        scored = training.score(rows, cut)
        assert got[k]["AUC"] == pytest.approx(roc_auc(scored, "label", "probability_phishing").first()["auc"], abs=1e-12)
        p, y = np.array(scored.select("probability_phishing", "label").collect()).T
        assert got[k]["Logloss"] == pytest.approx(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)), abs=1e-9)
    assert [r["iter"] for r in curves.learning_curve(model, rows, every=4).orderBy("iter").collect()] == [0, 4, 6]
    one = curves.learning_curve(model, rows.where("label = 1")).where("iter = 2").first()
    assert one["AUC"] is None and one["Logloss"] > 0


def test_curve_shuffles_cells_not_rows(rows, model):
    forest = trees.forest(trees.tree_table(model))
    many = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(40)))).coalesce(1)
    few, more = (trees.margin_cells(f, forest, [0, 6], 24, 0).groupBy("iter", "cell").agg(F.sum("pos").alias("pos")) for f in (rows, many))
    assert few.count() == more.count()
    assert trees.margin_cells(many, forest, [0, 6], 24, 0).count() < 40 * rows.count() / 5


def test_patience_ends_the_fitting(rows):
    told = []
    done = boosting.boost(rows, 40, 0.8, 3, validation="held", patience=3, on_round=lambda k, auc: told.append((k, auc)))
    assert done.fitted == len(told) == done.best_iter + 4 < 40
    assert done.model.getNumTrees == done.best_iter + 1 and told == done.curve
    whole = GBTClassifier(featuresCol="features_vector", maxIter=done.fitted, maxDepth=3, stepSize=0.8, maxBins=64, seed=127).fit(rows.where("NOT held"))
    cut = training.truncated(whole, done.best_iter + 1)
    aucs = [roc_auc(training.score(rows.where("held"), m), "label", "probability_phishing").first()["auc"] for m in (done.model, cut)]
    assert aucs[0] == pytest.approx(aucs[1], abs=1e-12) and aucs[0] == pytest.approx(max(a for _, a in done.curve), abs=1e-12)


def test_checkpoints_between_rounds_change_nothing(rows, monkeypatch):
    monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", 2)
    often = boosting.boost(rows, 5, 0.5, 2)
    monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", 100)
    never = boosting.boost(rows, 5, 0.5, 2)
    assert often.fitted == never.fitted == 5 and never.best_iter == 4
    for a, b in zip(often.model.trees, never.model.trees):
        assert a.toDebugString.split("\n")[1:] == b.toDebugString.split("\n")[1:]


def test_only_one_class_is_never_judged(rows):
    done = boosting.boost(rows.where("label = 1 OR NOT held"), 3, 0.5, 1, validation="held", patience=1)
    assert done.fitted == 3 and done.best_iter == 2 and {auc for _, auc in done.curve} == {None}


def test_learning_curve_shows_rows_that_no_round_learned_from(spark, tmp_path):
    pages = [(k, f"https://www.site{k % 7}.example{k}.com/en/{'login' if k % 3 else 'p' * (k % 40)}") for k in range(40)]
    spark.createDataFrame(pages, "page_id bigint, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {(r["dataset"], r["iter"]): r for r in registry.QUERIES["learning_curve"].plan(spark, str(tmp_path)).collect()}
    rounds = registry.SMALL_PARAMS.iterations
    assert sorted(got) == sorted((name, k) for name in ("train", "test") for k in range(rounds))
    parts = splits.stratified_holdout(registry._vectors(spark, str(tmp_path))).checkpoint()
    learned, held = (parts.where(F.col("split") == name) for name in ("train", "test"))
    assert held.count() == pytest.approx(parts.count() / 5, abs=1)
    model = training.fit_gbt(learned, registry.SMALL_PARAMS)
    for name, rows in (("train", learned), ("test", held)):
        assert [2 * got[name, k]["Logloss"] for k in range(rounds)] == pytest.approx(model.evaluateEachIteration(rows), rel=1e-6)
        scored = training.score(rows, model)
        assert got[name, rounds - 1]["AUC"] == pytest.approx(roc_auc(scored, "label", "probability_phishing").first()["auc"], abs=1e-9)
