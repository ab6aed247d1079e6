"""Ingest, list matching, cascade, splits, metrics and texts on small fixtures."""

import math
import random

import pytest
from pyspark.sql import functions as F

from urlwarden.functions.hosts import parent_domains, with_hostname
from urlwarden.operators import cascade, curves, explain, ingest, listmatch, metrics, ranking, splits


def domains(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "domain string")


def test_ingest_fixture(spark):
    primary = spark.createDataFrame(
        [(1, "a.com", "phishing"), (2, "b.com", "BENIGN"), (3, "a.com", "benign"), (4, "c.com", None), (5, None, "bad")],
        "n int, text string, is_phishing string")
    secondary = spark.createDataFrame(
        [(1, "b.com", "1"), (2, "d.com", None), (3, "d.com", "1"), (4, "e.com", "1")], "n int, URL string, Status string")
    parts = {
        "primary": ingest.normalised(ingest.project_primary(primary, "n")),
        "secondary": ingest.normalised(ingest.project_secondary(secondary, "n")),
    }
    united = ingest.union_sources(parts)
    assert {(r.source, r.rows) for r in ingest.row_counts(united).collect()} == {("primary", 5), ("secondary", 4)}
    out = ingest.merge_sources(parts)
    assert out.schema.simpleString() == "struct<url:string,label:int>"
    assert sorted(map(tuple, out.collect())) == [("a.com", 1), ("b.com", 0), ("c.com", 0), ("e.com", 1)]
    shares = {r.label: r.share for r in ingest.class_distribution(out).collect()}
    assert shares == {0: 0.5, 1: 0.5}


def test_sources_without_columns(spark):
    odd = spark.createDataFrame([("x", 1)], "site string, label int")
    with pytest.raises(KeyError):
        ingest.project_primary(odd)
    assert ingest.project_secondary(odd) is None
    with pytest.raises(KeyError):
        ingest.require_column(odd, "url")
    with pytest.raises(ValueError):
        ingest.union_sources({})


def test_column_choice_follows_column_order():
    assert ingest.pick_column(["id", "text", "url"], ("url", "text")) == "text"
    assert ingest.pick_column(["Url"], ("url",)) is None
    assert ingest.pick_column(["Url"], ("url",), ignore_case=True) == "Url"


def test_dedup_is_a_hash_aggregate_and_keeps_the_first(spark):
    rows = [(f"u{i % 7}" if i % 3 else "hot", float(i % 2), i) for i in range(300)]
    df = spark.createDataFrame(rows, "url string, label double, seq bigint").repartition(8)
    out = ingest.dedup_first(df)
    want = {}
    for url, label, seq in rows:
        want.setdefault(url, (label, seq))
    assert {r.url: (r.label, r.seq) for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Window" not in plan


def test_shuffle_depends_on_content_only(spark):
    df = spark.createDataFrame([(f"u{i}", i) for i in range(200)], "url string, label int")
    orders = [[r.url for r in ingest.shuffled(df.repartition(n)).collect()] for n in (1, 7)]
    assert orders[0] == orders[1] != sorted(orders[0])
    assert [r.url for r in ingest.shuffled(df, seed=43).collect()] != orders[0]


CASCADE = {
    "http://www.mysite.org/": ("safe", "whitelist"), "https://mail.google.com/": ("safe", "global_safe"),
    "http://a.evil.tk/": ("safe", "global_safe"), "http://www.bad.io/": ("phishing", "blacklist"),
    "http://bad.io/": ("safe", "ml"), "http://sub.mysite.org/": ("safe", "ml"),
    "http://x@[bad/": (None, None), "not a url": (None, None), "http://GOOGLE.com:8080/": ("safe", "global_safe"),
    "http://google.com.evil.example/": ("safe", "ml"), "http://notgoogle.com/": ("safe", "ml"),
    "http://1.2.3.4/login": ("phishing", "ml"), "http://a.b.c.d.deep.google.com/": ("safe", "global_safe"),
}


def scorer(features):
    p = F.when(F.col("has_ip_address") == 1, 0.8).when(F.col("url_length").isNotNull(), 0.2)
    return features.withColumns({"probability_phishing": p, "prediction": (p > 0.5).cast("int")})


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_cascade_fixture(spark, max_rows):
    lists = listmatch.prepare_lists(
        domains(spark, "mysite.org"), domains(spark, "google.com", "evil.tk"), domains(spark, "evil.tk", "www.bad.io"), max_rows)
    assert lists.small == (max_rows > 0)
    df = spark.createDataFrame([(u,) for u in [*CASCADE, None]], "url string")
    out = {r.url: r for r in cascade.verdict_cascade(df, lists, scorer).collect()}
    assert {u: (r.result, r.reason) for u, r in out.items()} == CASCADE | {None: (None, None)}
    assert out["http://www.bad.io/"].score == 1.0 and out["http://bad.io/"].score == 0.2
    blind = {r.url: r for r in cascade.verdict_cascade(df, lists).collect()}
    assert (blind["http://bad.io/"].result, blind["http://bad.io/"].reason) == ("error", "model_not_loaded")
    answers = {r.url: (r.result, r.reason) for r in cascade.answer_requests(df, lists, scorer).collect()}
    assert answers["not a url"] == ("error", "no_response")
    totals = metrics.session_counters(cascade.verdict_cascade(df, lists, scorer)).first()
    assert tuple(totals) == (14, 2, 9)
    warned = {r.message for r in cascade.alerts(cascade.verdict_cascade(df, lists, scorer)).collect()}
    assert warned == {"www.bad.io may be dangerous", "1.2.3.4 may be dangerous"}


def test_small_lists_do_not_move_the_events(spark):
    lists = listmatch.prepare_lists(domains(spark, "a.b"), domains(spark, "c.d", "e.f.g"), domains(spark, "h.i"))
    assert lists.suffix_lengths == (2, 3)
    df = spark.range(10).select(F.concat(F.lit("http://x.c.d/"), "id").alias("url"))
    plan = listmatch.with_list_flags(with_hostname(df), lists)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 4 and "SortMergeJoin" not in plan


def test_shuffled_list_way_with_a_hot_host(spark):
    hosts = ["hot.google.com"] * 500 + [f"h{i}.site{i % 9}.org" for i in range(500)]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(hosts)], "id int, hostname string")
    args = domains(spark, "h3.site3.org"), domains(spark, "google.com", "site4.org"), domains(spark, "h5.site5.org", "site6.org")
    small = listmatch.with_list_flags(df, listmatch.prepare_lists(*args))
    big = listmatch.with_list_flags(df, listmatch.prepare_lists(*args, max_rows=0))
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))


def test_parent_domains(spark):
    df = spark.createDataFrame([("www.a.b.c.d",), ("a.b",), ("www.a.b",), ("x",), (None,)], "h string")
    got = {r.h: r.p for r in df.select("h", parent_domains(F.col("h")).alias("p")).collect()}
    assert got == {"www.a.b.c.d": ["b.c.d", "c.d"], "a.b": [], "www.a.b": [], "x": [], None: None}


HOSTS = {
    "http://USER:pw@Www.X.com:80/p": "www.x.com", "https://x.com:70000/": None, "http://x.com:8a/": None, "http://": None,
    "http:x.com/a": "x.com", "http:\\\\x.com\\y": "x.com", "javascript:alert(1)": "", "x.com": None, "http://[::1]:8/": "[::1]",
    "http://[::1/": None, "http://a b/": None, "ftp://h/": "h", " http://t.com ": "t.com", "http://@/": None, "httpx://H/": "H",
}


def test_browser_hosts(spark):
    df = spark.createDataFrame([(u,) for u in HOSTS], "url string")
    assert {r.url: r.hostname for r in with_hostname(df).collect()} == HOSTS


def test_list_filter(spark):
    listed = domains(spark, "a.com", "b.org")
    assert [r.domain for r in listmatch.list_filter(listed, "A.").collect()] == ["a.com"]
    assert listmatch.list_filter(listed).count() == 2


def test_metrics_fixture(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.8), (0, 0.3), (0, 0.1)]
    df = spark.createDataFrame(rows, "label int, score double").withColumn("prediction", (F.col("score") > 0.5).cast("int"))
    m = metrics.binary_metrics(df).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (2, 1, 0, 2)
    assert (m.accuracy, m.precision, m.recall, m.f1_score) == pytest.approx((0.8, 2 / 3, 1.0, 0.8))
    assert metrics.roc_auc(df).first().auc == pytest.approx(0.75)
    assert sorted(map(tuple, metrics.confusion_matrix(df).collect())) == [(0, 2, 1), (1, 0, 2)]
    report = {r.entry: r for r in metrics.classification_report(df).collect()}
    assert set(report) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert report["weighted avg"].precision == pytest.approx(0.6 * 1 + 0.4 * 2 / 3)
    none = metrics.binary_metrics(df.where("false")).first()
    assert (none.accuracy, none.precision, none.recall, none.f1_score) == (0, 0, 0, 0)
    assert metrics.roc_auc(df.where("label = 1")).first().auc is None


def test_auc_against_brute_force(spark):
    rng = random.Random(5)
    pool = [0.0, 1.0, 0.5, 1e-12, 2e-12, -3.0, 7.5, 0.1 + 0.2, 0.3] + [rng.random() for _ in range(60)]
    rows = [(rng.randint(0, 1), rng.choice(pool), rng.randint(0, 2)) for _ in range(600)]
    df = spark.createDataFrame(rows, "label int, score double, g int")

    def brute(sample):
        pos, neg = [s for y, s in sample if y], [s for y, s in sample if not y]
        return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))

    assert metrics.roc_auc(df).first().auc == pytest.approx(brute([r[:2] for r in rows]), abs=1e-12)
    for r in metrics.roc_auc(df, by=["g"]).collect():
        assert r.auc == pytest.approx(brute([x[:2] for x in rows if x[2] == r.g]), abs=1e-12)


@pytest.mark.parametrize("keys", [200_000, 9])
def test_splits_match_plain_ranking(spark, monkeypatch, keys):
    import hashlib
    monkeypatch.setattr(ranking, "PIECE_KEYS", keys)
    rows = [(f"u{i}", int(i % 3 == 0)) for i in range(103)]
    df = spark.createDataFrame(rows, "url string, label int").repartition(5)

    def order(seed):
        return lambda u: (hashlib.md5(f"{u}|{seed}".encode()).hexdigest(), u)

    got = {r.url: r.split for r in splits.stratified_holdout(df).collect()}
    given = spark.createDataFrame([(0, 68), (1, 35)], "__y int, n bigint")
    sizes = {r["__y"]: r["test"] for r in splits.holdout_sizes(given, 0.2).collect()}
    assert sum(sizes.values()) == math.ceil(0.2 * 103)
    for label in (0, 1):
        ranked = sorted((u for u, y in rows if y == label), key=order(127))
        assert [got[u] for u in ranked] == ["test"] * sizes[label] + ["train"] * (len(ranked) - sizes[label])
    folds = {r.url: r.fold for r in splits.stratified_kfold(df).collect()}
    for label in (0, 1):
        counts = [sum(folds[u] == k for u, y in rows if y == label) for k in range(5)]
        assert max(counts) - min(counts) <= 1 and sum(counts) == (35 if label else 68)


def test_splits_with_many_classes_and_gaps(spark):
    rows = [(f"u{i}", f"c{i % 700}") for i in range(2100)] + [(None, "c1"), ("u", None)]
    df = spark.createDataFrame(rows, "url string, label string")
    parts = splits.stratified_holdout(df)
    assert parts.where("split = 'test'").count() == math.ceil(0.2 * 2100)
    assert {r.split for r in parts.where("url IS NULL OR label IS NULL").collect()} == {None}
    folds = splits.stratified_kfold(df, 3).where("fold IS NOT NULL").groupBy("label").agg(F.count_distinct("fold").alias("n"), F.count("*").alias("rows"))
    assert {tuple(r) for r in folds.select("n", "rows").collect()} == {(3, 3)}


def test_source_order_with_any_position(spark):
    """Positions of any size, many sources: the earlier source wins, then the smaller position."""
    sources = {}
    for k in range(11):
        rows = [("u", k, 2**63 - 1 - k if k % 2 else -2**63 + k), (f"own{k}", k, 1_760_000_000_000_000_000), (f"own{k}", 100 + k, -5)]
        sources[f"s{k}"] = ingest.project(spark.createDataFrame(rows, "url string, label int, n bigint"), "url", "label", "n")
    merged = ingest.union_sources(sources)
    firsts = ingest.dedup_first(merged.select("url", "label", "seq"))
    assert {r.url: r.label for r in firsts.collect()} == {"u": 0} | {f"own{k}": 100 + k for k in range(11)}
    plan = firsts._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_auc_of_any_scale(spark):
    rng = random.Random(3)
    pool = [s * 10.0 ** e for s in (-1, 1) for e in range(-300, 300, 7)] + [0.0, -0.0, float("inf"), float("-inf")]
    rows = [(rng.randint(0, 1), rng.choice(pool)) for _ in range(500)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "label int, score double")
    assert metrics.roc_auc(df).first().auc == pytest.approx(want, abs=1e-12)


def test_split_keeps_equal_keys_together(spark):
    df = spark.createDataFrame([("hot", 0)] * 400 + [(f"u{i}", 0) for i in range(200)], "url string, label int")
    parts = splits.stratified_holdout(df).groupBy("url").agg(F.count_distinct("split").alias("n")).where("n > 1")
    assert parts.count() == 0


def test_a_hot_key_is_split_among_tasks(spark, monkeypatch):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        url = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
        df = spark.range(n).select(url.alias("url"), (F.col("id") % 2).alias("label"), F.md5(F.col("id").cast("string")).alias("more")).repartition(16).checkpoint()
        parts = splits.stratified_holdout(df)
        assert parts.groupBy("split").count().where("split = 'test'").first()["count"] > 0 and parts.count() == n
        plan = splits.stratified_holdout(df)
        plan.write.format("noop").mode("overwrite").save()
        last = plan.select("url", "split", "more")
        last.collect()
        assert "skew=true" in last._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("keys", [200_000, 13])
def test_positions_number_the_shuffled_order(spark, monkeypatch, keys):
    monkeypatch.setattr(ranking, "PIECE_KEYS", keys)
    rows = [(f"u{i}", i) for i in range(300)] + [("same", k) for k in range(500)] + [(None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "url string, label int").repartition(7)
    got = ranking.positions(df).orderBy("position").collect()
    assert [r.position for r in got] == list(range(len(rows)))
    assert [r.url for r in got] == [r.url for r in ingest.shuffled(df).collect()]
    assert sorted((r.label for r in got if r.url == "same")) == list(range(500))
    assert ranking.positions(df.limit(0)).count() == 0 and ranking.positions(df, seed=43).orderBy("position").first().url is None


def test_running_sums_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(ranking, "PIECE_KEYS", 10)
    rng = random.Random(1)
    rows = [(rng.choice("abc"), f"{k:04}", rng.randrange(1, 9)) for k in range(700)]
    got = {(r.g, r.k): r.before for r in ranking.running(spark.createDataFrame(rows, "g string, k string, n int"), ["g"], ["k"], "n").collect()}
    assert got == {(g, k): sum(n for h, j, n in rows if h == g and j < k) for g, k, _ in rows}
    assert ranking.pieces_for(79, 8) == 8 and ranking.pieces_for(1_000_001, 8) == 100_001


def test_best_iteration(spark):
    aucs = [0.5, 0.7, 0.6, 0.7, 0.65, 0.9]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(aucs)], "iter int, AUC double")
    assert tuple(curves.best_iteration(df, patience=3).first()) == (1, 0.7, 4)
    assert tuple(curves.best_iteration(df, patience=9).first()) == (5, 0.9, 5)


def test_texts(spark):
    rows = [(0.95, 1), (0.8, 1), (0.6, 1), (0.5, 0)]
    df = spark.createDataFrame(rows, "p double, y int").withColumns({
        n: F.lit(0) for n in ("has_ip_address", "has_suspicious_keywords", "qty_dot_url", "has_at_symbol", "qty_slash_url",
                              "tld_length", "has_sensitive_words")}).withColumn("url_length", F.lit(80))
    out = df.select(
        explain.risk_level(F.col("p")).alias("risk"),
        explain.explanation(F.col("y"), F.col("p"), explain.reasons(F.col("y"), "en"), "en").alias("text")).collect()
    assert [r.risk for r in out] == ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
    assert out[0].text == "URL classified as PHISHING (95.0%). Reasons: is unusually long."
    assert out[3].text == "URL classified as safe (50.0%)."


def test_ties_are_written_as_browsers_do(spark):
    """Of two equally near tenths the larger, by exact arithmetic on the double."""
    from decimal import ROUND_HALF_UP, Decimal
    values = [k / 32 for k in range(33)] + [k / 1000 for k in range(1001)] + [0.12345, 0.0005, 1 / 3, 0.99949999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", explain.percent_up(F.col("v")).alias("text")).collect():
        assert row.text == f"{Decimal(row.v * 100).quantize(Decimal('0.1'), ROUND_HALF_UP)}%"


def test_a_model_that_gives_nothing(spark):
    lists = listmatch.prepare_lists(*(spark.createDataFrame([(d,)], "domain string") for d in ("w.com", "s.org", "b.io")))
    df = spark.createDataFrame([(u,) for u in ("http://w.com", "http://b.io", "http://x.net/", "http://[")], "url string")
    silent = lambda features: features.withColumns({"prediction": F.lit(None).cast("int"), "probability_phishing": F.lit(None).cast("double")})
    got = {r.url: (r.result, r.reason, r.score, r.error, r.host) for r in cascade.verdict_cascade(df, lists, silent, host_col="host").collect()}
    assert got == {
        "http://w.com": ("safe", "whitelist", 0.0, None, "w.com"), "http://b.io": ("phishing", "blacklist", 1.0, None, "b.io"),
        "http://x.net/": ("error", "prediction_failed", None, cascade.NO_ANSWER, "x.net"), "http://[": (None, None, None, None, None)}


def test_the_model_is_called_once_under_alerts(spark):
    """A filter on the verdict stays above it."""
    from pyspark.sql.types import DoubleType
    lists = listmatch.prepare_lists(*(spark.createDataFrame([(d,)], "domain string") for d in ("w.com", "s.org", "b.io")))
    ask = F.udf(lambda n: None if n is None else min(n / 50, 1.0), DoubleType())

    def scorer(features):
        return features.withColumn("probability_phishing", ask("url_length")).withColumn("prediction", F.lit(0))

    df = spark.createDataFrame([("http://" + "x" * 30 + ".net/",), ("http://y.net",)], "url string")
    found = cascade.alerts(cascade.verdict_cascade(df, lists, scorer, host_col="host"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") + plan.count("BatchEvalPython") == 1
    assert [r.host for r in found.collect()] == ["x" * 30 + ".net"]


def test_hot_host_takes_the_shuffled_way(spark):
    """Identical addresses on a third of the rows; the big-list way gives what the broadcast way gives."""
    rows = [("http://a.hot.example.com/",)] * 3000 + [(f"http://h{k}.x{k % 50}.com/",) for k in range(6000)]
    df = spark.createDataFrame(rows, "url string")
    hosts = cascade.with_hostname(df)
    lists = [spark.createDataFrame([(d,) for d in some], "domain string") for some in (["h1.x1.com"], ["example.com", "x2.com"], ["h3.x3.com"])]
    small, big = listmatch.prepare_lists(*lists), listmatch.prepare_lists(*lists, max_rows=0)
    assert small.small and not big.small
    flags = ["url", "in_whitelist", "in_safe", "in_blacklist"]
    want = sorted(map(tuple, listmatch.with_list_flags(hosts, small).select(*flags).collect()))
    assert sorted(map(tuple, listmatch.with_list_flags(hosts, big).select(*flags).collect())) == want


@pytest.mark.parametrize("url, host", [
    ("http://999.1.1.1/", None), ("http://foo.123/", None), ("http://1.2.3/", None), ("http://1.2.3.4./", "1.2.3.4."), ("http://1.2.3.4:8/", "1.2.3.4"),
    ("http://256.1.1.1", None), ("http://a.b1/", "a.b1"), ("foo://x.123/", "x.123"), ("http://12.com/", "12.com"),
])
def test_numeric_hosts(spark, url, host):
    assert cascade.with_hostname(spark.createDataFrame([(url,)], "url string")).first().hostname == host
