"""All registered queries: a Spark plan each, and SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlwarden.functions.features import url_features
from urlwarden.functions.hosts import parent_domains, with_hostname
from urlwarden.functions.urlparts import top_level_domain, with_url_parts
from urlwarden.functions.vocab import DOUBLE_FEATURES, FEATURE_NAMES, PHISHING_LABELS
from urlwarden.operators import cascade, curves, explain, ingest, listmatch, metrics, ranking, splits, training
from urlwarden.plans import corpora
from urlwarden.plans.oracle import browser_parts_sql, features_sql, words
from urlwarden.session import checkpoint_dir, delete, stored, tune
from urlwarden.sources import readers, writers
from urlwarden.streaming import navigation

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    plan: Plan
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def add(plan: Plan) -> Plan:
        QUERIES[name] = Query(lambda spark, sf_dir: plan(tune(spark), sf_dir), sql)
        return plan
    return add


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, as in the SQL."""
    doubles = {f.name for f in df.schema if f.dataType.typeName() == "double"}
    return df.select(*(F.round(c, 6).alias(c) if c in doubles else F.col(c) for c in df.columns))


def prepared_lists(spark: SparkSession, sf_dir: str) -> listmatch.DomainLists:
    return listmatch.prepare_lists(*corpora.domain_lists(spark, sf_dir))


# ---------------------------------------------------------------- addresses

FEATURE_GROUPS = {
    "feat_structural": FEATURE_NAMES[:16],
    "feat_characters": tuple(n for n in FEATURE_NAMES[16:34] if not n.startswith("entropy")),
    "feat_entropy": ("entropy_url", "entropy_domain"),
    "feat_domain": FEATURE_NAMES[34:42],
    "feat_lexical": FEATURE_NAMES[42:57],
    "feat_redirect": FEATURE_NAMES[57:62],
    "feat_special": FEATURE_NAMES[62:70],
    "feat_ratio": FEATURE_NAMES[70:],
}


def _feature_query(name: str, names: tuple[str, ...], profile: str) -> None:
    sql = f"WITH {features_sql(names, profile, addresses=corpora.ADDRESSES_SQL)} SELECT * FROM feats"

    @register(name, sql)
    def plan(spark, sf_dir):
        return rounded(url_features(corpora.addresses(spark, sf_dir).select("url"), profile=profile, features=names))


for _name, _names in FEATURE_GROUPS.items():
    _feature_query(_name, _names, "training")
    _feature_query(_name.replace("feat_", "feat_browser_"), _names, "browser")


_PARTS = "scheme, dom AS netloc, path, params, q AS query, frag AS fragment, h AS host, t AS tld"


@register("url_parts", f"WITH {features_sql((), keep=('url', _PARTS), addresses=corpora.ADDRESSES_SQL)} SELECT * FROM feats WHERE url <> ''")
def url_parts(spark, sf_dir):
    parts = with_url_parts(corpora.addresses(spark, sf_dir).select("url").where("url <> ''"))
    return parts.withColumn("tld", top_level_domain(F.col("host")))


@register("browser_hosts", f"WITH {corpora.ADDRESSES_SQL}, {browser_parts_sql(assume_http=False)} SELECT url, dom AS hostname FROM parts")
def browser_hosts(spark, sf_dir):
    return with_hostname(corpora.addresses(spark, sf_dir).select("url"))


@register("parent_domains", f"""WITH {corpora.ADDRESSES_SQL}, {browser_parts_sql(assume_http=False)},
hosts AS (SELECT DISTINCT dom AS hostname, string_split(regexp_replace(dom, '^www[.]', ''), '.') AS p FROM parts WHERE dom IS NOT NULL)
SELECT hostname, array_to_string(list_slice(p, n, len(p)), '.') AS parent, CAST(n - 2 AS INTEGER) AS level
FROM hosts, unnest(range(2, CAST(len(p) AS BIGINT))) AS s(n)""")
def parents(spark, sf_dir):
    hosts = with_hostname(corpora.addresses(spark, sf_dir).select("url")).select("hostname").distinct()
    return hosts.select("hostname", F.posexplode(parent_domains(F.col("hostname"))).alias("level", "parent"))


_ITEM_TOTALS = ", ".join(f"round(sum({n}), 3) AS {n}" if n in DOUBLE_FEATURES else f"CAST(sum({n}) AS BIGINT) AS {n}" for n in FEATURE_NAMES)


@register("feature_totals", f"""WITH {features_sql(FEATURE_NAMES, keep=('l_returnflag',), addresses=corpora.ITEMS_SQL, exact=True)}
SELECT l_returnflag, count(*) AS n, {_ITEM_TOTALS} FROM feats GROUP BY l_returnflag""")
def feature_totals(spark, sf_dir):
    """All 73 features over one address per line item."""
    features = url_features(corpora.item_addresses(spark, sf_dir))
    totals = (F.round(F.sum(n), 3).alias(n) if n in DOUBLE_FEATURES else F.sum(n).cast("bigint").alias(n) for n in FEATURE_NAMES)
    return features.groupBy("l_returnflag").agg(F.count("*").alias("n"), *totals)


@register("feature_array_totals", f"""WITH {features_sql(FEATURE_NAMES, 'browser', addresses=corpora.ADDRESSES_SQL, exact=True)}
SELECT CAST(pos - 1 AS INTEGER) AS pos, round(sum(CAST(v AS DOUBLE)), 1) AS total, count(*) AS n
FROM (SELECT unnest([{', '.join(f'CAST({n} AS FLOAT)' for n in FEATURE_NAMES)}]) AS v, unnest(range(1, 74)) AS pos FROM feats
      WHERE url_length IS NOT NULL) GROUP BY pos""")
def feature_array_totals(spark, sf_dir):
    vectors = training.feature_array(url_features(corpora.addresses(spark, sf_dir), profile="browser"))
    # The outer form keeps the optimizer from filtering on, and so repeating,
    # the whole array expression.
    cells = vectors.select(F.posexplode_outer("vector").alias("pos", "v")).where("pos IS NOT NULL")
    return cells.groupBy("pos").agg(F.round(F.sum(F.col("v").cast("double")), 1).alias("total"), F.count("*").alias("n"))


@register("tld_profile", f"""WITH {features_sql(('url_length', 'entropy_url', 'qty_suspicious_keywords', 'has_ip_address'), keep=('t AS tld',), addresses=corpora.ADDRESSES_SQL, exact=True)}
SELECT tld, count(*) AS n, round(avg(url_length), 6) AS avg_length, round(avg(entropy_url), 5) AS avg_entropy,
CAST(sum(qty_suspicious_keywords) AS BIGINT) AS keywords, CAST(sum(has_ip_address) AS BIGINT) AS ip_hosts
FROM feats WHERE url_length IS NOT NULL GROUP BY tld""")
def tld_profile(spark, sf_dir):
    """Flagship: features of every address, summarised per top-level domain."""
    names = ("url_length", "entropy_url", "qty_suspicious_keywords", "has_ip_address")
    features = url_features(corpora.addresses(spark, sf_dir).where("url <> ''"), features=names, tld_col="tld")
    return features.groupBy("tld").agg(
        F.count("*").alias("n"), F.round(F.avg("url_length"), 6).alias("avg_length"),
        F.round(F.avg("entropy_url"), 5).alias("avg_entropy"),
        F.sum("qty_suspicious_keywords").alias("keywords"), F.sum("has_ip_address").alias("ip_hosts"),
    )


# ------------------------------------------------------------------- ingest

_NORMALISED_SQL = f"""{corpora.SOURCES_SQL},
united AS (
  SELECT text AS url, CAST(CASE WHEN lower(label) IN ({words(PHISHING_LABELS)[1:-1]}) THEN 1 ELSE 0 END AS DOUBLE) AS label,
         'primary' AS source, 0 AS rank, n FROM primary_raw
  UNION ALL SELECT URL, TRY_CAST(status AS DOUBLE), 'secondary', 1, n FROM secondary_raw),
firsts AS (SELECT url, label FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY rank, n) AS k FROM united) WHERE k = 1),
merged AS (SELECT url, CAST(label AS INTEGER) AS label FROM firsts WHERE url IS NOT NULL AND label IS NOT NULL)"""


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "primary": ingest.normalised(ingest.project_primary(corpora.primary_source(spark, sf_dir), order_col="n")),
        "secondary": ingest.normalised(ingest.project_secondary(corpora.secondary_source(spark, sf_dir), order_col="n")),
    }


def merged(spark: SparkSession, sf_dir: str, seed: int | None = None) -> DataFrame:
    return ingest.merge_sources(sources(spark, sf_dir), seed)


@register("label_norm", f"WITH {_NORMALISED_SQL} SELECT source, label, count(*) AS n FROM united GROUP BY source, label")
def label_norm(spark, sf_dir):
    return ingest.union_sources(sources(spark, sf_dir)).groupBy("source", "label").agg(F.count("*").alias("n"))


@register("source_counts", f"WITH {_NORMALISED_SQL} SELECT source, count(*) AS rows FROM united GROUP BY source")
def source_counts(spark, sf_dir):
    return ingest.row_counts(ingest.union_sources(sources(spark, sf_dir)))


@register("dedup_first", f"WITH {_NORMALISED_SQL} SELECT url, label FROM firsts")
def dedup_first(spark, sf_dir):
    return ingest.dedup_first(ingest.union_sources(sources(spark, sf_dir)).select("url", "label", "seq")).select("url", "label")


@register("ingest_merge", f"WITH {_NORMALISED_SQL} SELECT url, label FROM merged")
def ingest_merge(spark, sf_dir):
    return merged(spark, sf_dir, seed=42)


@register("class_dist", f"""WITH {_NORMALISED_SQL}
SELECT label, count(*) AS rows, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM merged GROUP BY label""")
def class_dist(spark, sf_dir):
    return rounded(ingest.class_distribution(merged(spark, sf_dir)))


_MANY_SQL = """SELECT concat('u', cast(user_id % 400 AS string)) AS url, cast(event_id % 3 AS int) AS label, event_id % 12 AS rank,
CASE WHEN event_id % 2 = 1 THEN -event_id ELSE 1760000000000000000 - event_id END AS n FROM events"""


@register("ingest_many_sources", f"""SELECT url, label FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY rank, n) AS k
FROM ({_MANY_SQL.replace('AS string', 'AS varchar')})) WHERE k = 1""")
def ingest_many_sources(spark, sf_dir):
    """Twelve sources with nanosecond and negative positions."""
    corpora.table(spark, sf_dir, "events").createOrReplaceTempView("events")
    rows = spark.sql(_MANY_SQL)
    parts = {f"s{k:02d}": ingest.project(rows.where(F.col("rank") == k), "url", "label", "n") for k in range(12)}
    return ingest.dedup_first(ingest.union_sources(parts).select("url", "label", "seq")).select("url", "label")


@register("features_of_changed_labels", """WITH base AS (SELECT page_id, url FROM pages)
SELECT 'first' AS stage, CAST(page_id % 2 AS INTEGER) AS label, count(*) AS n FROM base GROUP BY ALL
UNION ALL SELECT 'changed', CAST((page_id + 1) % 3 AS INTEGER), count(*) FROM base GROUP BY ALL
UNION ALL SELECT 'again', CAST(page_id % 2 AS INTEGER), count(*) FROM base GROUP BY ALL""")
def features_of_changed_labels(spark, sf_dir):
    """The feature table of a corpus, of the same addresses with other labels, and of the first again."""
    folder, pages, found = _scratch(spark, "features"), corpora.table(spark, sf_dir, "pages"), None
    for stage, label in (("first", "page_id % 2"), ("changed", "(page_id + 1) % 3"), ("again", "page_id % 2")):
        table = writers.materialise_features(pages.selectExpr("url", f"cast({label} AS int) AS label"), folder)
        counts = table.groupBy(F.lit(stage).alias("stage"), "label").agg(F.count("*").alias("n"))
        found = counts if found is None else found.unionByName(counts)
    return found


_LINES = "CASE WHEN page_id % 4 = 0 THEN '' WHEN page_id % 4 = 1 THEN concat('  ', url, chr(9)) ELSE url END"


@register("file_lists", f"""WITH {corpora.LISTS_SQL}, lines AS (SELECT trim({_LINES}, ' ' || chr(9)) AS line FROM pages)
SELECT 'address' AS kind, line AS value, count(*) AS n FROM lines WHERE line <> '' GROUP BY ALL
UNION ALL SELECT 'safe', domain, count(*) FROM (SELECT DISTINCT domain FROM safe) GROUP BY ALL
UNION ALL SELECT 'blocked', domain, count(*) FROM (SELECT DISTINCT domain FROM blacklist) GROUP BY ALL
UNION ALL SELECT 'labelled', url, count(*) FROM pages WHERE page_id % 3 > 0 GROUP BY ALL""")
def file_lists(spark, sf_dir):
    """Lists written to files and read back."""
    folder, pages = _scratch(spark, "lists"), corpora.table(spark, sf_dir, "pages")
    _, safe, blocked = corpora.domain_lists(spark, sf_dir)
    pages.select(F.expr(_LINES)).write.text(f"{folder}/addresses")
    safe.agg(F.to_json(F.collect_list("domain"))).write.text(f"{folder}/safe")
    blocked.select(F.concat(F.lit("https://"), "domain", F.lit("/"))).write.text(f"{folder}/blocked")
    pages.selectExpr("CASE WHEN page_id % 3 > 0 THEN url ELSE 'NA' END AS url", "page_id % 2 AS label").write.json(f"{folder}/labelled")
    parts = {
        "address": readers.read_url_list(spark, f"{folder}/addresses").withColumnRenamed("url", "value"),
        "safe": readers.read_safe_domains(spark, f"{folder}/safe").withColumnRenamed("domain", "value"),
        "blocked": readers.read_blacklist(spark, f"{folder}/blocked").withColumnRenamed("domain", "value"),
        "labelled": readers.read_labelled(spark, f"{folder}/labelled", "json", multiline=False).where("url IS NOT NULL").select(F.col("url").alias("value")),
    }
    counted = (df.groupBy(F.lit(kind).alias("kind"), "value").agg(F.count("*").alias("n")) for kind, df in parts.items())
    return reduce(DataFrame.unionByName, counted)


_FILE_NAMES = (
    "concat(CASE WHEN page_id % 7 = 3 THEN 'FULL_' ELSE '' END, substr(md5(url), 1, 8), "
    "CASE WHEN page_id % 5 = 0 THEN '.csv' WHEN page_id % 5 = 1 THEN '.parquet' WHEN page_id % 5 = 2 THEN '.json' "
    "WHEN page_id % 5 = 3 THEN '.txt' ELSE '.md' END)"
)


@register("choose_source_file", f"""WITH files AS (SELECT {_FILE_NAMES} AS name FROM pages),
ranked AS (SELECT name, CASE WHEN name LIKE '%.csv' AND lower(name) LIKE '%full%' THEN 3 WHEN name LIKE '%.csv' THEN 4
  WHEN name LIKE '%.parquet' THEN 5 WHEN name LIKE '%.json' THEN 6 END AS priority FROM files)
SELECT name, CAST(priority AS INTEGER) AS priority FROM ranked WHERE priority IS NOT NULL ORDER BY priority, name LIMIT 1""")
def choose_source_file(spark, sf_dir):
    files = corpora.table(spark, sf_dir, "pages").select(F.expr(_FILE_NAMES).alias("name"))
    return readers.choose_source_file(files)


@register("url_lines", r"""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
cleaned AS (SELECT doc_id, regexp_replace(line, '^[\s\x1c-\x1f\x{85}\x{a0}\x{2000}-\x{200a}\x{3000}]+|[\s\x1c-\x1f\x{85}\x{a0}\x{2000}-\x{200a}\x{3000}]+$', '', 'g') AS line FROM lines)
SELECT doc_id, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM cleaned WHERE line <> '' GROUP BY doc_id""")
def url_lines(spark, sf_dir):
    lines = corpora.table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("value"))
    kept = readers.clean_lines(lines)
    return kept.groupBy("doc_id").agg(F.count("*").alias("lines"), F.sum(F.length("value")).alias("chars"))


_BLOCK_LINE = "CASE WHEN page_id % 3 = 0 THEN concat(chr(34), u, chr(34)) WHEN page_id % 3 = 1 THEN concat('  ', r, '  ') ELSE concat('not a host ', i) END"


@register("blocked_domains", rf"""WITH lines AS (SELECT {_BLOCK_LINE} AS value FROM (SELECT {', '.join(corpora.PAGE_COLUMNS)} FROM pages)),
bare AS (SELECT regexp_replace(trim(value), '^"|"$', '', 'g') AS line FROM lines),
addresses AS (SELECT line, CASE WHEN starts_with(line, 'http') THEN line ELSE 'https://' || line END AS url FROM bare WHERE line <> ''),
{browser_parts_sql(assume_http=False)}
SELECT DISTINCT coalesce(dom, line) AS domain FROM parts""")
def blocked_domains(spark, sf_dir):
    pages = corpora.table(spark, sf_dir, "pages").selectExpr(*corpora.PAGE_COLUMNS)
    return readers.blocked_domains(pages.select(F.expr(_BLOCK_LINE).alias("value")))


# ------------------------------------------------------------------- splits

_BASE_SQL = f"WITH {corpora.ITEMS_SQL}, base AS (SELECT DISTINCT url, CAST(l_returnflag = 'R' AS INTEGER) AS label FROM addresses)"
_HOLDOUT_SQL = """
sizes AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total FROM base GROUP BY label),
shares AS (SELECT label, n, total - CAST(ceil(0.2::DOUBLE * total) AS BIGINT) AS train, total FROM sizes),
floors AS (SELECT *, (n * train) // total AS q, (n * train) % total AS rem FROM shares),
tests AS (SELECT label, n - q - CASE WHEN row_number() OVER (ORDER BY rem DESC, label) <= train - sum(q) OVER () THEN 1 ELSE 0 END AS test FROM floors),
parts AS (SELECT url, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(url || '|127'), url) <= test
          THEN 'test' ELSE 'train' END AS split FROM base JOIN tests USING (label))"""


def labelled_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored once, because finding split boundaries reads its input repeatedly."""
    items = corpora.item_addresses(spark, sf_dir).select("url", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return stored(items.distinct())


@register("split_holdout", f"{_BASE_SQL}, {_HOLDOUT_SQL} SELECT url, label, split FROM parts")
def split_holdout(spark, sf_dir):
    return splits.stratified_holdout(labelled_items(spark, sf_dir))


@register("split_sizes", f"{_BASE_SQL}, {_HOLDOUT_SQL} SELECT split, label, count(*) AS rows FROM parts GROUP BY split, label")
def split_sizes(spark, sf_dir):
    parts = splits.stratified_holdout(labelled_items(spark, sf_dir))
    return parts.groupBy("split", "label").agg(F.count("*").alias("rows"))


@register("split_kfold", f"""{_BASE_SQL}, {_HOLDOUT_SQL}
SELECT url, label, CAST(ntile(5) OVER (PARTITION BY label ORDER BY md5(url || '|127|fold'), url) - 1 AS INTEGER) AS fold FROM parts WHERE split = 'train'""")
def split_kfold(spark, sf_dir):
    train = splits.stratified_holdout(labelled_items(spark, sf_dir)).where("split = 'train'").drop("split")
    return splits.stratified_kfold(train, seed="127|fold")


_CLASSES_SQL = f"""WITH {corpora.ITEMS_SQL}, base AS (SELECT DISTINCT url, CAST(CAST(regexp_extract(url, 'id=([0-9]+)&', 1) AS INTEGER) % 500 AS INTEGER) AS label FROM addresses)"""


def classed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hundred classes."""
    label = F.regexp_extract("url", "id=([0-9]+)&", 1).cast("int") % 500
    return stored(corpora.item_addresses(spark, sf_dir).select("url", label.alias("label")).distinct())


@register("split_many_classes", f"{_CLASSES_SQL}, {_HOLDOUT_SQL} SELECT url, label, split FROM parts")
def split_many_classes(spark, sf_dir):
    return splits.stratified_holdout(classed_items(spark, sf_dir))


@register("kfold_many_classes", f"""{_CLASSES_SQL}
SELECT url, label, CAST(ntile(5) OVER (PARTITION BY label ORDER BY md5(url || '|127'), url) - 1 AS INTEGER) AS fold FROM base""")
def kfold_many_classes(spark, sf_dir):
    return splits.stratified_kfold(classed_items(spark, sf_dir))


_HOT_URL = "CASE WHEN l_orderkey % 3 = 0 THEN 'http://hot.example.com/' ELSE concat('http://', md5(cast(l_orderkey AS string)), '.example.com/') END"
_HOT_RANKS = f"""WITH base AS (SELECT l_orderkey, l_linenumber, {_HOT_URL.replace('AS string', 'AS varchar')} AS url,
CAST(l_returnflag = 'R' AS INTEGER) AS label FROM lineitem),
ranked AS (SELECT *, rank() OVER (PARTITION BY label ORDER BY md5(url || '|127'), url) AS k FROM base),"""


def hot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item; a third of the orders share one address."""
    items = corpora.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    rows = corpora.spread(items).select(
        "l_orderkey", "l_linenumber", F.expr(_HOT_URL).alias("url"), (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return stored(rows)


@register("split_hot_key", f"""{_HOT_RANKS}
sizes AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total FROM base GROUP BY label),
shares AS (SELECT label, n, total - CAST(ceil(0.2::DOUBLE * total) AS BIGINT) AS train, total FROM sizes),
floors AS (SELECT *, (n * train) // total AS q, (n * train) % total AS rem FROM shares),
tests AS (SELECT label, n - q - CASE WHEN row_number() OVER (ORDER BY rem DESC, label) <= train - sum(q) OVER () THEN 1 ELSE 0 END AS test FROM floors)
SELECT l_orderkey, l_linenumber, CASE WHEN k <= test THEN 'test' ELSE 'train' END AS split FROM ranked JOIN tests USING (label)""")
def split_hot_key(spark, sf_dir):
    return splits.stratified_holdout(hot_items(spark, sf_dir)).select("l_orderkey", "l_linenumber", "split")


@register("kfold_hot_key", f"""{_HOT_RANKS} counted AS (SELECT *, k - 1 AS r0, count(*) OVER (PARTITION BY label) AS n FROM ranked)
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN r0 < (n % 5) * (n // 5 + 1) THEN r0 // (n // 5 + 1)
ELSE n % 5 + (r0 - (n % 5) * (n // 5 + 1)) // greatest(n // 5, 1) END AS INTEGER) AS fold FROM counted""")
def kfold_hot_key(spark, sf_dir):
    return splits.stratified_kfold(hot_items(spark, sf_dir)).select("l_orderkey", "l_linenumber", "fold")


@register("shuffle_positions", f"""WITH {_NORMALISED_SQL} SELECT row_number() OVER (ORDER BY md5(url || '|42'), url) - 1 AS position, url, label FROM merged""")
def shuffle_positions(spark, sf_dir):
    """The merged corpus in its shuffled order, numbered."""
    return ranking.positions(merged(spark, sf_dir))


# ------------------------------------------------------------------ metrics

_SCORED_NAMES = tuple(dict.fromkeys((
    *corpora.RULE_FEATURES, "has_sensitive_words", "has_multiple_domains", "url_length",
    "qty_dot_url", "qty_slash_url", "tld_length", "has_suspicious_keywords",
)))
_SCORED_SQL = f"""WITH {features_sql(_SCORED_NAMES, addresses=corpora.ADDRESSES_SQL)},
scored AS (SELECT *, {corpora.TRUTH} AS label, {corpora.SCORE} AS score, CAST({corpora.SCORE} > 0.5 AS INTEGER) AS prediction
           FROM feats WHERE url_length IS NOT NULL)"""
_COUNTS_SQL = """counts AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 0 AND prediction = 0) AS tn FROM scored)"""


def scored_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = url_features(corpora.addresses(spark, sf_dir).where("url <> ''"), features=_SCORED_NAMES)
    return corpora.rule_scorer(features).withColumns({
        "label": F.expr(corpora.TRUTH), "score": F.col("probability_phishing"),
    })


@register("binary_metrics", f"""{_SCORED_SQL}, {_COUNTS_SQL},
r AS (SELECT *, (tp + tn) / (tp + fp + fn + tn)::DOUBLE AS accuracy, tp / (tp + fp)::DOUBLE AS "precision", tp / (tp + fn)::DOUBLE AS recall FROM counts)
SELECT tp, fp, fn, tn, round(accuracy, 6) AS accuracy, round("precision", 6) AS "precision", round(recall, 6) AS recall,
round(2 * "precision" * recall / ("precision" + recall), 6) AS f1_score FROM r""")
def binary_metrics(spark, sf_dir):
    return rounded(metrics.binary_metrics(scored_addresses(spark, sf_dir)))


@register("confusion_matrix", f"""{_SCORED_SQL} SELECT label, count(*) FILTER (prediction = 0) AS predicted_0,
count(*) FILTER (prediction = 1) AS predicted_1 FROM scored GROUP BY label""")
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(scored_addresses(spark, sf_dir))


@register("class_report", f"""{_SCORED_SQL}, {_COUNTS_SQL},
c AS (SELECT '0' AS entry, tn AS hit, fn AS wrong, fp AS missed FROM counts UNION ALL SELECT '1', tp, fp, fn FROM counts),
s AS (SELECT entry, hit, hit + missed AS support, hit / (hit + wrong)::DOUBLE AS p, hit / (hit + missed)::DOUBLE AS r FROM c),
f AS (SELECT *, 2 * p * r / (p + r) AS f FROM s),
u AS (SELECT entry, p, r, f, support FROM f
  UNION ALL SELECT 'accuracy', sum(hit) / sum(support)::DOUBLE, sum(hit) / sum(support)::DOUBLE, sum(hit) / sum(support)::DOUBLE, sum(support) FROM f
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM f
  UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f * support) / sum(support), sum(support) FROM f)
SELECT entry, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM u""")
def class_report(spark, sf_dir):
    return rounded(metrics.classification_report(scored_addresses(spark, sf_dir)))


_AUC_SQL = """SELECT {by} round(sum(pos * (2 * coalesce(before, 0) + neg)) / (2.0::DOUBLE * sum(pos) * sum(neg)), 6) AS auc FROM (
SELECT *, sum(neg) OVER ({part} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
FROM (SELECT {by} score, CAST(count(*) FILTER (label = 1) AS DOUBLE) AS pos, CAST(count(*) FILTER (label = 0) AS DOUBLE) AS neg FROM {source} GROUP BY {by} score))"""


@register("roc_auc", f"{_SCORED_SQL} {_AUC_SQL.format(by='', part='', source='scored')}")
def roc_auc(spark, sf_dir):
    return rounded(metrics.roc_auc(scored_addresses(spark, sf_dir)))


_ITEM_SCORES = "SELECT l_linenumber AS iter, CAST(l_returnflag = 'R' AS INTEGER) AS label, l_discount * 2 + l_tax + l_extendedprice / 1000000 AS score FROM lineitem"


@register("roc_auc_by", f"WITH s AS ({_ITEM_SCORES}) {_AUC_SQL.format(by='iter,', part='PARTITION BY iter', source='s')} GROUP BY iter")
def roc_auc_by(spark, sf_dir):
    items = corpora.table(spark, sf_dir, "lineitem").selectExpr(
        "l_linenumber AS iter", "int(l_returnflag = 'R') AS label", "l_discount * 2 + l_tax + l_extendedprice / 1000000 AS score")
    return rounded(metrics.roc_auc(items, by=["iter"]))


_WIDE_SCORES = """SELECT l_linenumber AS iter, CAST(l_returnflag = 'R' AS INTEGER) AS label,
(l_extendedprice - 40000) * (CASE WHEN l_linenumber = 2 THEN 1e-30 WHEN l_linenumber = 3 THEN 1e30 ELSE 1 END)::DOUBLE AS score FROM lineitem"""


@register("roc_auc_unbounded", f"WITH s AS ({_WIDE_SCORES}) {_AUC_SQL.format(by='iter,', part='PARTITION BY iter', source='s')} GROUP BY iter")
def roc_auc_unbounded(spark, sf_dir):
    """Scores that are no probabilities, at three scales."""
    items = corpora.table(spark, sf_dir, "lineitem").selectExpr(
        "l_linenumber AS iter", "int(l_returnflag = 'R') AS label",
        "(l_extendedprice - 40000) * double(CASE WHEN l_linenumber = 2 THEN 1e-30 WHEN l_linenumber = 3 THEN 1e30 ELSE 1 END) AS score")
    return rounded(metrics.roc_auc(items, by=["iter"]))


@register("fold_aucs_best", f"""WITH s AS (SELECT l_orderkey * 8 + l_linenumber AS id, CAST(l_returnflag = 'R' AS INTEGER) AS label, l_discount * 2 + l_tax + l_extendedprice / 1000000 AS score FROM lineitem),
f AS (SELECT *, ntile(5) OVER (PARTITION BY label ORDER BY md5(cast(id AS varchar) || '|127'), cast(id AS varchar)) AS iter FROM s),
a AS ({_AUC_SQL.format(by='iter,', part='PARTITION BY iter', source='f')} GROUP BY iter)
SELECT CAST(iter AS INTEGER) AS fold, auc FROM a WHERE auc > 0 ORDER BY auc DESC, iter LIMIT 1""")
def fold_aucs_best(spark, sf_dir):
    """The fold that training would choose if the score were the model."""
    rows = corpora.table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey * 8 + l_linenumber AS string) AS id", "int(l_returnflag = 'R') AS label",
        "l_discount * 2 + l_tax + l_extendedprice / 1000000 AS score")
    folds = splits.stratified_kfold(rows, key="id").withColumn("fold", F.col("fold") + 1)
    return training.select_best_fold(rounded(metrics.roc_auc(folds, by=["fold"])))


@register("top_features", """SELECT feature, importance FROM (SELECT 'supplier ' || cast(l_suppkey AS varchar) AS feature,
floor(sum(l_quantity) / 100) AS importance FROM lineitem GROUP BY l_suppkey) ORDER BY importance DESC, feature LIMIT 20""")
def top_features(spark, sf_dir):
    """The list that importances give, over weights with ties."""
    weights = corpora.table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.floor(F.sum("l_quantity") / 100).cast("double").alias("importance"))
    return training.top_features(weights.select(F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("feature"), "importance"))


@register("best_iteration", """WITH curve AS (SELECT l_linenumber AS fold, CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) AS iter,
  max(l_extendedprice) AS auc FROM lineitem GROUP BY ALL),
m AS (SELECT *, CASE WHEN auc > coalesce(max(auc) OVER (PARTITION BY fold ORDER BY iter ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) THEN iter END AS better FROM curve),
b AS (SELECT *, max(better) OVER (PARTITION BY fold ORDER BY iter) AS best_iter, max(auc) OVER (PARTITION BY fold ORDER BY iter) AS best_auc FROM m),
e AS (SELECT *, coalesce(min(CASE WHEN iter - best_iter >= 100 THEN iter END) OVER (PARTITION BY fold), max(iter) OVER (PARTITION BY fold)) AS stop_iter FROM b)
SELECT fold, best_iter, round(best_auc, 6) AS best_auc, stop_iter FROM e WHERE iter = stop_iter""")
def best_iteration(spark, sf_dir):
    items = corpora.table(spark, sf_dir, "lineitem")
    day = F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date"))
    curve = items.groupBy(F.col("l_linenumber").alias("fold"), day.alias("iter")).agg(F.max("l_extendedprice").alias("AUC"))
    return rounded(curves.best_iteration(curve, by=["fold"]))


# ------------------------------------------------------- records, texts

_RISK_SQL = "CASE WHEN score > 0.9 THEN 'CRITICAL' WHEN score > 0.75 THEN 'HIGH' WHEN score > 0.5 THEN 'MEDIUM' ELSE 'LOW' END"


def _explain_sql(language: str) -> str:
    texts = explain.TEXTS[language]
    conditions = ("has_ip_address = 1", "has_suspicious_keywords = 1", "url_length > 75", "qty_dot_url > 3", "has_at_symbol = 1",
                  "qty_slash_url > 5", "tld_length > 4 AND tld_length < 10", "has_sensitive_words = 1")
    cases = ", ".join(f"CASE WHEN {c} THEN '{t}' END" for c, t in zip(conditions, texts["reasons"]))
    opening, middle, closing = texts["phishing"]
    safe_opening, safe_closing = texts["safe"]
    return (
        f"CASE WHEN prediction = 1 THEN '{opening}' || format('{{:.1f}}%', score * 100) || '{middle}' || "
        f"coalesce(nullif(array_to_string([{cases}], ', '), ''), '{texts['fallback']}') || '{closing}' "
        f"ELSE '{safe_opening}' || format('{{:.1f}}%', (1 - score) * 100) || '{safe_closing}' END"
    )


def _explain_query(language: str) -> None:
    sql = f"""{_SCORED_SQL} SELECT url, prediction, round(CASE WHEN prediction = 1 THEN score ELSE 1 - score END, 6) AS confidence,
{_RISK_SQL} AS risk_level, {_explain_sql(language)} AS explanation FROM scored"""

    @register(f"risk_explain_{language}", sql)
    def plan(spark, sf_dir):
        df = scored_addresses(spark, sf_dir)
        p, legit, z = F.col("probability_phishing"), F.col("probability_legitimate"), F.col("prediction")
        return rounded(df.select(
            "url", z, explain.confidence(z, p, legit).alias("confidence"), explain.risk_level(p).alias("risk_level"),
            explain.explanation(z, p, explain.reasons(z, language), language).alias("explanation"),
        ))


_explain_query("en")
_explain_query("ru")


@register("prediction_records", f"""{_SCORED_SQL} SELECT url, prediction, prediction = 1 AS is_phishing, round(score, 6) AS probability_phishing,
round(1 - score, 6) AS probability_legitimate, round(CASE WHEN prediction = 1 THEN score ELSE 1 - score END, 6) AS confidence, {_RISK_SQL} AS risk_level,
{_explain_sql("en")} AS explanation, CAST(url_length AS BIGINT) AS length_feature, CAST(has_sensitive_words AS BIGINT) AS words_feature FROM scored""")
def prediction_records(spark, sf_dir):
    """The whole record, with two of its features."""
    features = url_features(corpora.addresses(spark, sf_dir).where("url <> ''"))
    records = explain.prediction_record(corpora.rule_scorer(features), "en")
    return rounded(records.select("*", F.col("features.url_length").cast("bigint").alias("length_feature"),
                                  F.col("features.has_sensitive_words").cast("bigint").alias("words_feature")).drop("features"))


@register("saved_model_scores", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS different FROM pages")
def saved_model_scores(spark, sf_dir):
    """A pipeline saved and loaded scores every address as the model before saving."""
    folder = _scratch(spark, "models")
    model = training.fit_gbt(_vectors(spark, sf_dir), SMALL_PARAMS)
    PipelineModel([*training.feature_stages(), model]).write().save(folder)
    features = stored(url_features(corpora.table(spark, sf_dir, "pages").select("page_id", "url")))
    before, after = (training.score(features, m).select("page_id", F.col("probability_phishing").alias(name))
                     for m, name in ((model, "before"), (PipelineModel.load(folder), "after")))
    return before.join(after, "page_id").agg(F.count("*").alias("rows"), F.count_if(F.col("before") != F.col("after")).alias("different"))


@register("prediction_summary", f"{_SCORED_SQL} SELECT count(*) FILTER (prediction = 1) AS phishing, count(*) AS total FROM scored")
def prediction_summary(spark, sf_dir):
    features = url_features(corpora.addresses(spark, sf_dir).where("url <> ''"))
    return metrics.phishing_summary(explain.prediction_record(corpora.rule_scorer(features)))


# -------------------------------------------------------------- list matches

_HOSTED_SQL = f"{corpora.ADDRESSES_SQL}, {browser_parts_sql(assume_http=False)}, {corpora.LISTS_SQL}"
_FLAGS_SQL = """
hosted AS (SELECT DISTINCT dom AS host, regexp_replace(dom, '^www[.]', '') AS plain FROM parts WHERE dom IS NOT NULL),
flags AS (SELECT host,
  host IN (SELECT domain FROM whitelist) OR plain IN (SELECT domain FROM whitelist) AS in_whitelist,
  host IN (SELECT domain FROM safe) OR plain IN (SELECT domain FROM safe) OR EXISTS (
    SELECT 1 FROM safe WHERE ends_with(plain, '.' || domain) AND contains(domain, '.')) AS in_safe,
  host IN (SELECT domain FROM blacklist) OR plain IN (SELECT domain FROM blacklist) AS in_blacklist FROM hosted)"""


@register("list_flags", f"WITH {_HOSTED_SQL}, {_FLAGS_SQL} SELECT * FROM flags")
def list_flags(spark, sf_dir):
    hosts = with_hostname(corpora.addresses(spark, sf_dir).select("url"), out="host").select("host").where("host IS NOT NULL").distinct()
    return listmatch.with_list_flags(hosts, prepared_lists(spark, sf_dir), "host")


@register("list_flags_shuffled", f"WITH {_HOSTED_SQL}, {_FLAGS_SQL} SELECT url, in_whitelist, in_safe, in_blacklist FROM parts JOIN flags ON dom = host")
def list_flags_shuffled(spark, sf_dir):
    """The way taken when the lists are too big to broadcast."""
    lists = listmatch.prepare_lists(*corpora.domain_lists(spark, sf_dir), max_rows=0)
    hosts = with_hostname(corpora.addresses(spark, sf_dir).select("url")).where("hostname IS NOT NULL")
    return listmatch.with_list_flags(hosts, lists).drop("hostname")


_HOT_HOST = "CASE WHEN l_returnflag = 'R' THEN 'www.shop.hot.example.com' ELSE concat(substr(md5(cast(l_partkey AS string)), 1, 3), '.x', cast(l_suppkey % 50 AS string), '.com') END"
_HOT_LISTS = {
    "whitelist": "SELECT DISTINCT concat('x', cast(s_suppkey % 50 AS string), '.com') AS domain FROM supplier WHERE s_suppkey % 50 = 7",
    "safe": "SELECT DISTINCT concat('x', cast(s_suppkey % 50 AS string), '.com') AS domain FROM supplier WHERE s_suppkey % 50 < 5",
    "blacklist": "SELECT DISTINCT 'shop.hot.example.com' AS domain FROM supplier",
}


@register("list_flags_hot_host", f"""WITH {', '.join(f"{k} AS ({v.replace('AS string', 'AS varchar')})" for k, v in _HOT_LISTS.items())},
parts AS (SELECT l_returnflag, {_HOT_HOST.replace('AS string', 'AS varchar')} AS dom FROM lineitem), {_FLAGS_SQL}
SELECT l_returnflag, in_whitelist, in_safe, in_blacklist, count(*) AS n FROM parts JOIN flags ON dom = host GROUP BY ALL""")
def list_flags_hot_host(spark, sf_dir):
    """The way of big lists when a quarter of all rows have one host."""
    items, suppliers = corpora.table(spark, sf_dir, "lineitem"), corpora.table(spark, sf_dir, "supplier")
    lists = listmatch.prepare_lists(*(spark.sql(sql.replace("FROM supplier", "FROM {suppliers}"), suppliers=suppliers) for sql in _HOT_LISTS.values()), max_rows=0)
    hosts = items.select("l_returnflag", F.expr(_HOT_HOST).alias("hostname"))
    flagged = listmatch.with_list_flags(hosts, lists)
    return flagged.groupBy("l_returnflag", "in_whitelist", "in_safe", "in_blacklist").agg(F.count("*").alias("n"))


def _cascade_sql(base: str, keep: str, *more: str) -> str:
    """CTEs ending in ``verdicts`` for the addresses in CTE ``given``; ``more`` features are kept."""
    ml = features_sql((*corpora.RULE_FEATURES, *more), "browser", keep=("url",))
    return f"""WITH {base}, addresses AS (SELECT DISTINCT url FROM given),
ml AS (WITH {ml} SELECT url, {corpora.SCORE} AS p, has_ip_address IS NOT NULL AS ok{''.join(', ' + m for m in more)} FROM feats),
{browser_parts_sql(assume_http=False)}, {corpora.LISTS_SQL}, {_FLAGS_SQL},
listed AS (SELECT parts.url, dom, CASE WHEN in_whitelist THEN 'whitelist' WHEN in_safe THEN 'global_safe' WHEN in_blacklist THEN 'blacklist' END AS hit
  FROM parts LEFT JOIN flags ON dom = host),
verdicts AS (SELECT {keep}, dom,{''.join(f' ml.{m},' for m in more)}
  CASE WHEN dom IS NULL THEN NULL WHEN hit IN ('whitelist', 'global_safe') THEN 'safe' WHEN hit = 'blacklist' THEN 'phishing'
       WHEN NOT ok THEN 'error' WHEN p > 0.5 THEN 'phishing' ELSE 'safe' END AS result,
  CASE WHEN dom IS NULL THEN NULL WHEN hit IS NOT NULL THEN hit WHEN NOT ok THEN 'feature_extraction_failed' ELSE 'ml' END AS reason,
  CASE WHEN dom IS NULL THEN NULL WHEN hit IN ('whitelist', 'global_safe') THEN 0.0 WHEN hit = 'blacklist' THEN 1.0 WHEN ok THEN round(p, 6) END AS score
  FROM given JOIN listed USING (url) JOIN ml USING (url))"""


_ALL_GIVEN = f"{corpora.ADDRESSES_SQL.replace('addresses AS', 'given AS')}"


@register("verdict_cascade", f"{_cascade_sql(_ALL_GIVEN, 'page_id, given.url')} SELECT page_id, url, result, reason, CAST(score AS DOUBLE) AS score, CAST(NULL AS VARCHAR) AS error FROM verdicts")
def verdict_cascade(spark, sf_dir):
    verdicts = cascade.verdict_cascade(corpora.addresses(spark, sf_dir), prepared_lists(spark, sf_dir), corpora.rule_scorer)
    return rounded(verdicts)


@register("verdicts_patchy_model", f"""{_cascade_sql(_ALL_GIVEN, 'page_id, given.url', 'url_length')}
SELECT page_id, url, CASE WHEN silent THEN 'error' ELSE result END AS result, CASE WHEN silent THEN 'prediction_failed' ELSE reason END AS reason,
CASE WHEN NOT silent THEN CAST(score AS DOUBLE) END AS score, CASE WHEN silent THEN 'the model gave no prediction' END AS error
FROM (SELECT *, coalesce(reason = 'ml' AND url_length % 7 = 0, false) AS silent FROM verdicts)""")
def verdicts_patchy_model(spark, sf_dir):
    """A model that has no answer for some addresses."""
    def patchy(features: DataFrame) -> DataFrame:
        answered = F.col("url_length") % 7 != 0
        return corpora.rule_scorer(features).withColumns({c: F.when(answered, F.col(c)) for c in ("prediction", "probability_phishing")})

    return rounded(cascade.verdict_cascade(corpora.addresses(spark, sf_dir), prepared_lists(spark, sf_dir), patchy))


@register("verdicts_without_model", f"""{_cascade_sql(_ALL_GIVEN, 'given.url')}
SELECT CASE WHEN reason IN ('ml', 'feature_extraction_failed') THEN 'error' ELSE result END AS result,
CASE WHEN reason IN ('ml', 'feature_extraction_failed') THEN 'model_not_loaded' ELSE reason END AS reason, count(*) AS n FROM verdicts GROUP BY ALL""")
def verdicts_without_model(spark, sf_dir):
    verdicts = cascade.verdict_cascade(corpora.addresses(spark, sf_dir), prepared_lists(spark, sf_dir))
    return verdicts.groupBy("result", "reason").agg(F.count("*").alias("n"))


@register("request_answers", f"""{_cascade_sql(_ALL_GIVEN, 'page_id, given.url')} SELECT page_id, url, coalesce(result, 'error') AS result,
coalesce(reason, 'no_response') AS reason, CAST(score AS DOUBLE) AS score, CAST(NULL AS VARCHAR) AS error FROM verdicts""")
def request_answers(spark, sf_dir):
    answers = cascade.answer_requests(corpora.addresses(spark, sf_dir), prepared_lists(spark, sf_dir), corpora.rule_scorer)
    return rounded(answers)


@register("display_text", f"""{_cascade_sql(_ALL_GIVEN, 'given.url')}
SELECT url, CASE WHEN result = 'phishing' AND reason = 'blacklist' THEN 'Found in known blacklist'
WHEN result = 'phishing' AND reason = 'ml' THEN 'ML Confidence: ' || format('{{:.1f}}%', score * 100)
WHEN result = 'safe' AND reason = 'whitelist' THEN 'In your whitelist' WHEN result = 'safe' AND reason = 'global_safe' THEN 'Verified safe domain'
WHEN result = 'safe' AND reason = 'ml' THEN 'Safety Score: ' || format('{{:.1f}}%', (1 - score) * 100) ELSE 'Analysis in progress...' END AS message FROM verdicts""")
def display_text(spark, sf_dir):
    verdicts = cascade.verdict_cascade(corpora.addresses(spark, sf_dir), prepared_lists(spark, sf_dir), corpora.rule_scorer)
    text = explain.display_text(*(F.col(c) for c in cascade.VERDICT_COLUMNS))
    return verdicts.select("url", text.alias("message"))


@register("display_ties", """SELECT DISTINCT score, 'ML Confidence: ' || format('{:.1f}%', score * 100 + 1e-9) AS danger,
'Safety Score: ' || format('{:.1f}%', (1 - score) * 100 + 1e-9) AS safety FROM (SELECT (l_orderkey % 33) / 32.0::DOUBLE AS score FROM lineitem)""")
def display_ties(spark, sf_dir):
    """Scores half-way between two tenths of a percent among others."""
    scores = corpora.table(spark, sf_dir, "lineitem").select(((F.col("l_orderkey") % 33) / 32.0).alias("score")).distinct()

    def text(result: str):
        return explain.display_text(F.lit(result), F.lit("ml"), F.col("score"), F.lit(None).cast("string"))

    return scores.select("score", text("phishing").alias("danger"), text("safe").alias("safety"))


# --------------------------------------------------------------- navigation

_VISITS_SQL = f"""{corpora.SOURCES_SQL.split('primary_raw')[0].strip().rstrip(',')},
given AS (SELECT event_id, url FROM visits WHERE event_type <> 'error' AND starts_with(url, 'http'))"""


def navigations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.visits(spark, sf_dir).selectExpr(
        "event_id", "user_id AS tab_id", "CASE WHEN event_type = 'error' THEN 'loading' ELSE 'complete' END AS status", "url", "ts")


_COUNTERS = """SELECT count(*) AS sites_checked, count(*) FILTER (result = 'phishing') AS phishing_blocked,
count(*) FILTER (result = 'safe') AS safe_visited FROM verdicts"""


@register("nav_counters", f"{_cascade_sql(_VISITS_SQL, 'event_id, given.url')} {_COUNTERS}")
def nav_counters(spark, sf_dir):
    """A verdict depends on the address alone, so each distinct address is
    judged once and counted with its number of visits."""
    loads = navigation.completed_loads(navigations(spark, sf_dir)).groupBy("url").agg(F.count("*").alias("visits"))
    verdicts = cascade.verdict_cascade(loads, prepared_lists(spark, sf_dir), corpora.rule_scorer)
    return metrics.session_counters(verdicts, F.col("visits"))


@register("alerts", f"""{_cascade_sql(_VISITS_SQL, 'event_id, given.url')}
SELECT event_id, url, dom AS host, dom || ' may be dangerous' AS message FROM verdicts WHERE result = 'phishing'""")
def alerts(spark, sf_dir):
    loads = navigation.completed_loads(navigations(spark, sf_dir)).select("event_id", "url")
    verdicts = cascade.verdict_cascade(loads, prepared_lists(spark, sf_dir), corpora.rule_scorer, host_col="host")
    return cascade.alerts(verdicts).select("event_id", "url", "host", "message")


_OPS_SQL = f"""{corpora.SOURCES_SQL.split('primary_raw')[0].strip().rstrip(',')},
ops AS (SELECT event_id AS seq, CASE WHEN event_type = 'error' THEN 'remove' ELSE 'add' END AS op,
  CASE WHEN event_type = 'error' THEN {corpora.HOST_SQL} WHEN event_type = 'view' THEN substr(url, 9) ELSE url END AS value FROM visits),
changes AS (SELECT seq, op, CASE WHEN op = 'remove' THEN value ELSE regexp_replace(regexp_extract(value, '^https?://([^/]+)', 1), '^www[.]', '') END AS domain
  FROM ops WHERE op = 'remove' OR starts_with(value, 'http')),
state AS (SELECT domain FROM changes GROUP BY domain HAVING max_by(op, seq) = 'add')"""


def whitelist_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.visits(spark, sf_dir).selectExpr(
        "event_id AS seq", "CASE WHEN event_type = 'error' THEN 'remove' ELSE 'add' END AS op",
        f"CASE WHEN event_type = 'error' THEN {corpora.HOST_SQL} WHEN event_type = 'view' THEN substr(url, 9) ELSE url END AS value")


@register("whitelist_state", f"WITH {_OPS_SQL} SELECT domain FROM state")
def whitelist_state(spark, sf_dir):
    return navigation.whitelist_state(whitelist_ops(spark, sf_dir))


@register("whitelist_search", f"WITH {_OPS_SQL} SELECT domain FROM state WHERE contains(domain, 'blog')")
def whitelist_search(spark, sf_dir):
    return listmatch.list_filter(navigation.whitelist_state(whitelist_ops(spark, sf_dir)), "Blog")


def _scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared one, which goes when the driver ends."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    delete(spark, folder, at_end=True)
    return folder


@register("stream_counters", f"{_cascade_sql(_VISITS_SQL, 'event_id, given.url')} {_COUNTERS}")
def stream_counters(spark, sf_dir):
    """The same totals from a stream over files, through the saved snapshots."""
    folder = _scratch(spark, "navigations")
    navigations(spark, sf_dir).drop("event_id").write.parquet(f"{folder}/events")
    events = navigation.navigation_stream(spark, f"{folder}/events", "parquet", maxFilesPerTrigger=4)
    verdicts = navigation.stream_verdicts(events, prepared_lists(spark, sf_dir), corpora.rule_scorer)
    navigation.persist_counters(navigation.stream_counters(verdicts), f"{folder}/counters", f"{folder}/checkpoint").awaitTermination()
    return navigation.load_counters(spark, f"{folder}/counters")


# ----------------------------------------------------------------- training

def training_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = url_features(corpora.addresses(spark, sf_dir).select("url").where("url <> ''").distinct())
    return features.withColumn("label", F.expr(corpora.TRUTH))


# Far below the published settings: these queries show that training works.
SMALL_PARAMS = training.GbtParams(iterations=4, learning_rate=0.3, depth=4, max_bins=32, early_stopping_rounds=0, min_gain=1e-4)


@register("gbt_train")
def gbt_train(spark, sf_dir):
    run = training.train(training_features(spark, sf_dir), SMALL_PARAMS, folds=3)
    return spark.createDataFrame([(k, v) for k, v in run.metrics.items()], "metric string, value double")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(training.feature_vector(training_features(spark, sf_dir)).select("url", "label", "features_vector"))


@register("kfold_best")
def kfold_best(spark, sf_dir):
    frame = splits.stratified_kfold(_vectors(spark, sf_dir), 3)
    return training.select_best_fold(training.kfold_train(frame, SMALL_PARAMS, 3).aucs)


@register("gbt_importance")
def gbt_importance(spark, sf_dir):
    return training.feature_importance(training.fit_gbt(_vectors(spark, sf_dir), SMALL_PARAMS), spark)


@register("learning_curve")
def learning_curve(spark, sf_dir):
    """Every round on the rows learned from and on those held out, which no round learns from."""
    parts = splits.stratified_holdout(_vectors(spark, sf_dir))
    sets = {name: parts.where(F.col("split") == name) for name in ("train", "test")}
    return curves.learning_curves(training.fit_gbt(sets["train"], SMALL_PARAMS), sets)


@register("gbt_score")
def gbt_score(spark, sf_dir):
    model = training.fit_gbt(_vectors(spark, sf_dir), SMALL_PARAMS)
    features = url_features(corpora.addresses(spark, sf_dir).select("url").where("url <> ''"))
    return explain.prediction_record(training.score(features, model)).drop("features")
