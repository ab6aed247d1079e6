"""Working data derived from the given tables, as Spark frames and as SQL.

Every corpus grows with its table: each page gives one address per pattern in
``ADDRESS_PATTERNS``, each line item one address. The patterns are expressions
that mean the same in Spark SQL and in the checking engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# `u` is the page address, `r` the same without scheme, `m` its md5, `i` the
# page number as text.
ADDRESS_PATTERNS = (
    "u",
    "r",
    "upper(u)",
    "replace(u, '://', '://user:pw@')",
    "replace(u, '/en/', ':8443/en/')",
    "concat('http://192.168.7.', i, ':8080/admin//x.php?id=', m, '&b=2#frag')",
    "concat('http://10.0.0.', i, '/')",
    "concat('https://172.20.1.1:443/', i)",
    "concat('http://127.0.0.1:80/', i, '?a')",
    "concat('ftp://', r)",
    "concat('httpx://', r)",
    "concat('https://secure-paypal-login-verify', i, '.ru/account/update?session=', m)",
    "concat(u, '/', substr(m, 1, 30), '=')",
    "concat(u, ';p=1/x;q=2?a=1&b=2&c=,')",
    "replace(u, '.example.', '..example.')",
    "concat('http://xn--', substr(m, 1, 12), '.com/XN--')",
    "replace(u, 'http', 'hxxp')",
    "concat(u, '?redirect=https://', r, '&url=http://t.co/x')",
    "concat(u, '%20%C3%A9?q=é😀')",
    "concat('http://почта', i, '.рф/путь')",
    "concat('http://bit.ly/', substr(m, 1, 8), 'AAAA')",
    "concat('javascript:alert(', i, ')')",
    "concat('data:text/html,', r)",
    "concat('http://me', i, '@mail.com/wwwww___-,,;;confirm')",
    "concat('http://a.a.b', i, '.tk:', i, '/login.php')",
    "concat('http://[::', substr(m, 1, 2), ']:99/x')",
    "concat('http://[', m, '/x')",
    "concat('http://host', i, '.online:99/a..b...c/d', chr(9), 'e', chr(10), 'f')",
    "concat(u, chr(39), chr(92), '`~!*(){}|<>\"^$')",
    "concat('http://É1²③', i, '.com/Ⅷ')",
    "concat('http://a', i, '／b.com/x')",
    "concat('http://localhost:/', i)",
    "concat('http:///', i)",
    "replace(u, 'top', '')",
    "concat('https://m.', substr(m, 1, 6), '.', substr(m, 7, 3), '.example.org?u=1')",
    "concat('http://https-login', i, '.example.com/')",
    "concat('http://a_b', i, '.example.com/')",
    "concat('http://a', i, '.com/\u202ex')",
    "concat('http://a', i, '.com/', chr(13), chr(13), chr(13), 'y')",
    "concat('http://a', i, '.com/z\u2028\u2028\u2028y')",
    "concat('http://999.1.', i, '.1/')",
    "concat('http://foo.', i, '/a')",
    "''",
)


PAGE_COLUMNS = (
    "page_id", "url AS u", "substr(url, instr(url, '://') + 3) AS r", "md5(url) AS m", "cast(page_id AS string) AS i",
)
ADDRESSES_SQL = (
    f"addresses AS (SELECT page_id, unnest([{', '.join(ADDRESS_PATTERNS)}]) AS url "
    f"FROM (SELECT {", ".join(PAGE_COLUMNS)} FROM pages))"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a table that comes as one small file. A table that is
    already read by enough tasks stays as it is, without a shuffle."""
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, url``: every page address in every pattern."""
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "url")).selectExpr(*PAGE_COLUMNS)
    return pages.select("page_id", F.explode(F.array(*(F.expr(p) for p in ADDRESS_PATTERNS))).alias("url"))


# One address per line item.
ITEM_ADDRESS = (
    "concat(CASE WHEN l_returnflag = 'A' THEN 'https://' ELSE 'http://' END, "
    "CASE WHEN l_linestatus = 'O' THEN 'www.' ELSE 'login-' END, substr(h, 1, 10), "
    "CASE WHEN l_returnflag = 'R' THEN '.example.tk' ELSE '.example.com' END, "
    "'/', substr(h, 8, 12), '/index.php?id=', cast(l_partkey AS string), '&session=', substr(h, 20, 8))"
)
ITEM_HASH = "md5(concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string)))"
ITEMS_SQL = (
    f"addresses AS (SELECT l_returnflag, {ITEM_ADDRESS} AS url "
    f"FROM (SELECT *, {ITEM_HASH} AS h FROM lineitem))"
)


def item_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_partkey")
    items = spread(table(spark, sf_dir, "lineitem").select(*columns)).withColumn("h", F.expr(ITEM_HASH))
    return items.select("l_returnflag", F.expr(ITEM_ADDRESS).alias("url"))


# Labelled sources: a primary one with words as labels, a secondary one with
# numbers, many repeats, null addresses and null labels.
PRIMARY_LABEL = (
    "CASE WHEN quality IS NULL THEN NULL WHEN toxic = 1 THEN 'Malicious' "
    "WHEN quality = 0 THEN 'phishing' ELSE 'legitimate' END"
)
SECONDARY_URL = (
    "CASE WHEN event_type = 'signup' THEN NULL WHEN event_type IN ('view', 'purchase') "
    "THEN concat(url, '&u=', cast(user_id AS string)) ELSE url END"
)
SECONDARY_STATUS = "CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' THEN '1' ELSE '0' END"

SOURCES_SQL = f"""
visits AS (SELECT e.*, p.url FROM events e JOIN pages p ON e.event_id % (SELECT count(*) FROM pages) = p.page_id),
primary_raw AS (SELECT url AS text, {PRIMARY_LABEL} AS label, page_id AS n FROM pages LEFT JOIN labels ON doc_id = page_id),
secondary_raw AS (SELECT {SECONDARY_URL} AS URL, {SECONDARY_STATUS} AS status, event_id AS n FROM visits)"""


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, each with the address of one page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    ids = pages.agg(F.count("*").alias("n"), F.min("page_id").alias("low"), F.max("page_id").alias("high"), F.count_distinct("page_id").alias("kinds")).first()
    count = ids["n"]
    if count and (ids["low"], ids["high"], ids["kinds"]) != (0, count - 1, count):
        raise ValueError("page ids must count from 0, or events would lose their page")
    events = table(spark, sf_dir, "events").withColumn("page_id", F.col("event_id") % F.lit(count))
    return events.join(pages, "page_id").drop("page_id")


def primary_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "page_id")
    return pages.join(labels, "page_id", "left").selectExpr("url AS text", f"{PRIMARY_LABEL} AS label", "page_id AS n")


def secondary_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits(spark, sf_dir).selectExpr(f"{SECONDARY_URL} AS URL", f"{SECONDARY_STATUS} AS status", "event_id AS n")


# Domain lists from the pages' hosts.
HOST_SQL = "split_part(split_part(url, '://', 2), '/', 1)"
LISTS_SQL = f"""
hosts AS (SELECT DISTINCT {HOST_SQL} AS host FROM pages),
bases AS (SELECT DISTINCT regexp_extract(host, '[^.]+[.][^.]+[.][^.]+$', 0) AS base FROM hosts),
whitelist AS (SELECT DISTINCT regexp_replace(host, '^www[.]', '') AS domain FROM hosts WHERE substr(md5(host), 1, 1) < '3'),
safe AS (SELECT base AS domain FROM bases WHERE substr(md5(base), 1, 1) BETWEEN '3' AND '7'),
blacklist AS (SELECT host AS domain FROM hosts WHERE substr(md5(host), 1, 1) BETWEEN '4' AND 'b')"""


def domain_lists(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(whitelist, safe, blacklist)``, each one column ``domain``."""
    hosts = table(spark, sf_dir, "pages").select(F.expr(HOST_SQL).alias("host")).distinct()
    digit = F.substring(F.md5("host"), 1, 1)
    whitelist = hosts.where(digit < "3").select(F.regexp_replace("host", r"^www\.", "").alias("domain")).distinct()
    bases = hosts.select(F.substring_index("host", ".", -3).alias("domain")).distinct()
    safe = bases.where(F.substring(F.md5("domain"), 1, 1).between("3", "7"))
    blacklist = hosts.where(digit.between("4", "b")).select(F.col("host").alias("domain"))
    return whitelist, safe, blacklist


# A score that is a plain function of the features, in hundredths.
POINTS = (
    "5 + 25 * has_ip_address + 15 * qty_suspicious_keywords + 20 * has_suspicious_tld"
    " + 10 * has_at_symbol + 7 * qty_hyphen_url + 12 * has_url_shortener"
)
SCORE = f"CAST(least({POINTS}, 99) AS DOUBLE) / 100"
RULE_FEATURES = (
    "has_ip_address", "qty_suspicious_keywords", "has_suspicious_tld", "has_at_symbol", "qty_hyphen_url",
    "has_url_shortener",
)
TRUTH = (
    "CAST(CASE WHEN has_sensitive_words = 1 OR has_multiple_domains = 1 OR url_length > 60"
    " OR has_suspicious_tld = 1 THEN 1 ELSE 0 END AS INT)"
)


def rule_scorer(features: DataFrame) -> DataFrame:
    """Stands in for a trained model where results must be reproducible in SQL."""
    p = F.expr(SCORE)
    return features.withColumns({
        "probability_phishing": p, "probability_legitimate": 1 - p, "prediction": (p > 0.5).cast("int"),
    })
