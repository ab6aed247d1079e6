"""Golden rows, CPython parity and properties of the 73 features."""

import json
import math
import re
import unicodedata
from collections import Counter
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urlwarden.functions.entropy import arrow_entropy, native_entropy
from urlwarden.functions.features import url_features
from urlwarden.functions.urlparts import PART_NAMES, with_url_parts
from urlwarden.functions.vocab import BIGINT_FEATURES, DOUBLE_FEATURES, FEATURE_NAMES

GOLDEN = [
    json.loads(line)
    for line in (Path(__file__).resolve().parents[1] / "FIXTURES.md").read_text().splitlines()
    if line.startswith('{"url"')
]


def frame(spark, urls):
    return spark.createDataFrame([(u,) for u in urls], "url string")


@pytest.mark.parametrize("entropy", ["arrow", "native"])
def test_golden_rows(spark, entropy):
    assert len(GOLDEN) == 39
    rows = url_features(frame(spark, [g["url"] for g in GOLDEN]), entropy=entropy).collect()
    wrong = []
    for row in rows:
        want = next(g for g in GOLDEN if g["url"] == row.url)
        for name in FEATURE_NAMES:
            if abs(row[name] - want.get(name, 0)) > 1e-8:
                wrong.append((row.url, name, row[name], want.get(name, 0)))
    assert wrong == []


def test_schema_is_the_contract(spark):
    out = url_features(frame(spark, ["a.com"]))
    assert out.columns == ["url", *FEATURE_NAMES]
    for field in out.schema.fields[1:]:
        want = (T.LongType() if field.name in BIGINT_FEATURES
                else T.DoubleType() if field.name in DOUBLE_FEATURES else T.IntegerType())
        assert field.dataType == want, field.name


@pytest.mark.parametrize("profile", ["training", "browser"])
def test_missing_address_gives_nulls(spark, profile):
    for row in url_features(frame(spark, [None, ""]), profile=profile).collect():
        assert all(row[n] is None for n in FEATURE_NAMES), [n for n in FEATURE_NAMES if row[n] is not None]


ODD = [
    "http://[::1]/x", "http://[1::2:3:4:5:6:7:8]/", "http://[1:2:3:4:5:6:7::]/", "http://[::ffff:1.2.3.4]/a",
    "http://[::ffff:1.2.3.04]/a", "http://[v1.x]/", "http://[v1.]/", "http://[1.2.3.4]/", "http://a]b[::1]/",
    "http://[fe80::1%eth0]/", "http://[fe80::1%]/", "http://[]/", "http://x[::1]y/z", "http://[:::]/",
    "http://[1:2:3:4:5:6:7:8]/", "http://[1:2:3:4:5:6:1.2.3.4]/", "http://[::1:2:3:4:5:6:7]/", "http://[12345::]/",
    "http://a／b.com/x", "http://a℀b.com", "http://ｅx.com/", "http://x.com:８０/", "http://x.com: 80/",
    "http://x.com:+80/", "http://x.com:-5/", "http://x.com:8__0/", "http://x.com:99999999999999999999/",
    "ht\ttp://x.com/a", "http://x.com/a;b c;d/e", "x;y", "x;y/z;", "http://x.com;p=1/q;r", "?a=b", "#frag", "//x/y",
    "http://x.com/ ;a", "http://x.com/; ", "http://1.2.3.4 /", " http://x.com", "http://X.COM/ÀÉ",
    "http://İ.İ/", "http://x.ΑΣ/", "KELVIN.K.banK", "https://", "http://", "http:/x", "http://a@b@c:1:2/",
    "http://٣.٣.٣.٣/", "http://a.b.a.c/aaa", "a..b...c", "http://x.com/'\\\\", "\x00", "http://x.com/\x7f\x85",
]


def test_url_parts_match_cpython(spark):
    rows = with_url_parts(frame(spark, ODD + [g["url"] for g in GOLDEN])).collect()
    for row in rows:
        full = row.url if row.url.startswith(("http://", "https://")) else "http://" + row.url
        try:
            want = urlparse(full)
        except ValueError:
            want = urlparse("http://invalid")
        got = tuple(row[n] for n in PART_NAMES[:6])
        assert got == (want.scheme, want.netloc, want.path, want.params, want.query, want.fragment), row.url
        assert row.host == want.netloc.split(":")[0]


def test_counts_match_python_string_methods(spark):
    """An independent restatement of a few definitions with Python strings."""
    for row in url_features(frame(spark, ODD)).collect():
        url = row.url
        full = url if url.startswith(("http://", "https://")) else "http://" + url
        try:
            parts = urlparse(full)
        except ValueError:
            parts = urlparse("http://invalid")
        host = parts.netloc.split(":")[0]
        try:
            port = int(parts.netloc.split(":")[1])
        except (IndexError, ValueError):
            port = -1
        want = {
            "url_length": len(parts.geturl()),
            "port_number": port if port < 2**63 else -1,
            "qty_digits_url": sum(map(str.isdigit, url)),
            "qty_uppercase_url": sum(map(str.isupper, url)),
            "qty_percent_alpha": sum(map(str.isalpha, url)) / len(url),
            "has_numeric_only_domain": int(host.replace(".", "").isdigit()),
            "has_consecutive_letters": int(bool(re.search(r"(.)\1{2,}", url))),
            "has_ip_address": int(bool(re.match(r"^\d{1,3}(\.\d{1,3}){3}$", host))),
            "tld_length": len(host.split(".")[-1]) if "." in host else 0,
            "qty_consecutive_dots": url.count(".."),
            "entropy_url": -sum(n / len(url) * math.log2(n / len(url)) for n in Counter(url).values()),
        }
        for name, value in want.items():
            assert row[name] == pytest.approx(value, abs=1e-9), (url, name)


def test_entropy_forms_agree(spark):
    texts = ["", None, "a", "aab", "日本日本x", "😀😀a", "é" * 10 + "e", *ODD]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    for row in df.select("t", arrow_entropy("t").alias("a"), native_entropy(F.col("t")).alias("n")).collect():
        if row.t is None:
            assert row.a is None
        else:
            assert row.a == pytest.approx(row.n, abs=1e-12)


def test_digit_class_covers_python_isdigit(spark):
    """Every character Python 3.13 calls a digit, up to the JVM's Unicode version."""
    digits = [chr(c) for c in range(0x110000) if chr(c).isdigit()]
    df = spark.createDataFrame([(d,) for d in digits], "url string")
    missed = url_features(df, features=["qty_digits_url"]).filter("qty_digits_url <> 1").collect()
    assert all(unicodedata.category(r.url) == "Nd" and ord(r.url) > 0x11F00 for r in missed), missed


def test_properties(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("url")
    f = url_features(pages)
    bad = f.filter(
        "entropy_url < 0 or qty_slashes_path <> url_depth or has_unicode_chars <> has_uncommon_chars "
        "or has_suspicious_protocol <> 0 or has_obfuscation <> greatest(has_base64_encoding, has_hex_encoding)"
    )
    assert bad.count() == 0 and f.count() == pages.count()


def test_letters_and_capitals_need_no_search_of_their_own(spark):
    """Letters follow from digits and marks, capitals are searched for only where lower case changes the text."""
    rows = [("http://ab1.com/X-y2",), ("http://É1²③.com/Ⅷaa9",), ("http://plain.example/9",), ("ДОМ.рф/a٣",), ("ﬁx.com/ǅ",)]
    df = spark.createDataFrame(rows, "url string")
    got = url_features(df, features=("qty_uppercase_url", "qty_percent_alpha", "qty_digits_url"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count(r"\p{Alpha}+") == 0
    for r in got.collect():
        letters = sum(unicodedata.category(c).startswith("L") for c in r.url)
        assert r.qty_percent_alpha == pytest.approx(letters / len(r.url))
        if r.url.isascii():
            assert r.qty_uppercase_url == sum(c.isupper() for c in r.url)
            assert r.qty_digits_url == sum(c.isdigit() for c in r.url)
