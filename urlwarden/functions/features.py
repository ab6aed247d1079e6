"""The 73 address features as column expressions.

``url_features`` is a chain of projections: parse, stage the texts that many
features share, then one final projection. Regular expressions stick to single
predefined classes such as ``\\p{Alnum}``, which Java matches several times
faster than unions of ranges, and start with the shortest equivalent form of
each pattern ("contains a match" needs no trailing repetition).
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlwarden.functions.browser import utf16_length, utf16_entropy, with_browser_parts
from urlwarden.functions.entropy import arrow_entropy, native_entropy
from urlwarden.functions.text import (
    ANY_DIGIT, ANY_LETTER, ANY_UPPERCASE, contains_any, flag, is_ascii,
    occurrences, removed_bytes, removed_chars, words_present,
)
from urlwarden.functions.urlparts import top_level_domain, with_url_parts
from urlwarden.functions.vocab import (
    BRAND_KEYWORDS, BROWSER_DOUBLED_KEYWORD, COMMON_TLDS, FEATURE_NAMES,
    SENSITIVE_WORDS, SHORTENERS, SPECIAL_CHARACTERS, SUSPICIOUS_KEYWORDS,
    SUSPICIOUS_TLDS, TLD_CODES, TRAINING_ONLY_SHORTENER,
)

PROFILES = ("training", "browser")

CHARACTER_FEATURES = {
    "qty_dot_url": ".", "qty_hyphen_url": "-", "qty_slash_url": "/",
    "qty_question_url": "?", "qty_percent_url": "%", "qty_at_url": "@",
    "qty_ampersand_url": "&", "qty_equal_url": "=", "qty_underscore_url": "_",
    "qty_colon_url": ":", "qty_semicolon_url": ";", "qty_comma_url": ",",
}

DOTTED_QUAD = r"\A[\p{Nd}]{1,3}(?:\.[\p{Nd}]{1,3}){3}\z"
DOTTED_QUAD_ASCII = r"\A[0-9]{1,3}(?:\.[0-9]{1,3}){3}\z"
PRIVATE_ADDRESS = r"\A(?:192\.168|10|172\.(?:1[6-9]|2[0-9]|3[01]))\."
PRIVATE_OR_LOOPBACK = r"\A(?:127|192\.168|10|172\.(?:1[6-9]|2[0-9]|3[01]))\."
LONG_CODE_RUN = r"(?<![\p{Alnum}+/])[\p{Alnum}+/]{25}"
MAIL_LIKE = r"[\w.%+-]@[\p{Alnum}.-]+\.\p{Alpha}{2}"
TRIPLE_CHARACTER = r"([^\n])\1\1"
TRIPLE_CODE_UNIT = r"([^\n\r\x{2028}\x{2029}\x{10000}-\x{10FFFF}])\1\1"
CYRILLIC = "[а-яА-ЯёЁ]"
SPECIAL_IN_PUNCTUATION = {"'", "\\"}  # ASCII punctuation that is not special


# Every decimal digit of every script outside ASCII, and its ASCII value.
DECIMAL_DIGITS = "".join(chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd")
ASCII_VALUES = "".join(str(unicodedata.decimal(c)) for c in DECIMAL_DIGITS)


def feature_names() -> tuple[str, ...]:
    return FEATURE_NAMES


@dataclass(frozen=True)
class _Texts:
    """Staged inputs of the feature formulas."""

    url: Column        # the address as given; null when rejected
    low: Column        # the same in lower case
    marks: Column      # the same without ASCII letters and digits
    chars: Column      # its length in the profile's character unit
    scheme: Column
    domain: Column     # network location (training) or host name (browser)
    low_domain: Column
    host: Column
    path: Column
    query: Column
    fragment: Column


def _ratio(part: Column, whole: Column) -> Column:
    return part / whole


def _class_counts(text: Column, low: Column | None = None, marks: Column | None = None, *, any_script: bool) -> tuple[Column, Column, Column]:
    """(digits, letters, uppercase) of ``text``; ``low`` is it in lower case, ``marks`` it without ASCII letters and digits."""
    digits = removed_bytes(text, r"\p{Digit}+")
    letters = removed_bytes(text, r"\p{Alpha}+") if marks is None else F.octet_length(text) - F.octet_length(marks) - digits
    upper = removed_bytes(text, r"\p{Upper}+")
    if low is not None:  # a text equal to its lower case needs no search
        upper = F.when(text == low, F.lit(0)).otherwise(upper)
    if not any_script:
        return digits, letters, upper
    plain = is_ascii(text)
    return (
        F.when(plain, digits).otherwise(removed_chars(text, ANY_DIGIT)),
        F.when(plain, letters).otherwise(removed_chars(text, ANY_LETTER)),
        F.when(plain, upper).otherwise(removed_chars(text, ANY_UPPERCASE)),
    )


def _structure(t: _Texts, quad: str, private: str) -> dict[str, Column]:
    slashes = occurrences(t.path, "/")
    return {
        "domain_length": F.length(t.domain),
        "subdomain_count": F.when(t.url.isNotNull(), F.greatest(occurrences(t.domain, ".") - 1, F.lit(0))),
        "path_length": F.length(t.path),
        "query_length": F.length(t.query),
        "fragment_length": F.length(t.fragment),
        "has_ip_address": flag(t.host.rlike(quad)),
        "has_https": flag(t.scheme == "https"),
        "has_at_symbol": flag(F.contains(t.marks, F.lit("@"))),
        "has_double_slash_redirect": flag(F.contains(t.path, F.lit("//"))),
        "url_depth": slashes,
        "qty_slashes_path": slashes,
        "qty_dots_path": occurrences(t.path, "."),
        "path_has_parameters": flag(t.query != ""),
        "qty_parameters": occurrences(t.query, "&") + flag(t.query != ""),
        "has_localhost": flag(F.contains(t.low_domain, F.lit("localhost"))),
        "has_internal_ip": flag(t.host.rlike(private)),
        "has_suspicious_protocol": flag(~t.scheme.isin("http", "https")),
    }


def _characters(t: _Texts, any_script: bool) -> dict[str, Column]:
    digits, letters, upper = _class_counts(t.url, t.low, t.marks, any_script=any_script)
    special = removed_bytes(t.marks, r"\p{Punct}+")
    for character in SPECIAL_IN_PUNCTUATION:
        special = special - occurrences(t.marks, character)
    plain = is_ascii(t.url)
    foreign = flag(~plain)
    features = {name: occurrences(t.marks, c) for name, c in CHARACTER_FEATURES.items()}
    return features | {
        "qty_vowels_url": removed_bytes(t.url, "[aeiouAEIOU]+"),
        "qty_digits_url": digits,
        "qty_uppercase_url": upper,
        "qty_consecutive_dots": occurrences(t.url, ".."),
        "qty_special_chars": special,
        "ratio_special_to_length": _ratio(special, t.chars),
        "qty_percent_digits": _ratio(digits, t.chars),
        "qty_percent_alpha": _ratio(letters, t.chars),
        "has_hex_encoding": flag(F.contains(t.marks, F.lit("%"))),
        "has_uncommon_chars": foreign,
        "has_unicode_chars": foreign,
        "has_mixed_scripts": flag(~plain & t.url.rlike(CYRILLIC) & t.url.rlike(r"\p{Alpha}")),
        "has_rtl_override": flag(F.contains(t.url, F.lit("\u202e"))),
    }


def _host(t: _Texts, any_script: bool) -> dict[str, Column]:
    digits, letters, _ = _class_counts(t.host, any_script=any_script)
    dotted = F.contains(t.host, F.lit("."))
    last_label = F.substring_index(t.host, ".", -1)
    tld = top_level_domain(t.host)
    labels = F.split(t.host, r"\.")
    inner = F.slice(labels, F.lit(1), F.size(labels) - F.lit(1))
    code = F.when(tld.isNull(), None)
    for number, name in enumerate(TLD_CODES, start=1):
        code = code.when(tld == name, number)
    return {
        "tld_length": F.when(dotted, F.length(last_label)).when(t.host.isNotNull(), 0),
        "domain_extension": code.otherwise(0),
        "has_common_tld": flag(tld.isin(*COMMON_TLDS)),
        "has_suspicious_tld": flag(tld.isin(*SUSPICIOUS_TLDS)),
        "qty_hyphens_domain": occurrences(t.host, "-"),
        "qty_underscores_domain": occurrences(t.host, "_"),
        "domain_digits_ratio": F.when(letters > 0, _ratio(digits, letters)).when(letters == 0, F.lit(0.0)),
        "has_numeric_only_domain": flag((digits > 0) & (digits == F.length(t.host) - occurrences(t.host, "."))),
        "has_numerics_in_domain": flag(digits > 0),
        "has_repeated_subdomains": F.when(t.host.isNull(), None)
            .when(~dotted, 0)
            .otherwise(flag(F.size(inner) != F.size(F.array_distinct(inner)))),
    }


def _lexical(t: _Texts) -> dict[str, Column]:
    words = words_present(t.low, SUSPICIOUS_KEYWORDS)
    brands = words_present(t.low, BRAND_KEYWORDS)
    coded = t.url.rlike(LONG_CODE_RUN)
    return {
        "has_multiple_domains": flag(occurrences(t.low, "http") > 1),
        "has_suspicious_keywords": flag(words > 0),
        "qty_suspicious_keywords": words,
        "has_brand_mimicking": flag(brands > 0),
        "qty_brand_mimicking": brands,
        "has_base64_encoding": flag(coded),
        "has_obfuscation": flag(F.contains(t.marks, F.lit("%")) | coded),
        "has_email_format": flag(F.contains(t.marks, F.lit("@")) & t.url.rlike(MAIL_LIKE)),
        "has_sensitive_words": flag(contains_any(t.low, SENSITIVE_WORDS)),
    }


def _training_only(t: _Texts, params: Column, entropy) -> dict[str, Column]:
    def longer(text: Column) -> Column:
        return F.when(text != "", F.length(text) + 1).otherwise(0)

    declared = F.substring_index(F.get(F.split(t.low, "://", 3), F.lit(1)), "/", 1)
    port = F.get(F.split(t.domain, ":", 3), F.lit(1))
    port = F.when(is_ascii(port), port).otherwise(F.translate(port, DECIMAL_DIGITS, ASCII_VALUES))
    port = F.regexp_replace(port, r"(?<=[0-9])_(?=[0-9])", "")
    has_port = F.contains(t.domain, F.lit(":"))
    return {
        "url_length": F.length(t.scheme) + 3 + F.length(t.domain) + F.length(t.path)
            + longer(params) + longer(t.query) + longer(t.fragment),
        "has_port": flag(has_port),
        "port_number": F.when(t.url.isNull(), None).when(
            has_port, F.coalesce(port.try_cast("bigint"), F.lit(-1).cast("bigint"))
        ).otherwise(F.lit(-1).cast("bigint")),
        "has_https_in_domain": F.when(t.url.isNotNull(), F.coalesce(
            flag(F.contains(declared, F.lit("https"))), F.lit(0))),
        "has_http_in_domain": F.when(t.url.isNotNull(), F.coalesce(
            flag(F.contains(declared, F.lit("http"))), F.lit(0))),
        "has_url_shortener": flag(contains_any(t.low_domain, SHORTENERS)),
        "has_consecutive_letters": flag(t.url.rlike(TRIPLE_CHARACTER)),
        "has_javascript_protocol": flag(F.contains(t.low, F.lit("javascript:"))),
        "has_data_protocol": flag(F.contains(t.low, F.lit("data:"))),
        "has_punycode": flag(F.contains(t.low, F.lit("xn--"))),
        "entropy_url": entropy(t.url),
        "entropy_domain": entropy(t.domain),
    }


def _browser_only(t: _Texts, port: Column, entropy) -> dict[str, Column]:
    words = words_present(t.low, SUSPICIOUS_KEYWORDS + (BROWSER_DOUBLED_KEYWORD,))
    shorteners = [s for s in SHORTENERS if s != TRAINING_ONLY_SHORTENER]
    return {
        "url_length": t.chars,
        "domain_length": utf16_length(t.domain),
        "path_length": utf16_length(t.path),
        "query_length": utf16_length(t.query),
        "fragment_length": utf16_length(t.fragment),
        "has_port": flag(port >= 0),
        "port_number": port,
        "has_https_in_domain": flag(F.contains(t.domain, F.lit("https"))),
        "has_http_in_domain": flag(F.contains(t.domain, F.lit("http"))),
        "has_url_shortener": flag(contains_any(t.domain, shorteners)),
        "qty_suspicious_keywords": words,
        "has_consecutive_letters": flag(t.url.rlike(TRIPLE_CODE_UNIT)),
        "has_javascript_protocol": flag(t.scheme == "javascript"),
        "has_data_protocol": flag(t.scheme == "data"),
        "has_punycode": flag(F.contains(t.url, F.lit("xn--"))),
        "entropy_url": utf16_entropy(t.url, entropy),
        "entropy_domain": utf16_entropy(t.domain, entropy),
    }


def url_features(
    df: DataFrame,
    url_col: str = "url",
    profile: str = "training",
    features: Sequence[str] = FEATURE_NAMES,
    entropy: str = "arrow",
    tld_col: str | None = None,
) -> DataFrame:
    """Append the feature columns (all 73 by default) to ``df``, and the top-level
    domain as ``tld_col`` if that is given.

    A null or empty address, and in the browser profile also an invalid one,
    gives nulls in every feature. ``entropy="native"`` keeps the whole job off
    Python at a much higher cost per row.
    """
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {PROFILES}, not {profile!r}")
    unknown = set(features) - set(FEATURE_NAMES)
    if unknown:
        raise ValueError(f"unknown features: {sorted(unknown)}")
    browser = profile == "browser"
    entropy_of = {"arrow": arrow_entropy, "native": native_entropy}[entropy]
    given = df.columns
    p = "__url_"
    if browser:
        staged = with_browser_parts(df, url_col, prefix=p)
        text = F.when(F.col(p + "host").isNotNull(), F.col(url_col))
        domain = host = F.col(p + "host")
    else:
        staged = with_url_parts(df, url_col, prefix=p)
        text = F.nullif(F.col(url_col), F.lit(""))
        domain, host = F.col(p + "netloc"), F.col(p + "host")
    staged = staged.withColumns({
        p + "text": text,
        p + "low": F.lower(text),
        p + "low_domain": F.lower(domain),
        p + "marks": F.regexp_replace(text, r"\p{Alnum}+", ""),
        p + "chars": utf16_length(text) if browser else F.length(text),
    })
    text = F.col(p + "text")
    col = {n: F.col(p + n) for n in ("low", "low_domain", "marks", "chars", "scheme", "path", "query", "fragment")}
    texts = _Texts(url=text, domain=domain, host=host, **col)
    formulas = (
        _structure(texts, DOTTED_QUAD_ASCII if browser else DOTTED_QUAD,
                   PRIVATE_OR_LOOPBACK if browser else PRIVATE_ADDRESS)
        | _characters(texts, any_script=not browser)
        | _host(texts, any_script=not browser)
        | _lexical(texts)
    )
    if browser:
        formulas |= _browser_only(texts, F.col(p + "port"), entropy_of)
    else:
        formulas |= _training_only(texts, F.col(p + "params"), entropy_of)
    tld = [top_level_domain(texts.host).alias(tld_col)] if tld_col else []
    return staged.select(*given, *tld, *(formulas[name].alias(name) for name in features))
