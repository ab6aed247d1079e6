"""Feature names, word lists, lookup tables and code points.

Every value below must stay exactly as it is for results to be comparable.
"""

from __future__ import annotations

# The 73 feature columns, in contract order.
FEATURE_NAMES: tuple[str, ...] = (
    "url_length", "domain_length", "subdomain_count", "path_length",
    "query_length", "fragment_length", "has_ip_address", "has_port",
    "port_number", "has_https", "has_https_in_domain", "has_http_in_domain",
    "has_url_shortener", "has_at_symbol", "has_double_slash_redirect",
    "url_depth",
    "qty_dot_url", "qty_hyphen_url", "qty_slash_url", "qty_question_url",
    "qty_percent_url", "qty_at_url", "qty_ampersand_url", "qty_equal_url",
    "qty_underscore_url", "qty_colon_url", "qty_semicolon_url",
    "qty_comma_url", "qty_vowels_url", "qty_digits_url", "qty_uppercase_url",
    "entropy_url", "entropy_domain", "qty_consecutive_dots",
    "tld_length", "domain_extension", "has_common_tld", "has_suspicious_tld",
    "qty_hyphens_domain", "qty_underscores_domain", "has_multiple_domains",
    "domain_digits_ratio",
    "has_suspicious_keywords", "qty_suspicious_keywords",
    "has_brand_mimicking", "qty_brand_mimicking", "has_numeric_only_domain",
    "has_consecutive_letters", "has_numerics_in_domain",
    "has_repeated_subdomains", "qty_slashes_path", "qty_dots_path",
    "path_has_parameters", "qty_parameters", "has_base64_encoding",
    "has_hex_encoding", "has_obfuscation",
    "has_localhost", "has_internal_ip", "has_suspicious_protocol",
    "has_javascript_protocol", "has_data_protocol",
    "has_email_format", "qty_special_chars", "ratio_special_to_length",
    "has_uncommon_chars", "has_punycode", "has_unicode_chars",
    "has_mixed_scripts", "has_rtl_override",
    "qty_percent_digits", "qty_percent_alpha", "has_sensitive_words",
)

# Feature columns that are not INT.
BIGINT_FEATURES = frozenset({"port_number"})
DOUBLE_FEATURES = frozenset({
    "entropy_url", "entropy_domain", "domain_digits_ratio",
    "ratio_special_to_length", "qty_percent_digits", "qty_percent_alpha",
})

# 21 distinct lure words.
SUSPICIOUS_KEYWORDS = (
    "login", "verify", "secure", "confirm", "account", "update", "alert",
    "urgent", "action", "payment", "transaction", "click", "reset", "recover",
    "validate", "authenticate", "access", "activate", "password", "change",
    "immediately",
)
# Fixed value: the browser list holds this word twice, so it counts twice there.
BROWSER_DOUBLED_KEYWORD = "confirm"

# 17 brand words.
BRAND_KEYWORDS = (
    "amazon", "paypal", "google", "facebook", "apple", "microsoft", "netflix",
    "bank", "visa", "mastercard", "ebay", "uber", "dropbox", "onedrive",
    "instagram", "twitter", "linkedin",
)

# 8 sensitive words.
SENSITIVE_WORDS = (
    "password", "card", "billing", "wallet", "crypto", "bitcoin", "auth",
    "session",
)

# Top-level domain sets.
SUSPICIOUS_TLDS = (
    "tk", "ml", "ga", "cf", "gq", "icu", "pw", "top", "men", "download",
    "online", "site", "space", "website", "host",
)
COMMON_TLDS = (
    "com", "org", "net", "ru", "us", "uk", "de", "fr", "it", "es", "gov",
    "edu", "info", "biz", "co",
)

# Top-level domain codes 1..20, in code order.
TLD_CODES = (
    "com", "ru", "net", "org", "uk", "de", "jp", "fr", "au", "us",
    "ca", "info", "biz", "xyz", "top", "cn", "in", "br", "io", "online",
)

# Address shorteners, matched as substrings.
SHORTENERS = (
    "bit.ly", "tinyurl", "goo.gl", "ow.ly", "short.link", "lnk.co", "t.co",
    "shortened.link", "is.gd", "cli.gs",
)
# Fixed value: this one is not in the browser list.
TRAINING_ONLY_SHORTENER = "shortened.link"

# Fixed value: the 30 special characters.
SPECIAL_CHARACTERS = "!@#$%^&*()_+-=[]{}|;:\",.<>?/~`"

# Label words that mean phishing (compared in lower case).
PHISHING_LABELS = ("phishing", "1", "bad", "malicious")

# Column aliases of the two kinds of labelled sources.
PRIMARY_URL_ALIASES = ("url", "URL", "text", "TEXT", "link")
PRIMARY_LABEL_ALIASES = ("label", "Label", "LABEL", "is_phishing")
SECONDARY_URL_ALIASES = ("url",)
SECONDARY_LABEL_ALIASES = ("label", "status", "class", "target")

# File names that win over everything else, best first.
PREFERRED_FILES = ("combined_reduced.json", "combined_full.json", "urls.json")

# CSV cells that a data-frame reader takes as missing.
CSV_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Digits outside the decimal-number category that still count as
# digits (superscripts, circled digits and the like).
OTHER_DIGITS = (
    "U+00B2-00B3 U+00B9 U+1369-1371 U+19DA U+2070 U+2074-2079 U+2080-2089 "
    "U+2460-2468 U+2474-247C U+2488-2490 U+24EA U+24F5-24FD U+24FF "
    "U+2776-277E U+2780-2788 U+278A-2792 U+10A40-10A43 U+10E60-10E68 "
    "U+11052-1105A U+1F100-1F10A"
)

# Code points whose compatibility form holds one of / ? # @ :
NFKC_UNSAFE = (
    "U+2047-2049 U+2100 U+2101 U+2105 U+2106 U+2A74 U+FE13 U+FE16 U+FE55 "
    "U+FE56 U+FE5F U+FE6B U+FF03 U+FF0F U+FF1A U+FF1F U+FF20"
)


def code_point_class(ranges: str) -> str:
    """Body of a regex character class for a ``U+XXXX-YYYY`` range list."""
    spans = [part.removeprefix("U+").split("-") for part in ranges.split()]
    return "".join("-".join(rf"\x{{{end}}}" for end in span) for span in spans)
