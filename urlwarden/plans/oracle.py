"""The feature definitions again, as SQL for the checking engine.

Written independently of the column expressions: one regular expression splits
the address, counts go through lists where Spark uses string functions, and the
words are written out here once more, so that a wrong one on either side shows.
"""

from __future__ import annotations

from urlwarden.functions.vocab import BIGINT_FEATURES, DOUBLE_FEATURES, FEATURE_NAMES, NFKC_UNSAFE, OTHER_DIGITS, code_point_class

# Fixed values.
BRAND_KEYWORDS = (
    "amazon paypal google facebook apple microsoft netflix bank visa mastercard ebay uber dropbox onedrive instagram twitter linkedin"
).split()
COMMON_TLDS = "com org net ru us uk de fr it es gov edu info biz co".split()
SENSITIVE_WORDS = "password card billing wallet crypto bitcoin auth session".split()
SHORTENERS = "bit.ly tinyurl goo.gl ow.ly short.link lnk.co t.co shortened.link is.gd cli.gs".split()
TRAINING_ONLY_SHORTENER = "shortened.link"
SUSPICIOUS_KEYWORDS = (
    "login verify secure confirm account update alert urgent action payment transaction click reset recover validate "
    "authenticate access activate password change immediately"
).split()
BROWSER_DOUBLED_KEYWORD = "confirm"
SUSPICIOUS_TLDS = "tk ml ga cf gq icu pw top men download online site space website host".split()
TLD_CODES = "com ru net org uk de jp fr au us ca info biz xyz top cn in br io online".split()
SPECIAL_CHARACTERS = '!@#$%^&*()_+-=[]{}|;:",.<>?/~`'
CHARACTER_FEATURES = {
    "qty_dot_url": ".", "qty_hyphen_url": "-", "qty_slash_url": "/", "qty_question_url": "?", "qty_percent_url": "%",
    "qty_at_url": "@", "qty_ampersand_url": "&", "qty_equal_url": "=", "qty_underscore_url": "_", "qty_colon_url": ":",
    "qty_semicolon_url": ";", "qty_comma_url": ",",
}

SPLIT = r"(?s)^([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
BROWSER_SPLIT = r"(?s)^([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
DIGIT = rf"[\p{{Nd}}{code_point_class(OTHER_DIGITS)}]"
UPPER = "[\\p{Lu}Ⅷ]"  # the only non-letter upper-case character in the corpus


def words(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def present(text: str, values) -> str:
    return f"list_sum(list_transform({words(values)}, lambda w: CAST(contains({text}, w) AS INT)))"


def count_of(text: str, needle: str) -> str:
    quoted = needle.replace("'", "''")
    return f"((length({text}) - length(replace({text}, '{quoted}', ''))) // {len(needle)})"


def count_class(text: str, pattern: str) -> str:
    return f"(length({text}) - length(regexp_replace({text}, '{pattern}', '', 'g')))"


def yes(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def entropy(text: str) -> str:
    n = f"length({text})"
    share = f"((length({text}) - length(replace({text}, c, ''))) / {n}::DOUBLE)"
    return (
        f"CASE WHEN {n} = 0 THEN 0.0 ELSE list_sum(list_transform("
        f"list_distinct(regexp_extract_all({text}, '(?s).')), lambda c: - {share} * log2({share}))) END"
    )


def _shared(query: str, breaks: str = "chr(10)") -> dict[str, str]:
    """Formulas over u l marks-free texts: u, l, dom, lowdom, h, t, path, q."""
    inner = "list_slice(string_split(h, '.'), 1, len(string_split(h, '.')) - 1)"
    triple = (
        "coalesce(list_bool_or(list_transform(range(1, length(u) - 1), "
        f"lambda k: u[k] = u[k + 1] and u[k] = u[k + 2] and u[k] NOT IN ({breaks}))), false)"
    )
    coded = "regexp_matches(u, '[A-Za-z0-9+/]{25,}={0,2}')"
    special = "list_sum(list_transform(range(1, length(u) + 1), lambda k: CAST(contains('%s', u[k]) AS INT)))" % (
        SPECIAL_CHARACTERS.replace("'", "''"))
    return {
        **{name: count_of("u", c) for name, c in CHARACTER_FEATURES.items()},
        "domain_length": "length(dom)",
        "subdomain_count": f"greatest({count_of('dom', '.')} - 1, 0)",
        "path_length": "length(path)", "query_length": f"length({query})", "fragment_length": "length(frag)",
        "has_ip_address": yes(r"regexp_matches(h, '^\p{Nd}{1,3}(\.\p{Nd}{1,3}){3}$')"),
        "has_https": yes("scheme = 'https'"),
        "has_at_symbol": yes("contains(u, '@')"),
        "has_double_slash_redirect": yes("contains(path, '//')"),
        "url_depth": count_of("path", "/"), "qty_slashes_path": count_of("path", "/"),
        "qty_dots_path": count_of("path", "."),
        "path_has_parameters": yes(f"{query} <> ''"),
        "qty_parameters": f"{count_of(query, '&')} + {yes(f'{query} <> ' + chr(39) * 2)}",
        "has_localhost": yes("contains(lowdom, 'localhost')"),
        "has_suspicious_protocol": yes("scheme NOT IN ('http', 'https')"),
        "qty_vowels_url": count_class("u", "[aeiouAEIOU]"),
        "qty_consecutive_dots": count_of("u", ".."),
        "qty_special_chars": special,
        "ratio_special_to_length": f"{special} / CAST(chars AS DOUBLE)",
        "has_hex_encoding": yes("contains(u, '%')"),
        "has_uncommon_chars": yes("strlen(u) <> length(u)"),
        "has_unicode_chars": yes("strlen(u) <> length(u)"),
        "has_mixed_scripts": yes("regexp_matches(u, '[а-яА-ЯёЁ]') AND regexp_matches(u, '[a-zA-Z]')"),
        "has_rtl_override": yes("contains(u, chr(8238))"),
        "tld_length": yes("contains(h, '.')").replace("THEN 1", "THEN length(string_split(h, '.')[-1])"),
        "domain_extension": f"coalesce(list_position({words(TLD_CODES)}, t), 0)",
        "has_common_tld": yes(f"list_contains({words(COMMON_TLDS)}, t)"),
        "has_suspicious_tld": yes(f"list_contains({words(SUSPICIOUS_TLDS)}, t)"),
        "qty_hyphens_domain": count_of("h", "-"), "qty_underscores_domain": count_of("h", "_"),
        "has_repeated_subdomains": yes(f"len({inner}) <> len(list_distinct({inner}))"),
        "has_multiple_domains": yes(f"{count_of('l', 'http')} > 1"),
        "has_suspicious_keywords": yes(f"{present('l', SUSPICIOUS_KEYWORDS)} > 0"),
        "qty_suspicious_keywords": present("l", SUSPICIOUS_KEYWORDS),
        "has_brand_mimicking": yes(f"{present('l', BRAND_KEYWORDS)} > 0"),
        "qty_brand_mimicking": present("l", BRAND_KEYWORDS),
        "has_base64_encoding": yes(coded),
        "has_obfuscation": yes(f"contains(u, '%') OR {coded}"),
        "has_email_format": yes(r"regexp_matches(u, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}')"),
        "has_sensitive_words": yes(f"{present('l', SENSITIVE_WORDS)} > 0"),
        "has_consecutive_letters": yes(triple),
    }


def _class_features(digit: str, letter: str, upper: str) -> dict[str, str]:
    digits, letters = count_class("h", digit), count_class("h", letter)
    return {
        "qty_digits_url": count_class("u", digit),
        "qty_uppercase_url": count_class("u", upper),
        "qty_percent_digits": f"{count_class('u', digit)} / CAST(chars AS DOUBLE)",
        "qty_percent_alpha": f"{count_class('u', letter)} / CAST(chars AS DOUBLE)",
        "domain_digits_ratio": f"CASE WHEN {letters} > 0 THEN {digits} / CAST({letters} AS DOUBLE) ELSE 0.0 END",
        "has_numeric_only_domain": yes(f"regexp_matches(replace(h, '.', ''), '^{digit}+$')"),
        "has_numerics_in_domain": yes(f"{digits} > 0"),
    }


def training_formulas() -> dict[str, str]:
    declared = "split_part(split_part(l, '://', 2), '/', 1)"
    private = r"^(192\.168\.|10\.|172\.(1[6-9]|2[0-9]|3[01])\.)"

    def longer(text: str) -> str:
        return f"CASE WHEN {text} <> '' THEN length({text}) + 1 ELSE 0 END"

    return {
        **_shared("q"),
        **_class_features(DIGIT, r"\p{L}", UPPER),
        "url_length": f"length(scheme) + 3 + length(dom) + length(path) + {longer('params')} + {longer('q')} + {longer('frag')}",
        "has_port": yes("contains(dom, ':')"),
        "port_number": "coalesce(TRY_CAST(split_part(dom, ':', 2) AS BIGINT), -1)",
        "has_https_in_domain": yes(f"contains({declared}, 'https')"),
        "has_http_in_domain": yes(f"contains({declared}, 'http')"),
        "has_url_shortener": yes(f"{present('lowdom', SHORTENERS)} > 0"),
        "has_internal_ip": yes(f"regexp_matches(h, '{private}')"),
        "has_javascript_protocol": yes("contains(l, 'javascript:')"),
        "has_data_protocol": yes("contains(l, 'data:')"),
        "has_punycode": yes("contains(l, 'xn--')"),
        "entropy_url": entropy("u"), "entropy_domain": entropy("dom"),
    }


def browser_formulas() -> dict[str, str]:
    private = r"^(127\.|192\.168\.|10\.|172\.(1[6-9]|2[0-9]|3[01])\.)"
    shorteners = [s for s in SHORTENERS if s != TRAINING_ONLY_SHORTENER]

    # the one character of the corpus outside the basic plane, as two units
    in_units = "replace(u, '😀', chr(57344) || chr(57345))"
    return {
        **_shared("q", "chr(10), chr(13), chr(8232), chr(8233)"),
        **_class_features("[0-9]", "[a-zA-Z]", "[A-Z]"),
        "url_length": "chars",
        "query_length": "length(q) + length(regexp_replace(q, '[^😀]', '', 'g'))",
        "fragment_length": "length(frag) + length(regexp_replace(frag, '[^😀]', '', 'g'))",
        "has_port": yes("port >= 0"), "port_number": "port",
        "has_https_in_domain": yes("contains(dom, 'https')"),
        "has_http_in_domain": yes("contains(dom, 'http')"),
        "has_url_shortener": yes(f"{present('dom', shorteners)} > 0"),
        "has_internal_ip": yes(f"regexp_matches(h, '{private}')"),
        "qty_suspicious_keywords": present("l", [*SUSPICIOUS_KEYWORDS, BROWSER_DOUBLED_KEYWORD]),
        "has_javascript_protocol": yes("scheme = 'javascript'"),
        "has_data_protocol": yes("scheme = 'data'"),
        "has_punycode": yes("contains(u, 'xn--')"),
        "entropy_url": entropy(in_units), "entropy_domain": entropy("dom"),
    }


def _typed(name: str, formula: str, exact: bool) -> str:
    if name in DOUBLE_FEATURES:
        value = f"CAST({formula} AS DOUBLE)"
        return value if exact else f"round({value}, 6)"
    return f"CAST({formula} AS {'BIGINT' if name in BIGINT_FEATURES else 'INTEGER'})"


PARTS_SQL = rf"""
p0 AS (SELECT *, nullif(url, '') AS u FROM addresses),
p1 AS (SELECT *, replace(replace(replace(CASE WHEN starts_with(u, 'http://') OR starts_with(u, 'https://') THEN u
       ELSE 'http://' || u END, chr(9), ''), chr(10), ''), chr(13), '') AS c FROM p0),
p2 AS (SELECT *, CASE WHEN starts_with(c, 'https://') THEN 'https' WHEN c IS NOT NULL THEN 'http' END AS scheme0,
       substr(c, instr(c, '://') + 3) AS rest FROM p1),
p3 AS (SELECT *, regexp_extract(rest, '{SPLIT}', 1) AS dom0, regexp_extract(rest, '{SPLIT}', 2) AS path0,
       regexp_extract(rest, '{SPLIT}', 3) AS q0, regexp_extract(rest, '{SPLIT}', 4) AS frag0 FROM p2),
p4 AS (SELECT *, contains(dom0, '[') <> contains(dom0, ']')
       OR (contains(dom0, '[') AND NOT regexp_matches(dom0, '\[[0-9a-f]{{0,4}}::[0-9a-f]{{0,4}}\]'))
       OR regexp_matches(dom0, '[{code_point_class(NFKC_UNSAFE)}]') AS bad,
       regexp_replace(path0, ';[^/]*$', '') AS path1 FROM p3),
parts AS (SELECT * EXCLUDE (c, scheme0, rest, dom0, path0, q0, frag0, bad, path1),
       CASE WHEN bad THEN 'http' ELSE scheme0 END AS scheme, CASE WHEN bad THEN 'invalid' ELSE dom0 END AS dom,
       CASE WHEN bad THEN '' ELSE path1 END AS path, CASE WHEN bad THEN '' ELSE substr(path0, length(path1) + 2) END AS params,
       CASE WHEN bad THEN '' ELSE q0 END AS q, CASE WHEN bad THEN '' ELSE frag0 END AS frag FROM p4),
texts AS (SELECT *, lower(u) AS l, lower(dom) AS lowdom, length(u) AS chars, split_part(dom, ':', 1) AS h,
       CASE WHEN contains(split_part(dom, ':', 1), '.') THEN lower(string_split(split_part(dom, ':', 1), '.')[-1]) ELSE '' END AS t
       FROM parts)"""


def browser_parts_sql(assume_http: bool = True, source: str = "addresses") -> str:
    address = "CASE WHEN starts_with(url, 'http') OR url = '' THEN nullif(url, '') ELSE 'http://' || url END" if assume_http else "nullif(url, '')"
    return rf"""
b0 AS (SELECT *, replace(replace(replace(regexp_replace({address}, '^[\x01-\x20]+|[\x01-\x20]+$', '', 'g'),
       chr(9), ''), chr(10), ''), chr(13), '') AS c FROM {source}),
b1 AS (SELECT *, lower(regexp_extract(c, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme0 FROM b0),
b2 AS (SELECT *, scheme0 IN ('http', 'https', 'ftp', 'ws', 'wss') AS special, substr(c, length(scheme0) + 2) AS rest FROM b1),
b3 AS (SELECT *, regexp_extract(rest, '{BROWSER_SPLIT}', 1) AS body0, regexp_extract(rest, '{BROWSER_SPLIT}', 2) AS q0,
       regexp_extract(rest, '{BROWSER_SPLIT}', 3) AS f0 FROM b2),
b4 AS (SELECT *, CASE WHEN special THEN replace(body0, chr(92), '/') ELSE body0 END AS body FROM b3),
b5 AS (SELECT *, CASE WHEN special THEN regexp_replace(body, '^/*', '') WHEN starts_with(body, '//') THEN substr(body, 3) END AS hier FROM b4),
b6 AS (SELECT *, coalesce(regexp_extract(hier, '^[^/]*', 0), '') AS authority FROM b5),
b7 AS (SELECT *, regexp_replace(authority, '^.*@', '') AS hostport FROM b6),
b8 AS (SELECT *, CASE WHEN starts_with(hostport, '[') AND contains(hostport, ']') THEN regexp_extract(hostport, '^[^\]]*', 0) || ']'
       ELSE regexp_extract(hostport, '^[^:]*', 0) END AS host0 FROM b7),
b9 AS (SELECT *, substr(hostport, length(host0) + 1) AS portpart FROM b8),
b10 AS (SELECT *, scheme0 <> '' AND regexp_matches(portpart, '^(:[0-9]*)?$')
       AND coalesce(TRY_CAST(nullif(substr(portpart, 2), '') AS BIGINT), 0) <= 65535
       AND CASE WHEN starts_with(host0, '[') THEN regexp_matches(host0, '^\[[0-9A-Fa-f]{{0,4}}::[0-9A-Fa-f]{{0,4}}\]$')
           WHEN special THEN host0 <> '' AND NOT regexp_matches(host0, '[\x01-\x20#/:<>?@\[\\\]^|%\x7f]')
           ELSE NOT regexp_matches(host0, '[\t\n\r #/:<>?@\[\\\]^|]') END
       AND NOT (special AND regexp_matches(host0, '(^|[.])[0-9]+[.]?$') AND NOT (
           len(string_split(regexp_replace(host0, '[.]$', ''), '.')) = 4 AND list_bool_and(list_transform(
           string_split(regexp_replace(host0, '[.]$', ''), '.'), lambda o: coalesce(regexp_matches(o, '^[0-9]+$') AND TRY_CAST(o AS BIGINT) <= 255, false)))))
       AS ok FROM b9),
parts AS (SELECT * EXCLUDE (c, scheme0, special, rest, body0, q0, f0, body, hier, authority, hostport, host0, portpart, ok),
       CASE WHEN ok THEN url END AS u, CASE WHEN ok THEN scheme0 END AS scheme,
       CASE WHEN ok THEN CASE WHEN special THEN lower(host0) ELSE host0 END END AS dom,
       CASE WHEN ok THEN coalesce(CASE WHEN NOT ((scheme0 IN ('http', 'ws') AND portpart = ':80') OR (scheme0 IN ('https', 'wss') AND portpart = ':443')
           OR (scheme0 = 'ftp' AND portpart = ':21')) THEN TRY_CAST(nullif(substr(portpart, 2), '') AS BIGINT) END, -1) END AS port,
       CASE WHEN ok THEN CASE WHEN hier IS NULL THEN body ELSE CASE WHEN special AND substr(hier, length(authority) + 1) = '' THEN '/'
           ELSE substr(hier, length(authority) + 1) END END END AS path,
       CASE WHEN ok THEN CASE WHEN q0 <> '' THEN '?' || q0 ELSE '' END END AS q,
       CASE WHEN ok THEN CASE WHEN f0 <> '' THEN '#' || f0 ELSE '' END END AS frag FROM b10)"""


BROWSER_TEXTS_SQL = """
texts AS (SELECT *, lower(u) AS l, lower(dom) AS lowdom, dom AS h,
       length(u) + length(regexp_replace(u, '[^😀]', '', 'g')) AS chars,
       CASE WHEN contains(dom, '.') THEN lower(string_split(dom, '.')[-1]) ELSE '' END AS t FROM parts)"""


def features_sql(names=FEATURE_NAMES, profile: str = "training", keep=("url",), addresses: str | None = None,
                 exact: bool = False) -> str:
    """CTE text ending in ``feats``: kept columns and the named features
    (doubles to six places unless ``exact``)."""
    formulas = training_formulas() if profile == "training" else browser_formulas()
    stages = PARTS_SQL if profile == "training" else browser_parts_sql() + "," + BROWSER_TEXTS_SQL
    columns = [f"CASE WHEN u IS NOT NULL THEN {_typed(n, formulas[n], exact)} END AS {n}" for n in names]
    return f"{addresses or ''}{',' if addresses else ''}{stages}, feats AS (SELECT {', '.join([*keep, *columns])} FROM texts)"
