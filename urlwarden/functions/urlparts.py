"""Address parsing as staged columns (training profile).

``parse_url`` is not used: it fails on spaces and bad escapes, and drops user
info and port. Each stage is a separate projection because its inputs are used
several times; Spark keeps such projections apart but runs them in one
generated loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlwarden.functions.text import is_ascii, sealed
from urlwarden.functions.vocab import NFKC_UNSAFE, code_point_class

PART_NAMES = ("scheme", "netloc", "path", "params", "query", "fragment", "host")


def _ipv6_pattern() -> str:
    group = r"[0-9A-Fa-f]{1,4}"
    octet = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    quad = rf"{octet}(?:\.{octet}){{3}}"
    forms = [rf"(?:{group}:){{7}}{group}", rf"(?:{group}:){{6}}{quad}"]
    # "::" stands for at least one group: `left` groups before it, up to
    # `right` after it, where a dotted quad takes the place of two groups.
    for left in range(8):
        head = rf"{group}(?::{group}){{{left - 1}}}::" if left else "::"
        right = 7 - left
        tails = [""]
        if right >= 1:
            tails.append(rf"{group}(?::{group}){{0,{right - 1}}}")
        if right >= 2:
            tails.append(rf"(?:{group}:){{0,{right - 2}}}{quad}")
        forms.append(head + "(?:" + "|".join(tails) + ")")
    return "(?:" + "|".join(forms) + ")"


IPV6 = _ipv6_pattern()
BRACKETED_HOST = rf"(?s)\A(?:{IPV6}(?:%[^%]+)?|v[0-9a-fA-F]+\..+)\z"
UNSAFE_NETLOC = f"[{code_point_class(NFKC_UNSAFE)}]"


def with_scheme(url: Column) -> Column:
    has_scheme = F.startswith(url, F.lit("http://")) | F.startswith(url, F.lit("https://"))
    return F.when(has_scheme, url).otherwise(F.concat(F.lit("http://"), url))


def without_line_breaks(text: Column) -> Column:
    for character in "\t\r\n":
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def after(text: Column, prefix: Column, separator_length: int = 0) -> Column:
    """What follows ``prefix`` (known to start ``text``) and a separator."""
    return F.substring(text, F.length(prefix) + F.lit(1 + separator_length), F.length(text))


def _netloc_rejected(netloc: Column) -> Column:
    opened, closed = F.contains(netloc, F.lit("[")), F.contains(netloc, F.lit("]"))
    after_open = F.substring(netloc, F.locate("[", netloc) + F.lit(1), F.length(netloc))
    inside = F.substring_index(after_open, "]", 1)
    return (
        (opened != closed)
        | (opened & closed & ~inside.rlike(BRACKETED_HOST))
        | (~is_ascii(netloc) & netloc.rlike(UNSAFE_NETLOC))
    )


def with_url_parts(df: DataFrame, url_col: str = "url", prefix: str = "") -> DataFrame:
    """Add ``scheme netloc path params query fragment host`` columns.

    A rejected address parses as ``http://invalid``; a null or empty one gives
    nulls.
    """
    def tmp(name: str) -> str:
        return f"__{prefix}{name}"

    kept = [F.col(f"`{name}`") for name in df.columns]
    url = F.nullif(F.col(url_col), F.lit(""))
    df = df.select(*kept, without_line_breaks(with_scheme(url)).alias(tmp("full")))
    full = F.col(tmp("full"))
    secure = F.startswith(full, F.lit("https://"))
    rest = F.substring(full, F.when(secure, 9).otherwise(8), F.length(full))
    df = df.select(*kept, secure.alias(tmp("secure")), rest.alias(tmp("rest")))
    secure, rest = F.col(tmp("secure")), F.col(tmp("rest"))
    nofrag = F.substring_index(rest, "#", 1)
    noquery = F.substring_index(nofrag, "?", 1)
    df = df.select(
        *kept, secure, noquery.alias(tmp("noquery")),
        after(nofrag, noquery, 1).alias(tmp("query")), after(rest, nofrag, 1).alias(tmp("fragment")),
    )
    noquery = F.col(tmp("noquery"))
    netloc = F.substring_index(noquery, "/", 1)
    longpath = after(noquery, netloc)
    df = df.select(
        *kept, secure, F.col(tmp("query")), F.col(tmp("fragment")),
        netloc.alias(tmp("netloc")), longpath.alias(tmp("longpath")),
        F.substring_index(longpath, "/", -1).alias(tmp("last")),
    )
    # What several parts need is worked out once, as a generator shares nothing.
    df = df.select(
        "*", F.substring_index(F.col(tmp("last")), ";", 1).alias(tmp("lastcut")), _netloc_rejected(F.col(tmp("netloc"))).alias(tmp("bad")),
    )
    netloc, longpath, last, lastcut, bad = (F.col(tmp(name)) for name in ("netloc", "longpath", "last", "lastcut", "bad"))

    def unless_bad(value: Column, fallback: str) -> Column:
        return F.when(bad, F.lit(fallback)).otherwise(value)

    scheme = F.when(secure, "https").when(netloc.isNotNull(), "http")
    path = F.substring(longpath, F.lit(1), F.length(longpath) - F.length(last) + F.length(lastcut))
    return sealed(df, kept, {
        f"{prefix}scheme": unless_bad(scheme, "http"),
        f"{prefix}netloc": unless_bad(netloc, "invalid"),
        f"{prefix}path": unless_bad(path, ""),
        f"{prefix}params": unless_bad(after(last, lastcut, 1), ""),
        f"{prefix}query": unless_bad(F.col(tmp("query")), ""),
        f"{prefix}fragment": unless_bad(F.col(tmp("fragment")), ""),
        f"{prefix}host": unless_bad(F.substring_index(netloc, ":", 1), "invalid"),
    })


def top_level_domain(host: Column) -> Column:
    """The last label in lower case; empty when there is only one label."""
    return F.when(
        F.contains(host, F.lit(".")), F.lower(F.substring_index(host, ".", -1))
    ).when(host.isNotNull(), "")
