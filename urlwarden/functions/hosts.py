"""Host names: extraction, normal form and parent domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlwarden.functions.browser import with_browser_parts


def with_hostname(df: DataFrame, url_col: str = "url", out: str = "hostname", assume_http: bool = False) -> DataFrame:
    """Add the host name a browser would report; null for an invalid address."""
    p = "__host_"
    staged = with_browser_parts(df, url_col, prefix=p, assume_http=assume_http, only=("host",))
    return staged.select(*df.columns, F.col(p + "host").alias(out))


def strip_www(host: Column) -> Column:
    return F.when(F.startswith(host, F.lit("www.")), F.substring(host, F.lit(5), F.length(host))).otherwise(host)


def parent_domains(host: Column) -> Column:
    """Proper suffixes with two labels or more of the www-less host, longest first."""
    labels = F.split(strip_www(host), r"\.")
    count = F.size(labels)
    return F.when(
        count > 2,
        F.transform(
            F.sequence(F.lit(2), count - 1),
            lambda start: F.array_join(F.slice(labels, start, count), "."),
        ),
    ).when(host.isNotNull(), F.array().cast("array<string>"))


def last_labels(host: Column, count: int) -> Column:
    """The last ``count`` labels (the whole host when it has no more)."""
    return F.substring_index(host, ".", -count)
