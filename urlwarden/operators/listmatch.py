"""Matching host names against the user list, the safe list and the block list.

The three lists become one lookup table ``domain, mask``. While it is known to
be small it is broadcast once and probed a fixed number of times per row: by
host, by www-less host, and by the last k labels for every label count k that
occurs in the safe list. That covers all parent domains without exploding
rows and without moving them. A bigger table takes the shuffled way: distinct
hosts, joined with it, and the few hits joined back. A Bloom filter of the table,
measured before it is broadcast, goes first: hosts without a name that may be listed
are not joined with it. The hits, one row per listed host, are stored and measured. While
they are small, they are broadcast and no row moves; else the filter keeps rows that
can't be listed from the shuffle, and both sides are shuffled by the join itself, so
that Spark can split a hot host's rows among tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlwarden.functions.hosts import last_labels, parent_domains, strip_www
from urlwarden.operators.prefilter import Prefilter, build, maybe_any
from urlwarden.session import checkpoint_dir, may_travel, stored

IN_WHITELIST, IN_SAFE, IN_BLACKLIST = 1, 2, 4
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 256 << 20
MAX_SUFFIX_PROBES = 8
LABEL_COUNT_CEILING = 200


@dataclass(frozen=True)
class DomainLists:
    table: DataFrame                   # domain, mask
    small: bool                        # measured to fit a broadcast
    suffix_lengths: tuple[int, ...]    # label counts (2 or more) in the safe list
    prefilter: Prefilter | None = None  # of a table that is not small


def domain_table(whitelist: DataFrame, safe: DataFrame, blacklist: DataFrame) -> DataFrame:
    def marked(df: DataFrame, mask: int) -> DataFrame:
        return df.select(F.col("domain"), F.lit(mask).alias("mask"))

    union = marked(whitelist, IN_WHITELIST).unionByName(marked(safe, IN_SAFE)).unionByName(marked(blacklist, IN_BLACKLIST))
    return union.where(F.col("domain").isNotNull()).groupBy("domain").agg(F.bit_or("mask").alias("mask"))


def prepare_lists(
    whitelist: DataFrame, safe: DataFrame, blacklist: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES,
) -> DomainLists:
    """Combine the lists, store the table, and measure what is stored with one
    aggregate: the table that was measured is the one that is used."""
    checkpoint_dir(whitelist.sparkSession)
    table = domain_table(whitelist, safe, blacklist).checkpoint()
    labels = F.least(F.size(F.split("domain", r"\.")), F.lit(LABEL_COUNT_CEILING))
    in_safe = F.col("mask").bitwiseAND(IN_SAFE) > 0
    stats = table.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.octet_length("domain") + 16), F.lit(0)).alias("bytes"),
        F.collect_set(F.when(in_safe & (labels >= 2), labels)).alias("lengths"),
    ).first()
    lengths = tuple(sorted(stats["lengths"]))
    probes_cover = len(lengths) <= MAX_SUFFIX_PROBES and LABEL_COUNT_CEILING not in lengths
    small = stats["rows"] <= max_rows and stats["bytes"] <= max_bytes and probes_cover
    return DomainLists(table, small, lengths, None if small else build(table, "domain", stats["rows"]))


def _bit(mask: Column, bit: int) -> Column:
    return F.coalesce(mask.bitwiseAND(bit), F.lit(0)) > 0


def _probe_masks(df: DataFrame, lists: DomainLists, host: str) -> tuple[DataFrame, Column, Column]:
    plain = strip_www(F.col(host))
    keys = [F.col(host), plain] + [last_labels(plain, k) for k in lists.suffix_lengths]
    for i, key in enumerate(keys):
        side = lists.table.select(F.col("domain").alias(f"__d{i}"), F.col("mask").alias(f"__m{i}"))
        df = df.join(F.broadcast(side), key == F.col(f"__d{i}"), "left").drop(f"__d{i}")
    masks = [F.coalesce(F.col(f"__m{i}"), F.lit(0)) for i in range(len(keys))]
    exact = masks[0].bitwiseOR(masks[1])
    anywhere = reduce(lambda a, b: a.bitwiseOR(b), masks)
    return df, exact, anywhere


def _names(host: Column) -> Column:
    """What a host may be listed as: ``domain, exact``."""
    return F.concat(
        F.transform(F.array_distinct(F.array(host, strip_www(host))), lambda d: F.struct(d.alias("domain"), F.lit(True).alias("exact"))),
        F.transform(parent_domains(host), lambda d: F.struct(d.alias("domain"), F.lit(False).alias("exact"))))


def may_be_listed(df: DataFrame, lists: DomainLists, host: str) -> DataFrame:
    """``df`` with ``__maybe``: false only where no name of the host is on a list."""
    if lists.prefilter is None:
        return df.withColumn("__maybe", F.col(host).isNotNull())
    return maybe_any(df, lists.prefilter, F.transform(_names(F.col(host)), lambda n: n["domain"]), "__maybe")


def _hits(hosts: DataFrame, lists: DomainLists, host: str) -> DataFrame:
    """``host, __exact, __any`` of the listed ones among the rows of ``__host``."""
    candidates = hosts.select("__host", F.explode(_names(F.col("__host"))).alias("c")).select("__host", "c.domain", "c.exact")
    return (
        candidates.join(lists.table, "domain")
        .groupBy("__host")
        .agg(
            F.bit_or(F.when(F.col("exact"), F.col("mask")).otherwise(0)).alias("__exact"),
            F.bit_or("mask").alias("__any"),
        )
        .withColumnRenamed("__host", host)
    )


def _shuffled_masks(df: DataFrame, lists: DomainLists, host: str) -> tuple[DataFrame, Column, Column]:
    hosts = df.select(F.col(host).alias("__host")).where(F.col("__host").isNotNull()).distinct()
    masks = F.col("__exact"), F.col("__any")
    if df.isStreaming:
        return df.join(_hits(hosts, lists, host), host, "left").select(*df.columns, *masks), *masks
    hits = stored(_hits(may_be_listed(hosts, lists, "__host").where("__maybe"), lists, host))
    if may_travel(hits):
        return df.join(F.broadcast(hits), host, "left").select(*df.columns, *masks), *masks
    nothing = F.lit(None).cast("int")
    marked = may_be_listed(df, lists, host)
    asked = marked.where("__maybe").join(hits, host, "left").select(*df.columns, *masks)
    rest = marked.where("NOT __maybe").drop("__maybe").withColumns({"__exact": nothing, "__any": nothing})
    return asked.unionByName(rest), *masks


def with_list_flags(df: DataFrame, lists: DomainLists, host: str = "hostname") -> DataFrame:
    """Add ``in_whitelist, in_safe, in_blacklist``. Only the safe list matches
    parent domains; an entry ``www.x.com`` does not match the host ``x.com``."""
    given = df.columns
    joined, exact, anywhere = (_probe_masks if lists.small else _shuffled_masks)(df, lists, host)
    return joined.select(
        *given,
        _bit(exact, IN_WHITELIST).alias("in_whitelist"),
        _bit(anywhere, IN_SAFE).alias("in_safe"),
        _bit(exact, IN_BLACKLIST).alias("in_blacklist"),
    )


def list_filter(domains: DataFrame, text: str = "", column: str = "domain") -> DataFrame:
    """Entries containing ``text`` in lower case; an empty text keeps all."""
    return domains.where(F.contains(F.col(column), F.lit(text.lower())))
