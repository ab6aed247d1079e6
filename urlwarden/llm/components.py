"""Connected components by alternating large and small stars.

Every round replaces the links by stars around smaller nodes; the rounds grow
with the logarithm of the longest chain. Links live in the shared folder; the
driver sees a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlwarden.llm.common import settle


def both_ways(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def star(sides: DataFrame, keep_own: bool) -> DataFrame:
    """Link what stands beside ``a`` to the smallest of them. The minima are
    written first: a join of two stored tables lets Spark split a hot ``a``."""
    least = settle(sides.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")))
    joined = sides.join(least, "a")
    links = joined.where("b > a") if not keep_own else joined.where("b <> m")
    out = links.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if keep_own:
        out = out.union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def state_of(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """``a, b`` (undirected, no nulls) to ``node, component``: the smallest node of
    each. Nodes without a link to another node don't appear."""
    links = settle(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before, now = None, state_of(links)
    while now != before and now[0]:
        links = settle(star(both_ways(links), keep_own=False))
        downward = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        links = settle(star(downward, keep_own=True))
        before, now = now, state_of(links)
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
