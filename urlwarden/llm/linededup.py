"""Removal of lines that many sites share.

A HyperLogLog sketch of the sites of each line hash is merged by aggregation, so
a line that every site has costs a task one row. Lines whose estimate is near the
threshold get an exact distinct count. A line that reaches it stays where it
comes first and goes everywhere else. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlwarden.llm.common import document_key, settle

MIN_SITES = 5
SKETCH_BITS = 10  # 1,024 registers: a standard error of about 3 %
BAND = 0.25  # estimates this near to the threshold, or within two sites of it, are counted exactly
EDGES = " \t\r"  # ignored at both ends of a line when lines are compared


def line_rows(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """``h1, h2, site, at`` of every line that isn't blank; ``at`` is its place, ordered by id."""
    # The keys first: what stands beside a generator is worked out for every line.
    keyed = docs.select(
        F.col(id_col).alias("id"), F.col(site_col).alias("site"), *document_key(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    split = keyed.select("id", "site", "k1", "k2", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    line = F.trim("line", F.lit(EDGES))
    return split.where(line != "").select(
        F.xxhash64(line).alias("h1"), F.hash(line).alias("h2"), "site", F.struct("id", "k1", "k2", "pos").alias("at"))


def shared_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """``h1, h2, first, sites``: lines at or near the threshold by their sketch."""
    sketches = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg(F.col("site").cast("string"), F.lit(SKETCH_BITS))).alias("sites"), F.min("at").alias("first"))
    return sketches.where(F.col("sites") >= min(min_sites - 2, min_sites * (1 - BAND)))


def removals(lines: DataFrame, min_sites: int) -> DataFrame:
    """``h1, h2, k1, k2, pos`` of lines to remove."""
    # Both sides of this join are shuffled by it, so that Spark may split a hot line.
    hits = settle(lines.join(settle(shared_lines(lines, min_sites)), ["h1", "h2"]))
    sure = F.col("sites") >= max(min_sites + 2, min_sites * (1 + BAND))
    counted = hits.where(~sure).select("h1", "h2", "site").distinct().groupBy("h1", "h2").agg(F.count("site").alias("exact"))
    counted = settle(counted.where(F.col("exact") >= min_sites).select("h1", "h2"))
    later = hits.where(F.col("at") != F.col("first"))
    chosen = later.where(sure).select("at").union(later.where(~sure).join(counted, ["h1", "h2"]).select("at"))
    return chosen.select("at.k1", "at.k2", "at.pos")


def without_shared_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES,
) -> DataFrame:
    """All rows and columns of ``docs``, the text without lines that ``min_sites`` sites have.

    Lines are compared without blanks, tabs and carriage returns at their ends;
    blank lines always stay. The first place, by id, keeps its line. A null site
    counts for none. A null text stays null; one of which every line goes becomes
    empty. Rows with equal ids and texts get equal results. Null ids come before
    others. Adds ``n_lines, n_removed``; existing columns of these names are replaced.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    gone = removals(line_rows(docs, id_col, text_col, site_col), min_sites)
    # Stored, so that both sides of the join are shuffled by it and Spark may split rows of one key, such as those without a text.
    gone = settle(gone.groupBy("k1", "k2").agg(F.collect_set("pos").alias("gone"))).hint("merge")
    packed = docs.select(F.struct(*columns).alias("doc"), *document_key(id_col, text_col))
    joined = packed.join(gone, ["k1", "k2"], "left")

    def rest(lines: Column) -> Column:
        """The lines that stay. ``lines`` is bound once: a text is split once, however many lines it has."""
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
        return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")

    lines = F.split(joined.doc[text_col].cast("string"), "\n", -1)
    text = F.when(F.col("gone").isNull(), F.col("doc")[text_col]).otherwise(F.get(F.transform(F.array(lines), rest), F.lit(0)))
    return joined.select(
        *(text.alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in columns),
        F.when(F.col("doc")[text_col].isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"))


SQL = f"""
WITH parts AS (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, source, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM parts),
marked AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS k FROM lines),
shared AS (SELECT k, arg_min(doc_id, (doc_id, pos)) AS d, arg_min(pos, (doc_id, pos)) AS p FROM marked
  WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= {MIN_SITES}),
judged AS (SELECT m.*, s.k IS NOT NULL AND NOT (m.doc_id = s.d AND m.pos = s.p) AS gone FROM marked m LEFT JOIN shared s ON m.k = s.k)
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
FROM judged GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL"""
