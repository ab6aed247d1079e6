"""The numbered queries of this package, and SQL where SQL can say it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urlwarden.llm import linededup, quality, spotsigs
from urlwarden.llm.common import read
from urlwarden.llm.htmltext import visible_text
from urlwarden.llm.lm import lm_scores
from urlwarden.llm.negatives import hard_negatives
from urlwarden.llm.neighbours import neighbours
from urlwarden.llm.packing import pack
from urlwarden.llm.periodic import periodic_runs
from urlwarden.llm.rangejoin import range_links
from urlwarden.llm.segment import decoded, sample_segmentations
from urlwarden.llm.simhash import near_copies
from urlwarden.llm.warc import archived
from urlwarden.plans.corpora import spread

PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``."""
    return F.crc32(F.col(id_col).cast("string")) % by


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compared(read(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    model = quality.fit(docs, labels.where(remainder("doc_id", 5) != 0))
    return quality.scored(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_copies(read(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


def op5_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = spread(read(spark, sf_dir, "conversations"))
    found = sample_segmentations(talks, PIECE_BPE, ["conv_id", "turn", "text"])
    back = decoded(F.col("ids"), PIECE_BPE).eqNullSafe(F.regexp_replace(F.coalesce("text", F.lit("")), "\u2581", " "))
    return found.select("conv_id", "turn", "sample", "ids", "log_probability", "inclusion", back.alias("round_trip"))


def op5_segmentations_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sample_segmentations(read(spark, sf_dir, "documents"), PIECE_BPE, ["doc_id", "text"])
    back = decoded(F.col("ids"), PIECE_BPE).eqNullSafe(F.regexp_replace(F.coalesce("text", F.lit("")), "\u2581", " "))
    return found.select("doc_id", "sample", "ids", "log_probability", "inclusion", back.alias("round_trip"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(read(spark, sf_dir, "documents"), BYTE_BPE)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "opens", "closes")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visible_text(read(spark, sf_dir, "pages"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = archived(read(spark, sf_dir, "pages"))
    return index.select(
        F.col("page_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_page").cast("bigint").alias("refers_to"), "url_key", "date", "place")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linededup.without_shared_lines(read(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", "text")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False))
    scores = lm_scores(docs, BYTE_BPE, remainder("doc_id", 7) != 2)
    return scores.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_links(read(spark, sf_dir, "embeddings"))


def repeated_tail(doc_id: int | None, words: list[str]) -> list[str]:
    """A tenth of the texts, by their id, end in a stretch repeated over and over."""
    code = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if code % 10 or not words:
        return words
    g, n = code // 10, len(words)
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    return words[:at] + (words[at:at + period] * (-(-(n - at) // period)))[:n - at]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(read(spark, sf_dir, "documents"), change=repeated_tail)
    # The greatest length; of equal ones the smallest start, then period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("early"), (-r["period"]).alias("short"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    told = found.select("doc_id", "runs", "collapsed", "n_words", best.alias("best"), lines.alias("lines"))
    length, period = F.col("best.length"), -F.col("best.short")
    return told.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.early")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"),
        F.sha2(F.encode("lines", "utf-8"), 256).alias("runs_sha256"), F.sha2(F.encode("collapsed", "utf-8"), 256).alias("collapsed_sha256"), "n_words")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


VECTORS_SQL = """SELECT * FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

OP11_SQL = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM ({VECTORS_SQL})
    WHERE len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reached(node, seen) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.seen
), least AS (SELECT node, min(seen) AS component_id FROM reached GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT l.node AS vec_id, coalesce(c.n, 0) AS n_links, l.component_id, l.node = l.component_id AS kept
FROM least l LEFT JOIN counts c ON c.a = l.node
"""

OP13_SQL = f"""
WITH r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM ({VECTORS_SQL}) WHERE label IS NOT NULL
), scored AS (
    SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same, list_inner_product(a.e, o.e)::BIGINT AS score
    FROM r a JOIN r o ON a.vec_id <> o.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), windows AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS rank
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
        AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= 3
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_spotsigs": op1_spotsigs,
    "op2_quality": op2_quality,
    "op3_simhash": op3_simhash,
    "op4_neighbours": op4_neighbours,
    "op5_segmentations": op5_segmentations,
    "op5_segmentations_documents": op5_segmentations_documents,
    "op6_packing": op6_packing,
    "op7_html_text": op7_html_text,
    "op8_warc": op8_warc,
    "op9_line_dedup": op9_line_dedup,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_range_join": op11_range_join,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_hard_negatives": op13_hard_negatives,
}
SQL: dict[str, str] = {
    "op9_line_dedup": linededup.SQL,
    "op11_range_join": OP11_SQL,
    "op13_hard_negatives": OP13_SQL,
}
