"""Near copies by SimHash: fingerprints, pivot distance tables, components.

Distances to reference fingerprints differ by no more than the distance of two
fingerprints does. So a pair is discarded by the largest difference between its
rows of the distance table, and only survivors are compared bit by bit.

The tables are compared within buckets, whose members are sorted by their distance to the
first reference: only those within ``k`` bits by it are paired, so most pairs are
discarded before they are looked at, and the other references discard most of the rest. Of ``k + 2`` blocks of bits, ``k`` bits
can't spoil more than ``k``, so a linked pair agrees in two blocks at least: each
distinct fingerprint goes into one bucket for every two blocks. A bucket of more
than ``CROWD`` fingerprints is dealt out again by its remaining bits, in the same
way, which leaves ``CROWD`` at most after two more rounds for ``k`` of 2. No pair is lost and
no bucket has all pairs written out: links within one form a forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlwarden.llm.common import document_key, schema_like, settle
from urlwarden.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
CROWD = 256
PIVOTS = 16
BLOCK = 1 << 18  # shingles hashed at a time


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the shingles' hashes, as a signed number."""
    words = text.lower().split()  # of bytes: A-Z only, and \x20 \x09-\x0D
    if not words:
        return 0
    ones, total = np.zeros(64, np.int64), max(1, len(words) - shingle + 1)
    for at in range(0, total, BLOCK):
        some = words[at:at + BLOCK + shingle - 1]
        joined = b" ".join(some)
        sizes = np.fromiter(map(len, some), np.int64, len(some))
        ends = np.cumsum(sizes + 1) - 1
        starts, count = ends - sizes, max(1, len(some) - shingle + 1)
        slices = zip(starts[:count].tolist(), ends[-count:].tolist())
        hashes = map(xxhash.xxh64_intdigest, (joined[a:b] for a, b in slices), repeat(SEED))
        bits = np.fromiter(hashes, np.uint64, count).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id, k1, k2, fingerprint`` of every row; a null text has the fingerprint of an empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py() or b"", shingle) for text in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(prints, pa.int64())], names=["id", "k1", "k2", "fingerprint"])

    wanted = docs.select(F.col(id_col).alias("id"), *document_key(id_col, text_col), F.col(text_col).cast("string").cast("binary").alias("text"))
    return wanted.mapInArrow(run, schema_like(wanted, {c: c for c in ("id", "k1", "k2")}, [("fingerprint", "bigint")]))


def finer(mask: int, max_bits: int) -> list[int]:
    """Masks that hold ``mask`` and two of ``max_bits + 2`` blocks of the other bits."""
    free = [bit for bit in range(64) if not mask >> bit & 1]
    blocks = [sum(1 << int(bit) for bit in part) for part in np.array_split(free, max_bits + 2)]
    wide = (mask | a | b for a, b in combinations(blocks, 2))
    return sorted({m - (1 << 64) if m >> 63 else m for m in wide})


def crowds(keyed: DataFrame) -> DataFrame:
    """``mask, value, fingerprint, n`` of buckets with more than one fingerprint."""
    counts = settle(keyed.groupBy("mask", "value").agg(F.count("*").alias("n")).where("n > 1"))
    return settle(keyed.join(counts, ["mask", "value"]))


def buckets(prints: DataFrame, max_bits: int) -> DataFrame:
    """``mask, value, fingerprint``: buckets of ``CROWD`` distinct fingerprints at most."""
    masks, found, level = [0], None, prints.select(F.lit(0).cast("bigint").alias("mask"), "fingerprint")
    while True:
        steps = {m: finer(m & (1 << 64) - 1, max_bits) for m in masks}
        children = F.create_map(*(x for m, some in steps.items() for x in (F.lit(m).cast("bigint"), F.array(*(F.lit(c).cast("bigint") for c in some)))))
        dealt = level.select(F.explode(F.element_at(children, F.col("mask"))).alias("mask"), "fingerprint")
        crowd = crowds(dealt.select("mask", F.col("mask").bitwiseAND(F.col("fingerprint")).alias("value"), "fingerprint").distinct())
        masks = sorted({child for some in steps.values() for child in some})
        last = all((m & (1 << 64) - 1).bit_count() > 64 - CROWD.bit_length() for m in masks)
        fit = (crowd if last else crowd.where(F.col("n") <= CROWD)).select("mask", "value", "fingerprint")
        found = fit if found is None else found.union(fit)
        if last:
            return found
        level = crowd.where(F.col("n") > CROWD).select("mask", "fingerprint")


def references(count: int = PIVOTS) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"pivot {k}", SEED) for k in range(count)], dtype=np.uint64)


def forest(size: int, pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    above, kept = list(range(size)), []
    for a, b in pairs:
        x, y = a, b
        while above[x] != x:
            x = above[x]
        while above[y] != y:
            y = above[y]
        if x != y:
            above[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def survivors(near: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``bucket, a, b``: pairs that no pivot discards. ``near`` is buckets x members x pivots, members by rising distance
    to the first pivot: only those within ``max_bits`` by it are paired at all, at growing lags until none is left."""
    members = near.shape[1]
    for lag in range(1, members):
        bucket, a = np.nonzero(near[:, lag:, 0] - near[:, :members - lag, 0] <= max_bits)
        if not len(bucket):
            return
        for pivot in range(1, near.shape[2]):
            kept = np.abs(near[bucket, a + lag, pivot] - near[bucket, a, pivot]) <= max_bits
            bucket, a = bucket[kept], a[kept]
        yield bucket, a, a + lag


def links_of(prints: np.ndarray, pivots: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within each row of ``prints`` (buckets x members): a forest of each."""
    members = prints.shape[1]
    lefts, rights = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    step = max(1, 200_000 // members)
    for at in range(0, len(prints), step):
        rows = prints[at:at + step]
        order = np.argsort(np.bitwise_count(rows ^ pivots[0]), axis=1, kind="stable")
        rows = np.take_along_axis(rows, order, 1)
        table = np.bitwise_count(rows[..., None] ^ pivots).astype(np.int8)
        bucket, a, b = (np.concatenate(part) for part in zip(*survivors(table, max_bits), (np.empty(0, np.int64),) * 3))
        true = np.bitwise_count(rows[bucket, a] ^ rows[bucket, b]) <= max_bits
        bucket, a, b = bucket[true], a[true], b[true]
        if members > 2 and len(bucket):
            order = np.argsort(bucket, kind="stable")
            bucket, a, b = bucket[order], a[order], b[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            trees = [(own[0], forest(members, zip(x.tolist(), y.tolist())))
                     for own, x, y in zip(np.split(bucket, cuts), np.split(a, cuts), np.split(b, cuts))]
            bucket = np.array([k for k, tree in trees for _ in tree], np.int64)
            a, b = (np.array([edge[side] for _, tree in trees for edge in tree], np.int64) for side in (0, 1))
        lefts.append(rows[bucket, a])
        rights.append(rows[bucket, b])
    return np.concatenate(lefts), np.concatenate(rights)


def linked(dealt: DataFrame, max_bits: int) -> DataFrame:
    """``a, b``: links that join all fingerprints of a bucket that are near one another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, rest = references(), np.empty((3, 0), np.int64)

        def links(rows: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
            sizes, prints = np.diff(cuts), rows[2].view(np.uint64)
            out = [links_of(prints[cuts[:-1][sizes == s][:, None] + np.arange(s)], pivots, max_bits) for s in np.unique(sizes) if s > 1]
            a, b = (np.concatenate([x[k] for x in out] or [np.empty(0, np.uint64)]).view(np.int64) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            rows = np.concatenate([rest, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])], axis=1)
            new = np.flatnonzero((rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])) + 1
            rest = rows[:, new[-1]:] if len(new) else rows
            if len(new):
                yield links(rows, np.concatenate([[0], new]))
        if rest.shape[1]:
            yield links(rest, np.array([0, rest.shape[1]]))

    partitions = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartition(partitions, "mask", "value").sortWithinPartitions("mask", "value", "fingerprint")
    return ordered.mapInArrow(run, "a bigint, b bigint")


def grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """``id, k1, k2, fingerprint, component_id, first``: ``first`` is the key of the component's first row."""
    prints = settle(fingerprints(docs, id_col, text_col, shingle))
    first = F.struct(F.col("id").isNull().alias("unnamed"), "id", "k1", "k2")
    distinct = settle(prints.groupBy("fingerprint").agg(F.min("id").alias("least"), F.min(first).alias("first")))
    labels = components(linked(buckets(distinct, max_bits), max_bits))
    labelled = settle(distinct.join(labels, distinct.fingerprint == labels.node, "left").select(
        "fingerprint", "least", "first", F.coalesce("component", "fingerprint").alias("component")))
    least = settle(labelled.groupBy("component").agg(F.min("least").alias("component_id"), F.min("first").alias("first")))
    named = settle(labelled.drop("least", "first").join(least, "component").drop("component"))
    return prints.join(named, "fingerprint")


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS,
) -> DataFrame:
    """``id_col, fingerprint`` (64-bit signed), ``component_id``: one row per row of ``docs``.

    ``component_id`` is the smallest id reachable over fingerprints that differ in
    ``max_bits`` bits at most; null ids don't count, and a component of null ids
    only has a null. Null and empty texts have fingerprint zero. Rows with equal
    ids stay apart. No documents, no rows. Other columns are not looked at.
    """
    found = grouped(docs, id_col, text_col, shingle, max_bits)
    return found.select(F.col("id").alias(id_col), "fingerprint", "component_id")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id, null last."""
    first = grouped(docs, id_col, text_col, shingle, max_bits).select("first.k1", "first.k2").distinct()
    keyed = docs.select(F.struct(*docs.columns).alias("doc"), *document_key(id_col, text_col))
    return keyed.join(first, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select("doc.*")
