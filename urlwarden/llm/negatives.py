"""Hard negatives by an inverted multi-index, exact.

Vectors are cut in two halves, each with a codebook of its own; a pair of codes is a
cell. For an anchor, half a score is at most its product with the code word plus
its length times the code word's radius, so the sum of two such bounds holds for a
cell. A heap over the two sorted lists of bounds visits cells from the largest sum
on and stops as soon as no cell left can change the answer: the nearest of the own
label first, then for each of them the best of other labels in its score window.

Vectors are dealt into shards by a hash, so that neither a label nor a cell nor a
crowd of equal vectors decides how much a task holds; every shard is indexed over
the same codebooks, and anchors meet them in blocks. What shards find is merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlwarden.llm.common import in_one_task, sent, settle
from urlwarden.llm.neighbours import matrix

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # a window, in hundredths of the positive's score
SCALE = 256
SAMPLE = 8_192  # vectors that codebooks are fitted on
CODES = 16  # of a half
ROUNDS = 8
SHARD = 16_384  # vectors of a task
BLOCK = 16_384  # anchors of a task
EXACT = float(1 << 53)  # products whose sums of magnitudes stay below are whole numbers in doubles
LARGEST = (1 << 63) - 1
FARTHEST = 10 ** 37  # scores beyond count as this
HUGE = 1e100  # components from here on make bounds meaningless


@dataclass
class Books:
    """Code words of either half."""

    first: np.ndarray
    second: np.ndarray

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return vectors[:, :cut], vectors[:, cut:]


def nearest(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    if not points.shape[1]:
        return np.zeros(len(points), np.int64)
    return (points @ words.T - (words * words).sum(1) / 2).argmax(1)


def codebook(points: np.ndarray, codes: int, seed: int) -> np.ndarray:
    random = np.random.default_rng(seed)
    words = points[random.choice(len(points), min(codes, len(points)), replace=False)]
    for _ in range(ROUNDS):
        own = nearest(points, words)
        sums = np.zeros_like(words)
        np.add.at(sums, own, points)
        sizes = np.bincount(own, minlength=len(words))
        words = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], words)
    return words


def fit(vectors: np.ndarray, codes: int = CODES) -> Books:
    cut = vectors.shape[1] // 2
    return Books(codebook(vectors[:, :cut], codes, 1), codebook(vectors[:, cut:], codes, 2))


class Shard:
    """An inverted multi-index over some vectors: rows sorted by cell, and each code word's radius among them."""

    def __init__(self, books: Books, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        self.books = books
        halves = books.halves(vectors)
        codes = nearest(halves[0], books.first), nearest(halves[1], books.second)
        self.radii = []
        for half, code, words in zip(halves, codes, (books.first, books.second)):
            far = np.sqrt(((half - words[code]) ** 2).sum(1))
            radius = np.zeros(len(words))
            np.maximum.at(radius, code, far)
            self.radii.append(radius)
        cell = codes[0] * len(books.second) + codes[1]
        order = np.argsort(cell, kind="stable")
        self.vectors, self.ids, self.labels = vectors[order], ids[order], labels[order]
        self.edges = np.searchsorted(cell[order], np.arange(len(books.first) * len(books.second) + 1))
        self.longest = np.sqrt((vectors * vectors).sum(1)).max(initial=0.0)
        self.largest = np.abs(vectors).max(initial=0.0)

    def cells(self, anchor: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """``bound, begin, end``: rows of cells that have any, from the largest sum of half bounds on."""
        if max(self.largest, np.abs(anchor).max(initial=0.0)) > HUGE:
            yield np.inf, 0, len(self.ids)
            return
        bounds, orders = [], []
        for half, words, radius in zip(self.books.halves(anchor[None, :]), (self.books.first, self.books.second), self.radii):
            size = np.sqrt((half[0] * half[0]).sum())
            bound = words @ half[0] + size * radius
            order = np.argsort(-bound, kind="stable")
            bounds.append(bound[order].tolist())
            orders.append(order.tolist())
        (u, v), (first, second), edges = bounds, orders, self.edges.tolist()
        slack = 1e-9 * (abs(u[0]) + abs(v[0]) + np.sqrt((anchor * anchor).sum()) * self.longest) + 1e-9
        heap, pushed = [(-(u[0] + v[0]), 0, 0)], {(0, 0)}
        while heap:
            bound, i, j = heappop(heap)
            cell = first[i] * len(second) + second[j]
            if edges[cell] < edges[cell + 1]:
                yield -bound + slack, edges[cell], edges[cell + 1]
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(u) and b < len(v) and (a, b) not in pushed:
                    pushed.add((a, b))
                    heappush(heap, (-(u[a] + v[b]), a, b))

    def scores(self, anchor: np.ndarray, begin: int, end: int) -> np.ndarray:
        """Whole numbers, exact: beyond what doubles hold, by integers of any size."""
        some = self.vectors[begin:end]
        if self.largest * np.abs(anchor).max(initial=0.0) * max(1, len(anchor)) < EXACT:
            return some @ anchor
        big = np.array([int(x) for x in anchor], object)
        exact = (sum(int(x) * y for x, y in zip(row, big)) for row in some.tolist())
        return np.array([min(max(score, -FARTHEST), FARTHEST) for score in exact], object)

    def best(self, anchor: np.ndarray, own_id: int, label: int, count: int) -> list[tuple[int, int]]:
        """``(score, id)`` of the best other rows of the label."""
        found: list[tuple[int, int]] = []
        for bound, begin, end in self.cells(anchor):
            floor = found[-1][0] if len(found) == count else -np.inf
            if bound < floor:
                break
            score = self.scores(anchor, begin, end)
            if score.max() < floor:
                continue
            wanted = np.flatnonzero((score >= floor) & (self.labels[begin:end] == label) & (self.ids[begin:end] != own_id))
            if len(wanted):
                found = leading(found + list(zip(map(int, score[wanted]), self.ids[begin:end][wanted].tolist())), count)
        return found

    def windows(self, anchor: np.ndarray, label: int, windows: list[tuple[int, int]], count: int) -> list[list[tuple[int, int]]]:
        """For each window of scores (low and high, both in it) ``(score, id)`` of the best rows of other labels."""
        found: list[list[tuple[int, int]]] = [[] for _ in windows]
        floors = [low for low, _ in windows]
        for bound, begin, end in self.cells(anchor):
            # Certified: each window is full of what no cell left can beat, or lies above all of them.
            least = min(floors)
            if bound < least:
                break
            score = self.scores(anchor, begin, end)
            if score.max() < least:
                continue
            wanted = (score >= least) & (self.labels[begin:end] != label)
            score, ids = score[wanted], self.ids[begin:end][wanted]
            for k, (_, high) in enumerate(windows):
                inside = np.flatnonzero((score >= floors[k]) & (score <= high))
                if len(inside):
                    found[k] = leading(found[k] + list(zip(map(int, score[inside]), ids[inside].tolist())), count)
                    if len(found[k]) == count:
                        floors[k] = max(floors[k], found[k][-1][0])
        return found


def leading(found: list[tuple[int, int]], count: int) -> list[tuple[int, int]]:
    return sorted(found, key=lambda x: (-x[0], x[1]))[:count]


def met(rows: DataFrame, anchors: DataFrame, shards: int, blocks: int) -> tuple:
    """Rows by shard, once for each block of anchors, and anchors by block, once for each shard."""
    shard, block = F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"), F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")
    left = rows.select(shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "id", "label", "vec")
    right = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block.alias("block"), *(F.col(c).alias(c) for c in anchors.columns))
    return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    window: tuple[int, int] = (LOW, HIGH), scale: float = SCALE, codes: int = CODES,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale x component)``; a row's score is its inner product with the anchor, higher ones
    first, ties to the smaller id. Of each anchor, a row for which ``is_anchor`` holds, the first ``positives`` other
    rows of its label are paired with the first ``negatives`` rows of other labels whose score is between the
    window's hundredths of the positive's. A positive without any has no rows.

    Rows with a null id, label or vector, with null or non-finite components (also once scaled), or of another length
    than most take no part; zero vectors do. Rows equal in id, label and vector count once; different rows of one id
    are anchors of their own and no positives of each other. Scores are compared exactly up to 10**37 and returned
    as 64 bits, the nearest such number beyond. Ids and labels are integers; other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    scaled = F.transform(F.col(vector_col), lambda x: x.cast("double") * F.lit(float(scale)))
    whole = F.expr("forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), scaled.alias("vec"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & whole)
    # floor of a double keeps 63 bits, so larger ones, which are whole, stay as they are.
    floored = F.transform("vec", lambda x: F.when(F.abs(x) < F.lit(EXACT), F.floor(x).cast("double")).otherwise(x))
    rows = rows.withColumn("vec", floored)
    lengths = rows.groupBy(F.size("vec").alias("width")).count().orderBy(F.desc("count"), "width").first()
    out = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if lengths is None:
        return spark.createDataFrame([], out)
    width = lengths["width"]
    rows = rows.where(F.size("vec") == width).withColumn("key", F.xxhash64("id", "label", "vec"))
    rows = settle(rows.groupBy("id", "label", "key").agg(F.first("vec").alias("vec"), F.bool_or("asks").alias("asks")))
    total, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    sample = matrix(rows.orderBy(F.xxhash64("key"), "id").limit(SAMPLE).select("vec").toArrow().column(0), width)
    # Vectors of any size: the code words only steer the search.
    sample = sample / max(1.0, float(np.abs(sample).max()) / 1e100)
    books = sent(spark, in_one_task(spark, lambda: fit(sample, codes)))
    shards, blocks = -(-total // SHARD), max(1, -(-asked // BLOCK))
    anchors = rows.where("asks").select("id", "label", "key", "vec")

    def indexed(some: pa.Table) -> Shard:
        return Shard(books(), matrix(some["vec"], width), some["id"].to_numpy(), some["label"].to_numpy())

    def near(some: pa.Table, asking: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if some.num_rows and asking.num_rows:
            index = indexed(some)
            for key, own, label, vec in zip(asking["key"].to_pylist(), asking["id"].to_pylist(), asking["label"].to_pylist(), matrix(asking["vec"], width)):
                found += [(key, own, other, score) for score, other in index.best(vec, own, label, positives)]
        return table(found, [("key", pa.int64()), ("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("score", pa.string())])

    def table(found: list[tuple], columns: list[tuple[str, pa.DataType]]) -> pa.Table:
        """Scores travel as decimal text, as they may pass 64 bits."""
        parts = zip(*found) if found else [()] * len(columns)
        return pa.table({name: pa.array(list(map(str, part)) if kind == pa.string() else list(part), kind) for part, (name, kind) in zip(parts, columns)})

    exact = F.col("score").cast("decimal(38,0)")
    best = met(rows, anchors, shards, blocks).applyInArrow(near, "key bigint, anchor_id bigint, positive_id bigint, score string")
    place = F.row_number().over(Window.partitionBy("key", "anchor_id").orderBy(F.desc("score"), "positive_id"))
    best = settle(best.withColumn("score", exact).withColumn("place", place).where(F.col("place") <= positives))
    # At most ``positives`` scores of an anchor.
    asking = best.groupBy("key", F.col("anchor_id").alias("id")).agg(
        F.collect_set(F.col("score").cast("string")).alias("bases"))
    asking = anchors.join(asking, ["key", "id"])
    low, high = window

    def mined(some: pa.Table, asking: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if some.num_rows and asking.num_rows:
            index = indexed(some)
            columns = (asking[c].to_pylist() for c in ("key", "id", "label", "bases"))
            for key, own, label, bases, vec in zip(*columns, matrix(asking["vec"], width)):
                spans = {base: (-(-low * int(base) // 100), high * int(base) // 100) for base in bases}
                spans = {base: span for base, span in spans.items() if span[0] <= span[1]}
                if spans:
                    for base, rest in zip(spans, index.windows(vec, label, list(spans.values()), negatives)):
                        found += [(key, own, base, other, score) for score, other in rest]
        return table(found, [("key", pa.int64()), ("anchor_id", pa.int64()), ("base", pa.string()), ("negative_id", pa.int64()), ("score", pa.string())])

    hard = met(rows, asking, shards, blocks).applyInArrow(
        mined, "key bigint, anchor_id bigint, base string, negative_id bigint, score string")
    hard = hard.withColumns({"score": exact, "base": F.col("base").cast("decimal(38,0)")})
    rank = F.row_number().over(Window.partitionBy("key", "anchor_id", "base").orderBy(F.desc("score"), "negative_id"))
    hard = hard.withColumn("rank", rank).where(F.col("rank") <= negatives).withColumnRenamed("score", "negative_score")
    pairs = best.select("key", "anchor_id", "positive_id", F.col("score").alias("base"))

    def bounded(column: str) -> Column:
        return F.least(F.greatest(F.col(column), F.lit(-LARGEST - 1)), F.lit(LARGEST)).cast("bigint")

    return pairs.join(hard, ["key", "anchor_id", "base"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", bounded("base").alias("positive_score"), bounded("negative_score").alias("negative_score"))
