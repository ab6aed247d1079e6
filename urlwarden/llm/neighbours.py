"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample with a penalty on long lists. Every
vector stands in the list of its nearest centroid, and vectors near a boundary in
others too. Centroids are found by a graph that every task holds; a query reads
the lists whose centroids are not much farther than the nearest one. How many and
how far is measured: some queries are compared with all vectors, and what reaches
their true neighbours holds for all. Vectors without clusters need a large share
of the lists, clustered ones few. Long lists are cut into shards and their queries
into blocks, so that no task holds a list.

Equal vectors have equal neighbours: of each distinct vector the smallest ids
stand for all in the lists, and equal queries are searched once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlwarden.llm.common import in_one_task, schema_like, sent, settle

SAMPLE = 20_000  # distinct vectors that centroids are fitted on
LIST_ROWS = 200  # vectors per list aimed at
MOST_LISTS = 4_096  # beyond LIST_ROWS x MOST_LISTS vectors the lists get longer
ROUNDS = 12
REPLICAS = 4  # lists that a vector may stand in
BOUNDARY = 1.12  # a boundary vector's other centroids are at most so many times as far as the nearest
PROBES = 48  # lists that a query reads at most, unless RECALL takes more
RATIO = 1.35  # and their centroids' distance against the nearest one's, likewise
RECALL = 0.99  # share of the trial queries' true neighbours that the lists read must hold
TRIALS = 400  # queries compared with all vectors
EDGES = 16
BEAM = 64
STEP = 8  # centroids that a walk goes on from at a time, at least
PAIRS = 50_000  # cosines of a walk worked out at once
SHARD = 4_096  # rows of a list in one task
QUERY_BLOCK = 2_048


@dataclass
class Index:
    centroids: np.ndarray  # unit vectors
    edges: np.ndarray  # centroids near each centroid
    entries: np.ndarray  # where a search begins

    def walk(self, vectors: np.ndarray, beam: int) -> np.ndarray:
        """Cosines of unit vectors to the centroids that a walk comes by, minus infinity to the others. From the entries it goes on
        from the ``beam`` best known centroids to those beside them until all of the best have been left that way."""
        lists = len(self.centroids)
        sight = np.full((len(vectors), lists), -np.inf)
        sight[:, self.entries] = vectors @ self.centroids[self.entries].T
        left = np.zeros(sight.shape, bool)
        while True:
            best = np.argpartition(-sight, beam - 1, axis=1)[:, :beam] if beam < lists else np.broadcast_to(np.arange(lists), sight.shape)
            open_ones = np.where(np.take_along_axis(left, best, 1), -np.inf, np.take_along_axis(sight, best, 1))
            step = max(STEP, beam // 8)
            if step < beam:  # the best of those not left yet
                some = np.argpartition(-open_ones, step - 1, axis=1)[:, :step]
                best, open_ones = np.take_along_axis(best, some, 1), np.take_along_axis(open_ones, some, 1)
            row, place = np.nonzero(np.isfinite(open_ones))
            if not len(row):
                return sight
            from_here = best[row, place]
            left[row, from_here] = True
            beside = np.zeros(sight.shape, bool)
            beside[row[:, None], self.edges[from_here]] = True
            row, new = np.nonzero(beside & np.isinf(sight))
            for at in range(0, len(row), PAIRS):
                r, c = row[at:at + PAIRS], new[at:at + PAIRS]
                sight[r, c] = np.einsum("ij,ij->i", vectors[r], self.centroids[c])

    def search(self, vectors: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroids found, nearest first, and distances, for each unit vector. What the walk did not come by is infinitely far."""
        beam = min(beam, len(self.centroids))
        found, near = np.empty((len(vectors), beam), np.int64), np.empty((len(vectors), beam))
        for at in range(0, len(vectors), 256):
            sight = self.walk(vectors[at:at + 256], beam)
            best = np.argsort(-sight, axis=1, kind="stable")[:, :beam]
            found[at:at + 256] = best
            near[at:at + 256] = np.sqrt(np.maximum(0, 2 - 2 * np.take_along_axis(sight, best, 1)))
        return found, near


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def build(vectors: np.ndarray, lists: int, seed: int = 3) -> Index:
    """Spherical k-means in which a list's pull weakens as it grows, and the graph over the centroids."""
    random = np.random.default_rng(seed)
    points = unit(vectors)
    lists = max(1, min(lists, len(points)))
    centroids = points[random.choice(len(points), lists, replace=False)]
    burden = np.zeros(lists)
    for _ in range(ROUNDS):
        own = np.concatenate([(points[at:at + 4096] @ centroids.T - burden).argmax(1) for at in range(0, len(points), 4096)])
        sizes = np.bincount(own, minlength=lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        norms = np.sqrt((sums * sums).sum(1, keepdims=True))
        centroids = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centroids)
        burden += 0.02 * np.log((sizes + 1) / (len(points) / lists + 1))
    alike = centroids @ centroids.T
    near = np.argsort(-alike, axis=1, kind="stable")[:, 1:EDGES + 1] if lists > 1 else np.zeros((1, 1), np.int64)
    far = random.integers(0, lists, (lists, 2))
    entries = random.choice(lists, min(lists, max(BEAM, int(np.sqrt(lists)))), replace=False)
    return Index(centroids, np.concatenate([near, far], axis=1), np.sort(entries))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def takes_part(vector: str) -> Column:
    finite = f"forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    return F.expr(f"{vector} IS NOT NULL AND size({vector}) > 0 AND {finite} AND exists({vector}, x -> x <> 0)")


def listed(rows: DataFrame, index: Index, width: int, most: int, ratio: float, held: np.ndarray | None = None, least: int = 0) -> DataFrame:
    """``rows`` once for each list that the vector's distance ratio allows, with ``list`` and ``nth``, 0 for the nearest.

    Of ``held`` vectors, by list, those read come to ``least`` if all lists do.
    """
    received = sent(rows.sparkSession, index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = unit(matrix(batch.column("vec"), width))
            found, near = received().search(vectors, max(BEAM, most))
            allowed = (near <= near[:, :1] * ratio + 1e-12) & (np.arange(found.shape[1]) < most)
            if held is not None:
                poor = np.flatnonzero((held[found] * allowed).sum(1) < least)
                if len(poor):
                    all_found, all_near = received().search(vectors[poor], len(held))
                    before = held[all_found].cumsum(1) - held[all_found]
                    further = (before < least) | ((all_near <= all_near[:, :1] * ratio + 1e-12) & (np.arange(len(held)) < most))
                    allowed[poor] = False
                    more_row, more_place = np.nonzero(further)
                    row, place = np.nonzero(allowed)
                    lists, nth = np.concatenate([found[row, place], all_found[more_row, more_place]]), np.concatenate([place, more_place])
                    row = np.concatenate([row, poor[more_row]])
                    yield filed(batch, row, lists, nth)
                    continue
            row, place = np.nonzero(allowed)
            yield filed(batch, row, found[row, place], place)

    def filed(batch: pa.RecordBatch, row: np.ndarray, lists: np.ndarray, nth: np.ndarray) -> pa.RecordBatch:
        kept = batch.take(pa.array(row))
        return pa.RecordBatch.from_arrays([*kept.columns, pa.array(lists), pa.array(nth.astype(np.int32))], names=[*batch.schema.names, "list", "nth"])

    return rows.mapInArrow(run, schema_like(rows, {c: c for c in rows.columns}, [("list", "bigint"), ("nth", "int")]))


def true_neighbours(vectors: DataFrame, queries: np.ndarray, width: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Query rows and vectors of the ``count`` best among all ``vectors`` for each of a few queries, themselves left out."""
    received = sent(vectors.sparkSession, queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = unit(received())
        best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # query, cosine, vector

        def merged() -> None:
            q, cosine, vec = (np.concatenate(parts) for parts in zip(*best))
            order = np.lexsort((-cosine, q))
            q, cosine, vec = q[order], cosine[order], vec[order]
            kept = np.arange(len(q)) - np.searchsorted(q, np.arange(len(asked)))[q] < count
            best[:] = [(q[kept], cosine[kept], vec[kept])]

        for batch in batches:
            some = matrix(batch.column("vec"), width)
            alike = asked @ unit(some).T
            alike[alike > 1 - 1e-12] = -2  # the query's own
            first = np.argpartition(-alike, min(count, alike.shape[1]) - 1, axis=1)[:, :count]
            q = np.repeat(np.arange(len(asked)), first.shape[1])
            best.append((q, alike[q, first.ravel()], some[first.ravel()]))
            merged()
        if best:
            q, cosine, vec = best[0]
            rows = pa.FixedSizeListArray.from_arrays(pa.array(vec.ravel()), width).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(cosine), rows], names=["q", "cosine", "vec"])

    # TRIALS x count rows of each task.
    some = vectors.select(F.col("vec").cast("array<double>").alias("vec")).mapInArrow(run, "q bigint, cosine double, vec array<double>")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("cosine")))
    some = some.where("cosine > -2").withColumn("place", place).where(F.col("place") <= count).select("q", "vec").toArrow()
    return some.column(0).to_numpy(), matrix(some.column(1), width)


def reach(index: Index, queries: np.ndarray, own: np.ndarray, near: np.ndarray, recall: float) -> tuple[int, float]:
    """How many lists, and up to which distance ratio, queries must read to meet ``recall`` of their neighbours ``near``."""
    if not len(own):
        return 1, 1.0
    lists = len(index.centroids)
    order, far = index.search(unit(queries), lists)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(lists)[None, :], 1)
    stand, apart = index.search(unit(near))
    stand, apart = stand[:, :REPLICAS], apart[:, :REPLICAS]
    ranks = np.where(apart <= apart[:, :1] * BOUNDARY + 1e-12, rank[own[:, None], stand], lists).min(1)
    probes = int(np.quantile(ranks, recall, method="higher")) + 1
    met = ranks < probes
    ratios = far[own[met], ranks[met]] / np.maximum(far[own[met], 0], 1e-9)
    return probes, float(ratios.max())


def best_pairs(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query row, id and cosine of each query's nearest, ties to smaller ids.

    A product of matrices finds what may be among them; cosines are then worked
    out pair by pair, in one order of summing, so that equal vectors tie exactly.
    """
    scale_q, scale_v = np.abs(queries).max(1, keepdims=True), np.abs(vectors).max(1, keepdims=True)
    queries, vectors = queries / scale_q, vectors / scale_v
    size_q, size_v = np.sqrt((queries * queries).sum(1)), np.sqrt((vectors * vectors).sum(1))
    about = (queries / size_q[:, None]) @ (vectors / size_v[:, None]).T
    if len(ids) > count:
        floor = -np.partition(-about, count - 1, axis=1)[:, count - 1:count]
        q, v = np.nonzero(about >= floor - 1e-9)
    else:
        q, v = (a.ravel() for a in np.indices(about.shape))
    cosine = (queries[q] * vectors[v]).sum(1) / (size_q[q] * size_v[v])
    order = np.lexsort((ids[v], -cosine, q))
    q, v, cosine = q[order], v[order], cosine[order]
    first = np.searchsorted(q, np.arange(len(queries)))
    kept = np.arange(len(q)) - first[q] < count
    return q[kept], ids[v[kept]], cosine[kept]


def neighbours(
    vectors: DataFrame, is_query: Column, count: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    probes: int = PROBES, ratio: float = RATIO, recall: float = RECALL,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``count`` nearest found by cosine, ties to the smaller id.

    Queries are the rows for which ``is_query`` holds; candidates are all rows of
    another id. Vectors that are null, empty, zero, of another length than most,
    or hold null or non-finite components take no part, nor do null ids. Rows of
    one id and vector count once. An empty table gives no rows.

    A query reads ``probes`` lists within ``ratio``, or as many as hold ``recall`` of
    the true neighbours of ``TRIALS`` queries if that is more, and further ones until
    they have ``count`` vectors besides its own.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & takes_part("vec"))
    lengths = rows.groupBy(F.size("vec").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], f"query_id bigint, rank int, {id_col} bigint, score double")
    width = lengths["width"]
    rows = rows.where(F.size("vec") == width).withColumns({"k1": F.xxhash64("vec"), "k2": F.hash("vec")})
    # As a group limit, this keeps count + 1 rows of a vector in each task before they meet.
    order = F.row_number().over(Window.partitionBy("k1", "k2", "vec").orderBy("id"))
    rows = rows.dropDuplicates(["id", "k1", "k2"])
    distinct = settle(rows.select("id", "vec", "k1", "k2", order.alias("place")).where(F.col("place") <= count + 1))

    heads = distinct.where("place = 1")
    total = heads.count()
    sample = matrix(heads.orderBy(F.xxhash64("k1", "k2"), "id").limit(SAMPLE).select("vec").toArrow().column(0), width)
    lists = min(MOST_LISTS, -(-total // LIST_ROWS))
    index = in_one_task(vectors.sparkSession, lambda: build(sample, lists))

    postings = settle(listed(distinct.select("id", "vec"), index, width, REPLICAS, BOUNDARY))
    asked = settle(rows.where("asks").groupBy("k1", "k2").agg(F.first("vec").alias("vec"), F.count("*").alias("n")))
    held = np.zeros(len(index.centroids), np.int64)  # by the nearest list alone, so that no vector counts twice
    for row in postings.where("nth = 0").groupBy("list").count().collect():
        held[row["list"]] = row["count"]
    trials = matrix(asked.orderBy(F.xxhash64("k2", "k1"), "k1").limit(TRIALS).select("vec").toArrow().column(0), width)
    if lists > 1:
        own, near = true_neighbours(heads, trials, width, count)
        wanted = in_one_task(vectors.sparkSession, lambda: reach(index, trials, own, near, recall))
        probes, ratio = max(probes, wanted[0]), max(ratio, wanted[1])
    reads = settle(listed(asked.drop("n"), index, width, probes, ratio, held, count + 1))
    # One row per list, MOST_LISTS at most.
    shards = postings.groupBy("list").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards"))
    blocks = reads.groupBy("list").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))
    cuts = F.broadcast(shards.join(blocks, "list"))
    left = postings.join(cuts, "list").select(
        "list", F.pmod(F.hash("id"), "shards").alias("shard"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", "vec")
    right = reads.join(cuts, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.pmod("k2", "blocks").alias("block"), "k1", "k2", "vec")

    def search(some: pa.Table, queries: pa.Table) -> pa.Table:
        if not some.num_rows or not queries.num_rows:
            return schema_of([])
        q, ids, cosine = best_pairs(matrix(queries["vec"], width), matrix(some["vec"], width), some["id"].to_numpy(), count + 1)
        return schema_of([queries["k1"].to_numpy()[q], queries["k2"].to_numpy()[q], ids, cosine])

    def schema_of(columns: list[np.ndarray]) -> pa.Table:
        kinds = [("k1", pa.int64()), ("k2", pa.int32()), ("id", pa.int64()), ("score", pa.float64())]
        return pa.table({name: pa.array(columns[k] if columns else [], kind) for k, (name, kind) in enumerate(kinds)})

    keys = ["list", "shard", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "k1 bigint, k2 int, id bigint, score double")
    best = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "id")
    found = found.groupBy("k1", "k2", "id").agg(F.max("score").alias("score"))
    found = settle(found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= count + 1))
    asks = rows.where("asks").select(F.col("id").alias("query_id"), "k1", "k2")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    answers = asks.join(found, ["k1", "k2"]).where(F.col("id") != F.col("query_id")).withColumn("rank", F.row_number().over(rank))
    return answers.where(F.col("rank") <= count).select("query_id", "rank", F.col("id").alias(id_col), "score")
