"""Exact range join of vectors by angle, over pivots.

The angle between two vectors is a metric. Pivots are picked on a sample, crowded
places first; each vector is at home in the cell of its nearest pivot and visits
the cells in which a vector within reach can be at home:

* in cell j no vector is farther from pivot j than the cell's radius, so a visitor
  is at most ``radius + reach`` from it, and at least ``inner radius - reach``;
* vectors at home in j are no nearer to the visitor's pivot i than to j, so the
  visitor is at most ``reach`` beyond the plane halfway between the two pivots
  (which is the triangle inequality's ``2 x reach``, sharpened).

Of two cells, one receives the visitors of the other, so that a pair is compared
once. Cells join on their own, cut into blocks. Vectors within half the reach of
one pivot are linked to one another by the triangle inequality alone: a crowd of
near copies is counted, not compared. Equal vectors are one vector with a weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlwarden.llm.common import in_one_task, schema_like, sent, settle
from urlwarden.llm.components import components
from urlwarden.llm.neighbours import matrix, takes_part, unit

LEAST = 0.95
SAMPLE = 8_192  # distinct vectors that pivots are picked on
CELL_ROWS = 4_096  # vectors per cell aimed at
MOST_CELLS = 2_048  # beyond CELL_ROWS x MOST_CELLS vectors the cells get larger
BLOCK = 8_192  # vectors of a cell in one task, on either side
STRIP = 1_024
CARRIED = ["node", "k1", "n", "vec"]  # a distinct vector: its smallest id, a hash, its weight
SLACK = 1e-6  # angles and bounds are rounded; cosines are compared as they are


@dataclass
class Pivots:
    points: np.ndarray  # unit vectors
    apart: np.ndarray  # chord between any two
    reach: float  # largest angle of a link

    def angles(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cosines and angles of unit vectors to every pivot."""
        cosine = np.clip(vectors @ self.points.T, -1, 1)
        return cosine, np.arccos(cosine)


def pick(vectors: np.ndarray, cells: int, least: float) -> Pivots:
    """Up to ``cells`` pivots, crowded places first, none within two reaches of another;
    each then moves to the middle of the sample within its reach."""
    points, reach = unit(vectors), float(np.arccos(least))
    crowd = np.concatenate([(points[at:at + STRIP] @ points.T >= least).sum(1) for at in range(0, len(points), STRIP)])
    free, chosen, far = np.ones(len(points), bool), [], np.cos(min(np.pi, 2 * reach))
    for k in np.argsort(-crowd, kind="stable"):
        if len(chosen) == cells:
            break
        if free[k]:
            chosen.append(k)
            free &= points @ points[k] < far
    middles = []
    for k in chosen:
        mean = points[points @ points[k] >= least].mean(0)
        size = np.sqrt(mean @ mean)
        middles.append(mean / size if size > 1e-6 else points[k])
    kept = np.array(middles)
    return Pivots(kept, np.sqrt(np.maximum(0, 2 - 2 * kept @ kept.T)), reach)


def at_home(rows: DataFrame, pivots: Pivots, width: int) -> DataFrame:
    """``node, k1, n, vec`` with ``cell``, ``far`` (the angle to its pivot) and ``core``: within half the reach."""
    received = sent(rows.sparkSession, pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = received()
            _, angles = own.angles(unit(matrix(batch.column("vec"), width)))
            cell = angles.argmin(1)
            far = angles[np.arange(len(cell)), cell]
            core = far <= own.reach / 2 - SLACK
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far), pa.array(core)], names=[*batch.schema.names, "cell", "far", "core"])

    return rows.mapInArrow(run, schema_like(rows, {c: c for c in rows.columns}, [("cell", "int"), ("far", "double"), ("core", "boolean")]))


def visitors(home: DataFrame, pivots: Pivots, inner: np.ndarray, outer: np.ndarray, width: int) -> DataFrame:
    """``cell, node, k1, n, vec``: vectors at home elsewhere, in each cell that may hold a link of theirs and receives them."""
    received = sent(home.sparkSession, (pivots, inner, outer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, low, high = received()
            cosine, angles = own.angles(unit(matrix(batch.column("vec"), width)))
            cell = batch.column("cell").to_numpy()
            row = np.arange(len(cell))[:, None]
            every = np.arange(len(own.points))[None, :]
            chord = 2 * np.sin(own.reach / 2)
            receives = np.where((cell[:, None] + every) % 2 == 0, every > cell[:, None], every < cell[:, None])
            near = (angles <= high + own.reach + SLACK) & (angles >= low - own.reach - SLACK)
            near &= cosine[row, cell[:, None]] - cosine <= own.apart[cell] * chord + SLACK
            who, where = np.nonzero(receives & near)
            kept = batch.select(CARRIED).take(pa.array(who))
            yield pa.RecordBatch.from_arrays([pa.array(where.astype(np.int32)), *kept.columns], names=["cell", *CARRIED])

    return home.mapInArrow(run, schema_like(home, {c: c for c in ("cell", *CARRIED)}))


def linked(left: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """Which rows of two matrices have a cosine of ``least`` or more. A product of matrices decides all but those that
    its rounding may have moved; these are worked out pair by pair."""
    left, right = left / np.abs(left).max(1, keepdims=True), right / np.abs(right).max(1, keepdims=True)
    size_l, size_r = np.sqrt((left * left).sum(1)), np.sqrt((right * right).sum(1))
    flat_l, flat_r = left / size_l[:, None], right / size_r[:, None]
    out = np.empty((len(left), len(right)), bool)
    for at in range(0, len(left), STRIP):
        about = flat_l[at:at + STRIP] @ flat_r.T
        out[at:at + STRIP] = about >= least
        a, b = np.nonzero(np.abs(about - least) < 1e-12)
        if len(a):
            out[at + a, b] = (left[at + a] * right[b]).sum(1) / (size_l[at + a] * size_r[b]) >= least
    return out


def forest(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row and each column that has a link, the smallest row it is connected to."""
    rows, columns = np.arange(links.shape[0]), None
    none = links.shape[0]
    while True:
        columns = np.where(links, rows[:, None], none).min(0)
        after = np.where(links, columns[None, :], none).min(1)
        if (after == rows).all():
            return rows, columns
        rows = np.minimum(after, rows)


def compared(left: pa.Table, right: pa.Table, same: bool, least: float, width: int) -> list[np.ndarray]:
    """``node, k1, links, root`` of the vectors that have links between two blocks, or within one."""
    ids, hashes, weights = ([side[c].to_numpy() for side in (left, right)] for c in ("node", "k1", "n"))
    links = linked(matrix(left["vec"], width), matrix(right["vec"], width), least)
    if same:
        np.fill_diagonal(links, False)
    a, b = np.flatnonzero(links.any(1)), np.flatnonzero(links.any(0))
    if not len(a):
        return [ids[0][:0]] * 4
    links = links[np.ix_(a, b)]
    # Within one block a row and its column are one vector.
    root, root_b = forest(links | np.eye(len(a), dtype=bool) if same else links)
    rows = [ids[0][a], hashes[0][a], links @ weights[1][b], ids[0][a[root]]]
    if same:  # both sides are the same rows, so one of them tells all
        return rows
    columns = [ids[1][b], hashes[1][b], links.T @ weights[0][a], ids[0][a[root_b]]]
    return [np.concatenate(both) for both in zip(rows, columns)]


def blocks_of(home: DataFrame, guests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two sides of every pair of blocks in a cell: ``cell, first, second`` and a vector, as the first and as the second.

    The blocks of a cell are numbered: others at home, then the core, then visitors. Every pair of them is
    compared but core with core, which is linked throughout, and visitors with visitors, who meet elsewhere.
    """
    def count(condition: str):
        return F.ceil(F.count_if(F.expr(condition)) / BLOCK).cast("int")

    rows = home.select("cell", *CARRIED, F.when(F.col("core"), 1).otherwise(0).alias("kind")).unionByName(guests.withColumn("kind", F.lit(2)))
    # One row per cell, MOST_CELLS at most.
    sizes = F.broadcast(rows.groupBy("cell").agg(count("kind = 0").alias("s0"), count("kind = 1").alias("s1"), count("kind = 2").alias("s2")))
    own = F.pmod(F.xxhash64("node"), F.expr("CASE kind WHEN 0 THEN s0 WHEN 1 THEN s1 ELSE s2 END")).cast("int")
    dealt = rows.join(sizes, "cell").withColumn("block", own + F.expr("CASE kind WHEN 0 THEN 0 WHEN 1 THEN s0 ELSE s0 + s1 END"))

    def side(first: str, second: str, begin: str, end: str, wanted: str) -> DataFrame:
        some = dealt.where(wanted).withColumns({"a": F.expr(begin), "b": F.expr(end)}).where("a <= b")
        some = some.withColumn("other", F.explode(F.sequence("a", "b")))
        # Columns of its own, for the cogroup.
        return some.select(F.col("cell").alias("cell"), F.col(first).alias("first"), F.col(second).alias("second"), *(F.col(c).alias(c) for c in CARRIED))

    return (side("block", "other", "CASE kind WHEN 0 THEN block ELSE s0 + s1 END", "s0 + s1 + s2 - 1", "kind < 2"),
            side("other", "block", "0", "CASE kind WHEN 0 THEN block - 1 WHEN 1 THEN s0 - 1 ELSE s0 + s1 - 1 END", "true"))


def links_of(nodes: DataFrame, width: int, least: float) -> DataFrame:
    """``nodes`` (distinct vectors) to ``node, k1, links, root``, one or more rows of each that has links: how many
    the rows of a node add up to, and nodes that connect what all links connect."""
    spark = nodes.sparkSession
    total = nodes.count()
    sample = matrix(nodes.orderBy(F.xxhash64("k1", "node"), "node").limit(SAMPLE).select("vec").toArrow().column(0), width)
    pivots = in_one_task(spark, lambda: pick(sample, min(MOST_CELLS, -(-total // CELL_ROWS)), least))
    home = settle(at_home(nodes, pivots, width))
    inner, outer = np.full(len(pivots.points), np.inf), np.full(len(pivots.points), -np.inf)
    stats = home.groupBy("cell").agg(
        F.min("far").alias("low"), F.max("far").alias("high"), F.min(F.when(F.col("core"), F.col("node"))).alias("head"),
        F.coalesce(F.sum(F.when(F.col("core"), F.col("n"))), F.lit(0)).alias("held"))
    for row in stats.collect():  # MOST_CELLS at most
        inner[row["cell"]], outer[row["cell"]] = row["low"], row["high"]
    left, right = blocks_of(home, settle(visitors(home, pivots, inner, outer, width)))
    keys = ["cell", "first", "second"]

    def join(key: tuple, some: pa.Table, others: pa.Table) -> pa.Table:
        same = key[1].as_py() == key[2].as_py()
        others = some if same else others
        found = compared(some, others, same, least, width) if some.num_rows and others.num_rows else [[]] * 4
        return pa.table({name: pa.array(column, pa.int64()) for name, column in zip(("node", "k1", "links", "root"), found)})

    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(join, "node bigint, k1 bigint, links bigint, root bigint")
    core = home.where("core").join(F.broadcast(stats.select("cell", "head", "held")), "cell")
    return settle(met.unionByName(core.select("node", "k1", (F.col("held") - F.col("n")).alias("links"), F.col("head").alias("root"))))


def range_links(vectors: DataFrame, least: float = LEAST, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col, n_links, component_id, kept``: for each vector how many others have a cosine of ``least`` (above 0) or
    more with it, the smallest id reachable over such links, and whether that is its own.

    Ids are integers. Vectors that are null, empty, zero, of another length than most, or hold null or
    non-finite components link with nothing: no links, their own component. A row without an id comes back
    without links, its component null, not kept. Rows equal in id and vector count once and come back once;
    different vectors of one id have links of their own and share a component. Other columns are ignored; an
    empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vec"))
    rows = rows.withColumn("valid", F.col("id").isNotNull() & takes_part("vec"))
    lengths = rows.where("valid").groupBy(F.size("vec").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if lengths is None:
        alone = rows.dropDuplicates(["id", "vec"]).select(F.col("id").alias(id_col), F.lit(0).cast("bigint").alias("n_links"), "id")
        return alone.select(id_col, "n_links", F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    width = lengths["width"]
    rows = rows.withColumns({"valid": F.col("valid") & (F.size("vec") == width), "k1": F.xxhash64("vec"), "k2": F.hash("vec")})
    rows = settle(rows.dropDuplicates(["id", "k1", "k2"]))
    nodes = settle(rows.where("valid").groupBy("k1", "k2").agg(F.min("id").alias("node"), F.count("*").alias("n"), F.first("vec").alias("vec")))
    found = links_of(nodes.select(*CARRIED), width, least)
    # Equal vectors hang on the one with the smallest id.
    twins = rows.where("valid").join(nodes.drop("vec"), ["k1", "k2"]).select(F.col("id").alias("a"), F.col("node").alias("b"))
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(twins))
    counts = nodes.drop("vec").join(found.groupBy("node", "k1").agg(F.sum("links").alias("links")), ["node", "k1"], "left")
    counts = settle(counts.select("k1", "k2", F.lit(True).alias("valid"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    told = rows.drop("vec").join(counts, ["k1", "k2", "valid"], "left").join(groups, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component", "id")
    return told.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))
