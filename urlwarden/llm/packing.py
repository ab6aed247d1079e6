"""Packing by concatenating and cutting.

All documents, each followed by the end id, form one long row of ids that is
cut every ``width`` ids. Pass one encodes the documents and gives each its place
within its partition; the partitions' totals, one small row each, become the
partitions' starts by a prefix sum. Pass two knows every document's place in the
long row and cuts it without a shuffle. A document that crosses a cut gives a
boundary record, marked by ``opens`` and ``closes``, on either side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urlwarden.llm.common import schema_like, settle, text_of
from urlwarden.llm.subwords import subwords

WIDTH = 1024
END_ID = 0


def encoded(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """``id, part, place, bytes_each, ids``: ids as little-endian bytes, two or four each."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, place, part = subwords(tokenizer), 0, TaskContext.get().partitionId()
        end = np.array([end_id], dtype=words.dtype).tobytes()
        for batch in batches:
            rows = [ids + end for ids in words.encode(batch.column(1).to_pylist())]
            ends = place + np.cumsum([len(ids) // words.dtype.itemsize for ids in rows], dtype=np.int64)
            starts = np.concatenate([[place], ends[:-1]]) if rows else ends
            place = int(ends[-1]) if rows else place
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(rows), pa.int32()), pa.array(starts, pa.int64()),
                 pa.array([words.dtype.itemsize] * len(rows), pa.int32()), pa.array(rows, pa.binary())],
                names=schema.fieldNames())

    wanted = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = schema_like(wanted, {"id": "id"}, [("part", "int"), ("place", "bigint"), ("bytes_each", "int"), ("ids", "binary")])
    return wanted.mapInArrow(encode, schema)


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, end_id: int = END_ID,
) -> DataFrame:
    """Pieces of documents in sequences of ``width`` ids; only the last sequence may be shorter.

    One row per piece: ``id_col, start, length, doc_tokens, sequence_id, offset,
    opens, closes, ids`` (little-endian unsigned 32-bit). Null and empty texts are
    one end id. Rows with equal or null ids stay apart. No documents, no rows.
    Other columns are not looked at.
    """
    rows = settle(encoded(docs, tokenizer, id_col, text_col, end_id), "snappy")
    size = F.length("ids") / F.col("bytes_each")
    totals = rows.groupBy("part").agg(F.max(F.col("place") + size.cast("bigint")).alias("total"))
    # One row per partition of the input, whatever its size.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = rows.join(F.broadcast(starts), "part").select("id", (F.col("base") + F.col("place")).alias("at"), "bytes_each", "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, length, total, sequence, offset, ids = [], [], [], [], [], [], []
            for k, (at, each, raw) in enumerate(zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))):
                values = np.frombuffer(raw, dtype=f"<u{each}").astype("<u4")
                n, here = len(values), 0
                while here < n:
                    room = min(n - here, width - (at + here) % width)
                    row.append(k)
                    start.append(here)
                    length.append(room)
                    total.append(n)
                    sequence.append((at + here) // width)
                    offset.append((at + here) % width)
                    ids.append(values[here:here + room].tobytes())
                    here += room
            numbers = [pa.array(x, pa.int64()) for x in (start, length, total, sequence, offset)]
            opens = pa.array([s == 0 for s in start], pa.bool_())
            closes = pa.array([s + n == t for s, n, t in zip(start, length, total)], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), *numbers, opens, closes, pa.array(ids, pa.binary())],
                names=schema.fieldNames())

    schema = schema_like(placed, {id_col: "id"}, [
        ("start", "bigint"), ("length", "bigint"), ("doc_tokens", "bigint"), ("sequence_id", "bigint"), ("offset", "bigint"),
        ("opens", "boolean"), ("closes", "boolean"), ("ids", "binary")])
    return placed.mapInArrow(cut, schema)


def sequences(pieces: DataFrame, width: int = WIDTH, pad_id: int = END_ID) -> DataFrame:
    """``sequence_id, tokens, ids``: whole sequences, the last one padded unless its length is a power of two."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    joined = pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.expr("aggregate(parts, 0L, (n, p) -> n + p.length)").alias("tokens"),
        F.expr("aggregate(parts, X'', (a, p) -> a || p.ids)").alias("ids"))
    whole = F.expr("tokens & (tokens - 1)") == 0
    pad = F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), (F.lit(width) - F.col("tokens")).cast("int"))
    return joined.withColumn("ids", F.when(whole, F.col("ids")).otherwise(F.concat("ids", F.unhex(pad))))
