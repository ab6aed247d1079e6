"""WARC archives: writing with revisit records, reading back, and one ordered index.

Every record is a gzip member of its own, so that an index entry's offset and
length suffice to read it. Reading gives a run of index entries per task, sorted
by URL key, time and record. The runs are dealt out by key ranges, and each range
merges its parts of all runs by a loser tree: together, one globally ordered
history of captures.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urlwarden.llm.common import document_key, settle
from urlwarden.session import checkpoint_dir

LEAST_REVISIT = 1_000  # bytes; smaller payloads are always written out
FILE_BYTES = 32 << 20  # payload bytes per archive aimed at
FIRST_DATE = datetime(2024, 1, 1, tzinfo=timezone.utc)
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The blank lines that end a record, as a gzip member. Spark's text writer puts
# it behind each row; as Latin-1, characters stand for bytes.
RECORD_END = gzip.compress(b"\r\n\r\n", mtime=0)


def record_id(page: Any, text: bytes) -> str:
    """The same for equal rows, whatever task writes them."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(repr(page).encode() + b' ' + text).digest()[:16])}>"


def record(page: Any, url: str | None, payload: bytes, digest: str, refers: str | None) -> bytes:
    """One record without the blank lines that end it; ``refers`` is the id of the response that a revisit repeats."""
    block = HTTP_HEAD if refers else HTTP_HEAD + payload
    date = FIRST_DATE + timedelta(seconds=page % 2**31) if isinstance(page, int) else FIRST_DATE
    target = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "urn:none:")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers else 'response'}", f"WARC-Record-ID: {record_id(page, payload)}",
             f"WARC-Date: {date:%Y-%m-%dT%H:%M:%SZ}", f"WARC-Target-URI: {target}", "Content-Type: application/http; msgtype=response",
             f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    if refers:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {refers}"]
    if page is not None:
        lines.append(f"WARC-Page-ID: {page}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """One record per row into ``folder``. Null payloads are empty, null URLs a URN of their own.

    Of equal payloads of ``LEAST_REVISIT`` bytes or more the one of the largest id
    is written out; the others are revisits of it. Null ids are smaller than any;
    rows of one id and payload get one record type. Payloads travel once, by
    document, so that no digest gathers its copies in a task.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"), *document_key(id_col, html_col))
    narrow = rows.withColumn("bytes", F.length("payload")).select("id", "k1", "k2", "bytes", F.sha1("payload").alias("digest"))
    large = narrow.where(F.col("bytes") >= LEAST_REVISIT)
    groups = settle(large.groupBy("digest").agg(F.count("*").alias("n"), F.max("id").alias("kept")).where("n > 1"))
    repeats = large.join(groups, "digest").where(F.coalesce(F.col("id") < F.col("kept"), F.col("kept").isNotNull()))
    repeats = settle(repeats.select("k1", "k2", "kept").distinct())
    size = narrow.agg(F.sum(F.col("bytes").cast("bigint"))).first()[0] or 0
    files = max(1, -(-size // FILE_BYTES))
    dealt = rows.repartition(files, "k1", "k2").join(repeats, ["k1", "k2"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = []
            for page, url, body, kept in zip(*(batch.column(k).to_pylist() for k in range(4))):
                refers = None if kept is None else record_id(kept, body)
                records.append(gzip.compress(record(page, url, body, hashlib.sha1(body).hexdigest(), refers), 6, mtime=0))
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["value"])

    built = dealt.select("id", "url", "payload", "kept").mapInArrow(run, "value binary")
    # As a string the bytes are written as they are.
    writer = built.select(F.col("value").cast("string")).write.option("encoding", "ISO-8859-1").option("compression", "none")
    writer.option("lineSep", RECORD_END.decode("latin-1")).text(folder)


def members(data: bytes, step: int = 1 << 14) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each gzip member."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpack, content, here = zlib.decompressobj(31), [], at
        while not unpack.eof:
            if here >= len(view):
                raise ValueError(f"archive ends inside the member at {at}")
            part = view[here:here + step]
            content.append(unpack.decompress(part))
            here += len(part) - len(unpack.unused_data)
        yield at, here - at, b"".join(content)
        at = here


def url_key(url: str) -> str:
    """Host labels from the last to the first, then the rest, so that a site's captures stand together."""
    rest = url.split("://", 1)[-1].lower()
    cut = next((k for k, c in enumerate(rest) if c in "/?#"), len(rest))
    host = rest[:cut].rsplit("@", 1)[-1].removeprefix("www.")
    name, _, port = host.partition(":")
    return ",".join(reversed(name.split("."))) + (f":{port}" if port else "") + ")" + (rest[cut:] or "/")


INDEX = ("url_key string, date string, record_id string, page_id string, record_type string, payload_bytes bigint, "
         "payload_digest string, refers_to string, file string, offset bigint, length bigint")


def read_record(content: bytes) -> dict[str, Any] | None:
    """Index fields of a record, with size and digest of the payload that it holds. None for the blank lines between records."""
    head, mark, block = content.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        return None
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    if not mark or len(block) != int(fields["Content-Length"]):
        raise ValueError(f"record {fields.get('WARC-Record-ID')} is cut")
    body, revisit = block.partition(b"\r\n\r\n")[2], fields["WARC-Type"] == "revisit"
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    digest = stated if revisit else hashlib.sha1(body).hexdigest()
    if digest != stated:
        raise ValueError(f"record {fields['WARC-Record-ID']} has another payload than its digest says")
    return {
        "url_key": url_key(fields["WARC-Target-URI"]), "date": fields["WARC-Date"], "record_id": fields["WARC-Record-ID"],
        "page_id": fields.get("WARC-Page-ID"), "record_type": fields["WARC-Type"], "payload_bytes": None if revisit else len(body),
        "payload_digest": digest, "refers_to": fields.get("WARC-Refers-To"),
    }


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Index entries of all records in ``folder``, those of a task sorted; ``run`` numbers the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = []
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                for offset, length, content in members(data.as_py()):
                    if entry := read_record(content):
                        entries.append(entry | {"file": file, "offset": offset, "length": length, "run": number})
        entries.sort(key=lambda e: (e["url_key"], e["date"], e["record_id"]))
        yield pa.RecordBatch.from_pylist(entries, schema=kinds)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    number = None
    schema = StructType.fromDDL(f"{INDEX}, run int")
    kinds = to_arrow_schema(schema)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal number
        number = TaskContext.get().partitionId()
        return run(batches)

    return spark.read.format("binaryFile").load(folder).select("path", "content").mapInArrow(numbered, schema)


def merged(runs: list[list]) -> Iterator:
    """All items of sorted ``runs`` in order, by a tree whose inner nodes keep the losers of their matches.

    An item passes as many matches as the logarithm of the number of runs. Equal
    items come in the order of their runs.
    """
    runs = [r for r in runs if r]
    size = max(1, 1 << (len(runs) - 1).bit_length()) if runs else 0
    done = object()
    places = [0] * size

    def front(k: int) -> Any:
        return runs[k][places[k]] if k < len(runs) and places[k] < len(runs[k]) else done

    def beats(a: int, b: int) -> bool:
        x, y = fronts[a], fronts[b]
        return y is done or x is not done and (x, a) < (y, b)

    fronts = [front(k) for k in range(size)]
    losers, winners = [0] * size, [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    best = winners[1] if size > 1 else 0
    while size and fronts[best] is not done:
        yield fronts[best]
        places[best] += 1
        fronts[best] = front(best)
        node = (best + size) >> 1
        while node:
            if beats(losers[node], best):
                losers[node], best = best, losers[node]
            node >>= 1


def histories(index: DataFrame, range_rows: int = 50_000) -> DataFrame:
    """The index in global order; ``place`` counts from 0. Ranges are of about ``range_rows`` entries.

    A URL of any number of captures is cut by time and record like any other.
    """
    index = settle(index)
    ranges = max(1, -(-index.count() // range_rows))
    names = index.columns
    key = [names.index(c) for c in ("url_key", "date", "record_id")]
    spot = names.index("run")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        runs: dict[int, list] = {}
        columns = [table.column(k).to_pylist() for k in (spot, *key)]
        for row, (own, *rest) in enumerate(zip(*columns)):
            runs.setdefault(own, []).append((*rest, row))
        for some in runs.values():
            some.sort()  # a run's part comes in order, unless Spark fetched it in pieces
        order = pa.array([item[-1] for item in merged([runs[k] for k in sorted(runs)])], pa.int64())
        part = pa.array([TaskContext.get().partitionId()] * len(order), pa.int32())
        rank = pa.array(range(len(order)), pa.int64())
        for batch in table.take(order).append_column("part", part).append_column("rank", rank).to_batches(max_chunksize=10_000):
            yield batch

    from pyspark.sql.types import IntegerType, LongType

    schema = index.schema.add("part", IntegerType()).add("rank", LongType())
    ordered = settle(index.repartitionByRange(ranges, "url_key", "date", "record_id").mapInArrow(merge, schema))
    # One row per range.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ordered.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = ordered.join(F.broadcast(starts), "part").withColumn("place", F.col("base") + F.col("rank"))
    return placed.drop("part", "rank", "base", "run")


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back and give the ordered index.

    As ``INDEX``, and ``place``; of a revisit, ``payload_bytes`` and ``refers_page``
    are those of the response that it names. No pages, no rows. The archives go
    when the driver ends.
    """
    spark = pages.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder, id_col, url_col, html_col)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    index = settle(histories(read_archives(spark, folder)))
    named = index.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("full"), F.col("page_id").alias("refers_page")).distinct()
    joined = index.join(named, "refers_to", "left")
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", "full")).drop("full")
