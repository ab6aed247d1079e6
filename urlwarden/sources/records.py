"""Records of one large file, found by many tasks.

A quoted CSV cell may hold line breaks and a JSON array is one value, so where a
record ends depends on all that comes before: on whether a quote is open and how
many brackets are. Spark still reads such a file in byte ranges, cut at a character
that may end a record. What a piece does to the state is worked out without knowing
the state; these effects are composed within a range and, over a table of one row per
range, across ranges. Then every piece knows the state it begins in. Only pieces of
records that have several are brought together. The lines of CSV files are read twice,
in their order, once for the effects of ranges and once to be put together: only records
that lie in several ranges are shuffled. Files of a codec that can't be cut are one range
each, so their lines are read once and nothing of them is stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urlwarden.session import checkpoint_dir, stored

# Quoting of cells and of JSON strings.
CLOSED_CELLS = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|\r?$)'  # a quoted cell from its first to its last quote
OPENED_CELL = r'(^|,)"'
REST_OF_CELL = r'^[^"]*+(?:""[^"]*+)*+"(?=,|\r?$)'  # what an open cell still holds up to its last quote
ESCAPED = r"\\."


def pieces(spark: SparkSession, path: str, end: str) -> DataFrame:
    """``file, start, at, value``: what stands between two ``end``, by byte range of its file and place in it. Stored,
    as it is read more than once and its order counts."""
    checkpoint_dir(spark)
    raw = spark.read.text(path, lineSep=end).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), "value")
    return raw.checkpoint()


def before(rows: DataFrame, column: Column, name: str) -> DataFrame:
    """Add the sum of ``column`` over all earlier pieces of the file. A window holds the pieces of one byte range, a
    second one the ranges of one file."""
    inside = Window.partitionBy("file", "start").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("__v", column.cast("bigint"))
    totals = summed.groupBy("file", "start").agg(F.sum("__v").alias("__t"))
    totals = totals.select("file", "start", F.coalesce(F.sum("__t").over(across), F.lit(0)).alias("__before"))
    placed = summed.withColumn("__inside", F.coalesce(F.sum("__v").over(inside), F.lit(0)))
    return placed.join(totals, ["file", "start"]).withColumn(name, F.col("__before") + F.col("__inside")).drop("__v", "__t", "__before", "__inside")


def opened(rows: DataFrame, from_closed: Column, from_open: Column) -> DataFrame:
    """Add ``open``: whether a quote is open where a piece begins, from whether it is open behind a piece that begins
    closed or open. A piece that ends alike either way settles the state; between two such the others flip it or not."""
    effect = rows.withColumns({"__c": from_closed, "__o": from_open})
    effect = effect.withColumn("__settles", F.col("__c") == F.col("__o")).withColumn("__flips", F.col("__c") & ~F.col("__o"))
    flips = before(effect, F.col("__flips"), "__f")
    settled = F.when(F.col("__settles"), F.struct(F.col("__c").alias("to"), (F.col("__f") + F.col("__flips").cast("bigint")).alias("flips")))
    inside = Window.partitionBy("file", "start").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    marked = flips.withColumn("__s", settled)
    ranges = marked.groupBy("file", "start").agg(F.max_by("__s", F.when(F.col("__settles"), F.col("at"))).alias("__last"))
    ranges = ranges.select("file", "start", F.last("__last", ignorenulls=True).over(across).alias("__earlier"))
    marked = marked.withColumn("__here", F.last("__s", ignorenulls=True).over(inside)).join(ranges, ["file", "start"])
    state = F.coalesce("__here", "__earlier", F.struct(F.lit(False).alias("to"), F.lit(0).cast("bigint").alias("flips")))
    marked = marked.withColumn("__state", state)
    odd = (F.col("__f") - F.col("__state.flips")) % 2 == 1
    return marked.withColumn("open", F.col("__state.to") != odd).select(*rows.columns, "open")


def joined_pieces(rows: DataFrame, ends: Column, glue: str) -> DataFrame:
    """``file, record, value``: pieces up to one for which ``ends`` holds, put together. ``record`` counts from 0 in the file."""
    marked = rows.withColumn("__ends", ends)
    numbered = before(marked, F.col("__ends"), "record")
    # A record that is one piece needs no shuffle: the one before it ended, and so does it.
    starts = F.lag("__ends").over(Window.partitionBy("file", "start").orderBy("at"))
    single = F.coalesce(starts & F.col("__ends"), F.lit(False))
    numbered = numbered.withColumn("__single", single)
    alone = numbered.where("__single").select("file", "record", "value")
    parts = numbered.where("NOT __single").groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("start", "at", "value"))).alias("parts"))
    return alone.unionByName(parts.select("file", "record", F.array_join(F.transform("parts", lambda p: p["value"]), glue).alias("value")))


def _walker():
    # Nested on purpose: it travels to the workers by value, so they do not need this package.
    def stretches(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
        """The lines of a batch by byte range, in their order: ``file, start`` and the lines."""
        file, start = batch.column(0), batch.column(1).to_numpy()
        other = file.slice(1).to_numpy(zero_copy_only=False) != file.slice(0, max(len(file) - 1, 0)).to_numpy(zero_copy_only=False)
        cuts = np.r_[0, np.flatnonzero((np.diff(start) != 0) | other) + 1, len(start)] if len(start) else [0]
        for low, high in zip(cuts[:-1], cuts[1:]):
            yield file[int(low)].as_py(), int(start[low]), batch.slice(int(low), int(high - low))

    def states(state: bool, closed: np.ndarray, opened: np.ndarray) -> np.ndarray:
        """Whether a quote is open behind each line, if one is or not before the first: the last line that ends alike either
        way settles it, later ones flip it or not."""
        settles, flips = closed == opened, np.cumsum(closed & ~opened)
        last = np.maximum.accumulate(np.where(settles, np.arange(len(closed)), -1))
        since = np.where(last >= 0, closed[last], state)
        return since ^ ((flips - np.where(last >= 0, flips[last], 0)) % 2 == 1)

    return stretches, states


def _range_effects(lines: DataFrame) -> DataFrame:
    """``file, start, c, o, ends_c, ends_o``: what a range does from a closed and from an open quote: whether one is open
    behind it, and how many records end in it."""
    stretches, states = _walker()

    def flags(batch):
        return (batch.column(k).to_numpy(zero_copy_only=False).astype(bool) for k in (2, 3))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        for batch in batches:
            for file, start, some in stretches(batch):
                closed, opened = flags(some)
                known = found.setdefault((file, start), [False, True, 0, 0])
                for side in (0, 1):
                    behind = states(known[side], closed, opened)
                    known[side], known[2 + side] = bool(behind[-1]), known[2 + side] + int((~behind).sum())
        if found:
            yield pa.RecordBatch.from_pylist([dict(zip(("file", "start", "c", "o", "ends_c", "ends_o"), (*key, *known))) for key, known in found.items()])

    return lines.select("file", "start", "c", "o").mapInArrow(told, "file string, start bigint, c boolean, o boolean, ends_c bigint, ends_o bigint")


def _put_together(lines: DataFrame) -> DataFrame:
    """``file, record, start, whole, value`` from the lines with the state ``open`` and number ``record`` that their range
    begins with: records, and the parts of those that don't lie in one range."""
    stretches, states = _walker()

    def flags(batch):
        return (batch.column(k).to_numpy(zero_copy_only=False).astype(bool) for k in (2, 3))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "record", "start", "whole", "value"]

        def rows(file, start, record, whole, value):
            n = len(record)
            return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(file, pa.string()), n), pa.array(record, pa.int64()), pa.repeat(pa.scalar(start, pa.int64()), n),
                                               pa.array(whole, pa.bool_()), pa.array(value, pa.string()) if isinstance(value, list) else value], names=names)

        at, state, record, head, held = None, False, 0, False, []  # held: lines of a record that goes on; head: it began in an earlier range
        for batch in batches:
            for file, start, some in stretches(batch):
                if at != (file, start):
                    if held:
                        yield rows(*at, [record], [False], ["\n".join(held)])
                    at, held = (file, start), []
                    state = head = some.column(4)[0].as_py()
                    record = some.column(5)[0].as_py()
                closed, opened = flags(some)
                behind = states(state, closed, opened)
                before = np.r_[state, behind[:-1]]
                number = record + np.r_[0, np.cumsum(~behind)[:-1]]
                text = some.column(6).cast(pa.string())
                alone = np.flatnonzero(~before & ~behind)
                if len(alone):
                    yield rows(file, start, number[alone], np.ones(len(alone), bool), text.take(pa.array(alone)))
                several = np.flatnonzero(before | behind)
                done: list[tuple[int, bool, str]] = []
                for k, line in zip(several.tolist(), text.take(pa.array(several)).to_pylist()):
                    held.append(line)
                    if not behind[k]:
                        done.append((int(number[k]), not head, "\n".join(held)))
                        held, head = [], False
                if done:
                    yield rows(file, start, *map(list, zip(*done)))
                state, record = bool(behind[-1]), record + int((~behind).sum())
        if held:
            yield rows(*at, [record], [False], ["\n".join(held)])

    return lines.select("file", "start", "c", "o", "open", "record", "value").mapInArrow(
        told, "file string, record bigint, start bigint, whole boolean, value string")


def _uncut(spark: SparkSession, names: list[str]) -> bool:
    """Whether every file has a codec, by the end of its name, with which one task reads it from its beginning."""
    compress = spark.sparkContext._jvm.org.apache.hadoop.io.compress
    known = compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    cuttable = spark.sparkContext._jvm.java.lang.Class.forName("org.apache.hadoop.io.compress.SplittableCompressionCodec")
    for end in {name.rsplit("/", 1)[-1].rpartition(".")[2] for name in names}:
        codec = known.getCodec(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"name.{end}"))
        if codec is None or cuttable.isInstance(codec):
            return False
    return bool(names)


def _csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, c, o, value``: lines, and whether a quote is open behind one that begins closed or open."""
    def left_open(text: Column) -> Column:
        return F.regexp_replace(text, CLOSED_CELLS, "$1").rlike(OPENED_CELL)

    text = F.col("value")
    still = ~text.rlike(REST_OF_CELL) | left_open(F.regexp_replace(text, REST_OF_CELL, ""))
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), left_open(text).alias("c"), still.alias("o"), "value")


def _filled(records: DataFrame) -> DataFrame:
    return records.withColumn("value", F.regexp_replace("value", r"\r$", "")).where("value <> ''")


def _uncut_records(lines: DataFrame) -> DataFrame:
    """``file, record, value`` of files that are one range each: no quote is open where they begin."""
    begun = lines.withColumns({"open": F.lit(False), "record": F.lit(0).cast("bigint")})
    return _filled(_put_together(begun).select("file", "record", "value"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, record, value``: the text of each record, with the line breaks its quoted cells hold."""
    lines = _csv_lines(spark, path)
    if _uncut(spark, lines.inputFiles()):
        return _uncut_records(lines)
    # A range is one piece of its file: its place in the file takes that of a piece in a range.
    ranges = stored(_range_effects(lines)).withColumns({"at": F.col("start"), "start": F.lit(0).cast("bigint")})
    known = before(opened(ranges, F.col("c"), F.col("o")), F.when(F.col("open"), F.col("ends_o")).otherwise(F.col("ends_c")), "record")
    begun = stored(known.select("file", F.col("at").alias("start"), "open", "record"))
    parts = stored(_put_together(lines.join(F.broadcast(begun), ["file", "start"])))  # one row per byte range
    broken = parts.where("NOT whole").groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("start", "value"))).alias("parts"))
    whole = parts.where("whole").select("file", "record", "value").unionByName(
        broken.select("file", "record", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value")))
    return _filled(whole)


def _first_record(spark: SparkSession, path: str, records: DataFrame) -> str | None:
    """The first record of the first file that has one. Of files that can't be cut, only the first is read for it, if it has any."""
    lines = _csv_lines(spark, path)
    names = lines.inputFiles()
    found = None
    if _uncut(spark, names):
        name = min(names).replace("file:///", "file:/", 1)  # as the column has it
        found = _uncut_records(lines.where(F.col("file") == name)).orderBy("record").limit(1).first()
    found = found or records.orderBy("file", "record").limit(1).first()
    return found["value"] if found else None


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of CSV files of one header, all columns text: as the plain reader of multi-line files, but in byte ranges."""
    records = csv_records(spark, path)
    first = _first_record(spark, path, records)
    if first is None:
        return spark.createDataFrame([], "_c0 string")
    options = {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1"}
    named = spark.createDataFrame([(first,)], "value string").select(
        F.from_csv("value", _texts([f"_c{k}" for k in range(first.count(",") + 1)]), options).alias("r")).first()["r"]
    names = [name for name in named if name is not None]
    schema = _texts(names)
    rows = records.where("record > 0").select(F.from_csv("value", schema, options).alias("r"))
    return rows.select(*(F.col("r").getField(name).alias(name) for name in names))


def _texts(names: list[str]) -> str:
    return ", ".join(f"`{name.replace('`', '``')}` string" for name in names)


def _json_state(spark: SparkSession, path: str, end: str) -> DataFrame:
    """Pieces of JSON files between two ``end`` with ``open`` (a string is) and ``plain``: the text outside strings."""
    cut = pieces(spark, path, end)
    bare = F.regexp_replace("value", ESCAPED, "")
    odd = F.length(F.regexp_replace(bare, '[^"]', "")) % 2 == 1
    known = opened(cut, odd, ~odd)
    outside = F.when(F.col("open"), F.regexp_replace(bare, r'^[^"]*+"?', "")).otherwise(bare)
    plain = F.regexp_replace(F.regexp_replace(outside, '"[^"]*+"', ""), '"[^"]*+$', "")
    return known.withColumns({"plain": plain, "closed": F.when(F.col("open"), odd).otherwise(~odd)})


def _deeper(text: str) -> Column:
    return F.length(F.regexp_replace(text, r"[^\[{]", "")) - F.length(F.regexp_replace(text, r"[^\]}]", ""))


def json_objects(spark: SparkSession, path: str) -> DataFrame:
    """``file, record, value``: the objects of JSON files that each hold one array of objects, or objects one after the other."""
    cut = _json_state(spark, path, "}")
    # Each piece lost the brace behind it, which counts unless a string is open there; so did the last one of a file, after its
    # end, unless nothing follows.
    known = before(cut, _deeper("plain") - F.col("closed").cast("int"), "deep").withColumn(
        "after", F.col("deep") + _deeper("plain") - F.col("closed").cast("int"))
    listed = F.col("plain").rlike(r"^[ \t\r\n﻿]*\[") & (F.col("deep") == 0)
    base = known.withColumn("listed", listed).groupBy("file").agg(F.max(listed.cast("int")).alias("base"))
    known = known.join(base, "file")
    whole = joined_pieces(known, F.col("closed") & (F.col("after") == F.col("base")), "}")
    value = F.concat(F.regexp_replace("value", r"^[﻿ \t\r\n,\[]+", ""), F.lit("}"))
    return whole.select("file", "record", value.alias("value")).where(F.startswith("value", F.lit("{")))


def json_strings(spark: SparkSession, path: str) -> DataFrame:
    """``file, record, value``: the texts of JSON files that each hold one array of strings."""
    cut = _json_state(spark, path, ",")
    whole = joined_pieces(cut, F.col("closed"), ",")
    text = F.regexp_replace("value", r"^[﻿ \t\r\n\[]+|[ \t\r\n\]]+$", "")
    return whole.select("file", "record", F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>").alias("v")).select(
        "file", "record", F.explode("v").alias("value"))


def read_json(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """Objects as rows of text columns. Without ``names`` the columns are the keys that occur, in alphabetical order."""
    objects = json_objects(spark, path).checkpoint()
    kept = objects.select(F.from_json("value", "map<string,string>").alias("m"))
    if names is None:
        names = sorted(r[0] for r in kept.select(F.explode(F.map_keys("m"))).distinct().collect())  # column names
    return kept.select(*(F.try_element_at("m", F.lit(name)).alias(name) for name in names))
