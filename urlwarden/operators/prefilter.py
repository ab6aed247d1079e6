"""A Bloom filter of keys as a table, merged by Spark and measured before it travels.

A key sets a few bits of one 64-bit word. Words are merged by ``bit_or``, in each task
first, so building it shuffles words and not keys. The words become one array in one
row, which is broadcast; a key that is not in the filter is not among the keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS_PER_WORD = 4  # 16 bits a key: about one false answer in 150
BITS_PER_KEY = 5
MAX_WORDS = 16_000_000  # 128 MB, for 64 million keys


@dataclass(frozen=True)
class Prefilter:
    words: DataFrame    # one row: `words ARRAY<BIGINT>`, stored
    size: int           # how many


def word_of(key: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("word")), F.lit(size))


def mask_of(key: Column) -> Column:
    """The bits of a key within its word, six bits of a hash each."""
    code, one = F.xxhash64(key, F.lit("bits")), F.lit(1).cast("bigint")
    places = (F.shiftrightunsigned(code, 6 * k).bitwiseAND(63).cast("int") for k in range(BITS_PER_KEY))
    return reduce(Column.bitwiseOR, (F.call_function("shiftleft", one, place) for place in places))


def build(keys: DataFrame, column: str, count: int) -> Prefilter | None:
    """The filter of ``count`` keys; none if it would be larger than may travel."""
    size = max(1, -(-count // KEYS_PER_WORD))
    if size > MAX_WORDS:
        return None
    key = F.col(column)
    words = keys.where(key.isNotNull()).groupBy(word_of(key, size).alias("word")).agg(F.bit_or(mask_of(key)).alias("bits"))
    # In pieces of 64,000 words, put together in order: no task sorts what is not bounded by MAX_WORDS.
    every = keys.sparkSession.range(size).select(F.col("id").alias("word")).join(words, "word", "left").select(
        (F.col("word") / 64_000).cast("bigint").alias("piece"), F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits")).alias("w"))
    pieces = every.groupBy("piece").agg(F.transform(F.array_sort(F.collect_list("w")), lambda w: w["bits"]).alias("part"))
    whole = pieces.agg(F.array_sort(F.collect_list(F.struct("piece", "part"))).alias("parts"))
    return Prefilter(whole.select(F.flatten(F.transform("parts", lambda p: p["part"])).alias("words")).checkpoint(), size)


def maybe_any(df: DataFrame, filters: Prefilter, keys: Column, name: str) -> DataFrame:
    """Add ``name``: whether one of an array of keys may be in the filter. False only if none is; null counts as none."""
    side = F.broadcast(filters.words.select(F.lit(1).alias("__one"), F.col("words").alias("__words")))  # one row of MAX_WORDS at most
    probed = F.exists(keys, lambda k: k.isNotNull() & (
        F.get(F.col("__words"), word_of(k, filters.size).cast("int")).bitwiseAND(mask_of(k)) == mask_of(k)))
    given = df.columns
    return df.withColumn("__one", F.lit(1)).join(side, "__one").select(*given, F.coalesce(probed, F.lit(False)).alias(name))
