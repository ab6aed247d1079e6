"""Shannon entropy in bits over the characters of a string.

Two forms with the same result. ``arrow_entropy`` histograms a whole Arrow
batch at once and is the default: on 85-character addresses it costs about
5 microseconds a row, against about 40 to 110 for ``native_entropy``, whose
higher-order functions Spark evaluates without code generation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _make_arrow_entropy():
    # Nested on purpose: nested functions travel to the workers by value, so
    # the workers do not need this package installed.
    def per_row(lengths: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        rows = len(lengths)
        width = int(symbols.max()) + 1 if len(symbols) else 1
        cell = np.repeat(np.arange(rows, dtype=np.int64) * width, lengths) + symbols
        if width <= 256:
            histogram = np.bincount(cell, minlength=rows * width)
            used = np.flatnonzero(histogram)
            counts = histogram[used]
        else:
            used, counts = np.unique(cell, return_counts=True)
        row = used // width
        share = counts / lengths[row]
        return 0.0 - np.bincount(row, weights=share * np.log2(share), minlength=rows)

    def entropies(texts: pa.Array) -> pa.Array:
        missing = np.asarray(texts.is_null())
        filled = texts.cast(pa.large_string()).fill_null("")
        _, offset_buffer, data_buffer = filled.buffers()
        offsets = np.frombuffer(offset_buffer, dtype=np.int64)[filled.offset:][: len(filled) + 1]
        data = np.frombuffer(data_buffer or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
        lengths = np.diff(offsets)
        if data.size and data.max() >= 0x80:
            starts = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            lengths = np.diff(starts[offsets - offsets[0]])
            data = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype="<u4")
        return pa.array(per_row(lengths, data), mask=missing)

    return F.arrow_udf(entropies, DoubleType())


def arrow_entropy(text: Column | str) -> Column:
    return _make_arrow_entropy()(text)


def native_entropy(text: Column) -> Column:
    """The same value with built-in functions only."""
    length = F.length(text)
    counts = F.transform(
        F.array_distinct(F.split(text, "")),
        lambda c: length - F.length(F.replace(text, c, F.lit(""))),
    )
    return F.aggregate(
        counts,
        F.lit(0.0),
        lambda total, n: total - F.when(n > 0, n / length * F.log2(n / length)).otherwise(0.0),
    )
