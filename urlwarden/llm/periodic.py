"""Maximal periodic runs of words by string synchronising sets.

At scale t (a power of two) the synchronising set holds the positions i where the
smallest hash of a stretch of t words, among those that begin in i..i+t, is that of
the stretch at i or at i+t. Whether i belongs to it depends on the next 2t words
alone, so equal contexts choose alike. Stretches of a period of t/3 or less don't
count, which keeps the set sparse.

A run of period p in 3t..6t-1 holds a chosen i for which i+p is chosen too and the 2t
words at both are equal: such pairs propose periods, which are then checked word by
word. A run is missed only if its first p words are all of a period of t/3 or less.
Then it lies across two neighbouring runs of that smaller period, and the phases of
these tell its own. Periods 1 and 2, below any scale, are compared directly.

All documents of a batch are searched at once, longest first, so that a scale sees
only those long enough for it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlwarden.llm.common import schema_like

LEAST_LENGTH = 12
LEAST_REPEATS = 2
BATCH_WORDS = 300_000  # words searched at once; a longer text is a batch of its own
WORD = regex.compile(r"[^\x20\x09-\x0D]+")
DONE = np.uint64(0xFFFFFFFFFFFFFFFF)

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
Change = Callable[[object, list[str]], list[str]]


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of pairs of hashes."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(hashes: np.ndarray, step: int) -> np.ndarray:
    """Hashes of stretches twice as long. What reaches beyond the end is unlike everything."""
    after = np.arange(len(hashes), dtype=np.uint64) + np.uint64(1 << 62)
    after[:len(hashes) - step] = hashes[step:]
    return mixed(hashes, after)


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values from a place on; beyond the end there is nothing smaller."""
    blocks = -(-len(values) // width) + 1
    padded = np.full(blocks * width, DONE)
    padded[:len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:len(values)], ahead[width - 1:width - 1 + len(values)])


def agreeing(words: np.ndarray, a: int, b: int, back: bool) -> int:
    """How many words from ``a`` and ``b`` (``a < b``) on, or before them, are equal."""
    room = a if back else len(words) - b
    done, size = 0, 32
    while done < room:
        size = min(size, room - done)
        if back:
            same = words[a - done - size:a - done][::-1] == words[b - done - size:b - done][::-1]
        else:
            same = words[a + done:a + done + size] == words[b + done:b + done + size]
        first = int(same.argmin())
        if not same[first]:
            return done + first
        done, size = done + size, 4 * size
    return room


class Found:
    """Maximal stretches with their least period, which comes first as periods are searched in rising order."""

    def __init__(self) -> None:
        self.rows: list[tuple[int, int, int]] = []  # start, end, period
        self.seen: set[tuple[int, int]] = set()

    def add(self, start: int, end: int, period: int) -> None:
        if (start, end) not in self.seen:
            self.seen.add((start, end))
            self.rows.append((start, end, period))

    def periodic(self, size: int, longest: int, least: int) -> np.ndarray:
        """Places from which ``least`` words have a period of at most ``longest``."""
        marks = np.zeros(size + 1, np.int32)
        for start, end, period in self.rows:
            if period <= longest and start < size and end - start >= least:
                marks[start] += 1
                marks[min(size, end - least + 1)] -= 1
        return marks[:size].cumsum() > 0


def direct(words: np.ndarray, period: int, found: Found) -> None:
    same = np.zeros(len(words) + 1, np.int8)
    same[1:len(words) - period + 1] = words[period:] == words[:-period]
    turns = np.flatnonzero(np.diff(same))
    for start, end in zip(turns[::2].tolist(), turns[1::2].tolist()):
        if end - start >= period:
            found.add(start, end + period, period)


def proposals(words: np.ndarray, hashes: dict[int, np.ndarray], scale: int, found: Found) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods of equal contexts at chosen places, but those whose stretch is surely too short."""
    size = len(words)
    own = hashes[scale][:size].copy()
    own[own == DONE] = 0
    own[found.periodic(size, scale // 3, scale)] = DONE
    least = window_minimum(own, scale + 1)
    later = np.full(size, DONE)
    later[:size - scale] = own[scale:]
    chosen = np.flatnonzero(((least == own) | (least == later)) & (least != DONE))
    context = hashes[2 * scale][:size][chosen]
    order = np.argsort(context, kind="stable")
    context, chosen = context[order], chosen[order]
    places, periods, lag = [], [], 1
    alive = np.arange(len(chosen))
    while True:
        alive = alive[alive < len(chosen) - lag]
        apart = chosen[alive + lag] - chosen[alive]
        fine = (context[alive + lag] == context[alive]) & (apart < 6 * scale)
        alive, apart = alive[fine], apart[fine]
        if not len(alive):
            break
        wide = apart >= 3 * scale
        places.append(chosen[alive[wide]])
        periods.append(apart[wide])
        lag += 1
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at, period = np.concatenate(places), np.concatenate(periods)
    # Equal words on either side, counted in steps of the scale and smaller ones; what is left is below the smallest step.
    ahead, behind = np.full(len(at), 2 * scale), np.zeros(len(at), np.int64)
    step = scale
    smallest = max(1, scale // 4)
    while step >= smallest:
        have = hashes[step]
        for _ in range(4 if step == scale else 1):
            a, b = at + ahead, at + period + ahead
            ok = b < size
            ok[ok] = have[a[ok]] == have[b[ok]]
            ahead += np.where(ok, step, 0)
            a, b = at - behind - step, at + period - behind - step
            ok = a >= 0
            ok[ok] = have[a[ok]] == have[b[ok]]
            behind += np.where(ok, step, 0)
        step //= 2
    enough = ahead + behind + 2 * (smallest - 1) >= period
    return at[enough], period[enough]


def stretched(words: np.ndarray, at: np.ndarray, period: np.ndarray, found: Found) -> None:
    """Add the maximal stretch around each place, if it is twice its period long."""
    order = np.lexsort((at, period))
    known_period, known_end = 0, -1
    for i, p in zip(at[order].tolist(), period[order].tolist()):
        if p == known_period and i + p < known_end:
            continue
        start = i - agreeing(words, i, i + p, True)
        end = i + p + agreeing(words, i, i + p, False)
        known_period, known_end = p, end
        if end - start >= 2 * p:
            found.add(start, end, p)


def phase(words: np.ndarray, one: tuple[int, int, int], other: tuple[int, int, int]) -> int | None:
    """By how much a root of the first run lies before an equal one of the second, within one period."""
    period = one[2]
    root = words[other[0]:other[0] + period]
    twice = words[one[0]:one[0] + 2 * period]
    for d in np.flatnonzero(twice[:period] == root[0]).tolist():
        if (twice[d:d + period] == root).all():
            return (other[0] - one[0] - d) % period
    return None


def across(words: np.ndarray, fresh: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Places and periods of runs that may lie across two neighbouring runs of one smaller period."""
    by_period = defaultdict(list)
    for run in fresh:
        if run[1] - run[0] >= 9 * run[2]:
            by_period[run[2]].append(run)
    for short, runs in by_period.items():
        runs.sort()
        for one, other in zip(runs, runs[1:]):
            (a0, a1, _), (b0, b1, _) = one, other
            if b0 > a1:
                continue
            shift = phase(words, one, other)
            if shift is None:
                continue
            first = shift if shift >= 9 * short else shift + -(-(9 * short - shift) // short) * short
            for p in range(first, min(a1 - a0, b1 - b0) + short, short):
                begin, end = max(a0, b0 - p), min(a1, b1 - p)
                # Here the words p apart are equal, and no farther unless both runs break at once.
                if end > begin and (end - begin >= p or p in (b0 - a0, b1 - a1)):
                    yield begin, p


def runs_of(words: np.ndarray, longest: int | list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """``start, end, period`` of all maximal runs of at least two periods, of any length.

    ``longest``: the longest text's length, or (length, words up to the end of the last text of that length or more)
    in falling order of lengths.
    """
    sizes = [(longest, len(words))] if isinstance(longest, int) else longest
    found = Found()
    for period in (1, 2):
        if len(words) > period:
            direct(words, period, found)
    pending: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by scale
    used, scale = 0, 1
    with np.errstate(over="ignore"):
        hashes = {1: mixed(words.astype(np.uint64), np.uint64(7))}
        while reach := max((end for length, end in sizes if length >= 6 * scale), default=0):
            hashes = {step: hashes[step][:reach] for step in (scale // 4, scale // 2, scale) if step in hashes}
            hashes[2 * scale] = joined(hashes[scale], scale)
            at, period = proposals(words[:reach], hashes, scale, found)
            more = np.array([x for x in pending.pop(scale, []) if sum(x) < reach], np.int64).reshape(-1, 2)
            stretched(words[:reach], np.concatenate([at, more[:, 0]]), np.concatenate([period, more[:, 1]]), found)
            for begin, p in across(words, found.rows[used:]):
                pending[1 << ((p // 3).bit_length() - 1)].append((begin, p))
            used = len(found.rows)
            scale *= 2
    return found.rows


def texts_runs(texts: list[list[str]]) -> list[list[tuple[int, int, int]]]:
    """``start, length, period`` of the runs of each text, all texts at once."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    numbers: dict[str, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    total = sum(map(len, texts)) + len(texts)
    words = np.empty(total, np.int64)
    starts, sizes, at = [], [], 0
    for k in order:
        size = len(texts[k])
        words[at:at + size] = np.fromiter(map(numbers.__getitem__, texts[k]), np.int64, size)
        words[at + size] = -1 - k  # unlike every word and every other end
        starts.append(at)
        at += size + 1
        sizes.append((size, at))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not sizes or sizes[0][0] < 2:
        return out
    rows = [r for r in runs_of(words, sizes) if r[1] - r[0] >= max(LEAST_LENGTH, LEAST_REPEATS * r[2])]
    for (start, end, period), place in zip(rows, np.searchsorted(starts, [r[0] for r in rows], side="right") - 1):
        out[order[place]].append((start - starts[place], end - start, period))
    for own in out:
        own.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    marks = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        marks[start + period] += 1
        marks[start + length] -= 1
    return [words[k] for k in np.flatnonzero(marks[:-1].cumsum() == 0)]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change: Change | None = None) -> DataFrame:
    """``id_col, n_words, runs, collapsed`` of every row: all maximal runs by start and period, and the text with each
    run cut to its first period, its words joined by single blanks.

    Words are what blanks, tabs and line ends separate. ``change(id, words)`` may alter the words before they are searched. A
    run is a stretch of words with least period ``q``, at least ``max(12, 2 q)`` long, that no neighbouring word
    extends. A null or empty text has no words and no runs; a null id is an id. Rows are searched on their own, so
    repeated rows come back each, and texts of any length are searched whole. Other columns are ignored; an
    empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = WORD.findall(text.as_py() or "")
                words = change(key, words) if change else words
                if ids and held + len(words) > BATCH_WORDS:
                    yield searched(ids, texts, batch.schema.field(0).type)
                    ids, texts, held = [], [], 0
                ids.append(key)
                texts.append(words)
                held += len(words)
            if ids:
                yield searched(ids, texts, batch.schema.field(0).type)

    def searched(ids: list, texts: list[list[str]], kind: pa.DataType) -> pa.RecordBatch:
        runs = texts_runs(texts)
        shown = [[{"start": s, "length": n, "period": p} for s, n, p in own] for own in runs]
        row = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, kind), pa.array(list(map(len, texts)), pa.int64()), pa.array(shown, row),
             pa.array([" ".join(collapsed(words, own)) for words, own in zip(texts, runs)], pa.string())],
            names=[id_col, "n_words", "runs", "collapsed"])

    given = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, schema_like(given, {id_col: id_col}, [("n_words", "bigint"), ("runs", RUNS), ("collapsed", "string")]))
