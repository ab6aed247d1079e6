"""Sampled segmentations of a SentencePiece vocabulary, and decoding.

All segmentations of a text form a lattice; each has a probability by its pieces.
Gumbel noise on their logs turns the ``k`` largest into a sample without
replacement. They are found best first without listing the rest: a partial
segmentation stands for all that begin with it, its noise is the maximum of
theirs, and noise for its continuations is drawn under that maximum.

No piece reaches across a blank, so the lattice is a chain of words' lattices,
which are kept from text to text.
"""

from __future__ import annotations

import bisect
import math
import random
import re
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlwarden.llm.common import schema_like, worker_store

SAMPLES = 3
BLANK = "▁"
WORDS = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
BYTE_LOG = -12.0  # natural log weight of each byte of a character that no piece has
KEPT_WORDS = 60_000  # a word's lattice takes about two kilobytes

Edges = list[tuple[int, tuple[int, ...], float]]


class Pieces:
    """Pieces with weights by Zipf's law over the merges' order, which the vocabulary's scores tell."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.texts = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        plain = [k for k in range(len(self.texts)) if not (self.model.is_byte(k) or self.model.is_control(k) or self.model.is_unknown(k))]
        self.bytes = {int(self.texts[k][3:5], 16): k for k in range(len(self.texts)) if self.model.is_byte(k)}
        self.values = {k: value for value, k in self.bytes.items()}
        # The ids as tuples, one for all lattices that have the piece.
        self.weights = {self.texts[k]: ((k,), -math.log(2 - self.model.get_score(k))) for k in plain}
        self.beginnings = {text[:k] for text in self.weights for k in range(1, len(text) + 1)}
        self.known: dict[str, list[Edges]] = {}

    def lattice(self, word: str) -> list[Edges]:
        """For each place: where a piece may end, its ids, and the log of its share of what may follow."""
        size, weights, beginnings = len(word), self.weights, self.beginnings
        below = [0.0] * (size + 1)  # log of the summed weights of all segmentations from a place on
        out: list[Edges] = [[] for _ in range(size)]
        for at in range(size - 1, -1, -1):
            found = []
            for end in range(at + 1, size + 1):
                part = word[at:end]
                if entry := weights.get(part):
                    found.append((end, entry[0], entry[1] + below[end]))
                elif end == at + 1:
                    raw = part.encode("utf-8", "replace")
                    found.append((end, tuple(self.bytes[b] for b in raw), BYTE_LOG * len(raw) + below[end]))
                if part not in beginnings:
                    break
            if len(found) == 1:
                below[at], out[at] = found[0][2], [(*found[0][:2], 0.0)]
                continue
            top = max(w for _, _, w in found)
            below[at] = top + math.log(sum(math.exp(w - top) for _, _, w in found))
            out[at] = [(end, ids, w - below[at]) for end, ids, w in found]
        return out

    def lattices(self, text: str) -> list[list[Edges]]:
        words = WORDS.findall(self.model.normalize(text))
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        known = self.known
        out = []
        for word in words:
            found = known.get(word)
            if found is None:
                found = known[word] = self.lattice(word)
            out.append(found)
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """The text of the pieces: blanks for their marks, without the one that the model sets before a text."""
        parts: list[bytes] = []
        for k in ids:
            value = self.values.get(k)
            parts.append(self.texts[k].replace(BLANK, " ").encode() if value is None else bytes((value,)))
        text = b"".join(parts).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def pieces(path: str) -> Pieces:
    """One for each vocabulary and Python worker."""
    kept = worker_store()
    if path not in kept:
        kept[path] = Pieces(path)
    return kept[path]


def sampled(words: list[list[Edges]], count: int, draw: random.Random) -> list[tuple[float, float, list[int]]]:
    """(log probability, noisy log probability, ids) of the ``count`` best by noise, best first; fewer if there are no more."""
    log, exp, log1p, uniform = math.log, math.exp, math.log1p, draw.random
    root = -log(-log(uniform() or 5e-324))
    waiting: list[tuple] = [(-root, 0, 0, 0, 0.0, None)]  # best first, as many as can still be found
    found: list[tuple[float, float, list[int]]] = []
    number = 0
    while waiting and len(found) < count:
        noisy, _, word, at, total, path = waiting.pop(0)
        room = count - len(found) - 1
        del waiting[room:]
        noisy = -noisy
        while True:
            if word < len(words) and at == len(words[word]):
                word, at = word + 1, 0
            if word == len(words):
                ids: list[tuple[int, ...]] = []
                while path:
                    path, some = path
                    ids.append(some)
                found.append((total, noisy, [k for some in reversed(ids) for k in some]))
                break
            edges = words[word][at]
            if len(edges) == 1:
                at, ids_, _ = edges[0]
                path = path, ids_
                continue
            draws = [total + share - log(-log(uniform() or 5e-324)) for _, _, share in edges]
            top = max(draws)
            chosen = draws.index(top)
            for k, (end, ids_, share) in enumerate(edges):
                if k != chosen and room:
                    # The draw moved to where it stands if the largest of all is `noisy`.
                    gap = exp(draws[k] - top)
                    under = noisy - draws[k] + (log1p(-gap) if gap < 1 else -math.inf)
                    moved = noisy - max(0.0, under) - (log1p(exp(-abs(under))) if under > -math.inf else 0.0)
                    number += 1
                    if len(waiting) < room or -moved < waiting[-1][0]:
                        bisect.insort(waiting, (-moved, number, word, end, total + share, (path, ids_)))
                        del waiting[room:]
            at, ids_, share = edges[chosen]
            total += share
            path = path, ids_
    return found


def sample_segmentations(
    rows: DataFrame, vocabulary: str, key_cols: Sequence[str], text_col: str = "text", count: int = SAMPLES, seed: int = 42,
) -> DataFrame:
    """``key_cols, sample, ids, log_probability, noisy, inclusion``: up to ``count`` distinct segmentations of each text.

    ``sample`` counts from 1. ``log_probability`` is the natural log of the
    segmentation's share among all of its text. ``inclusion`` is the probability
    that it is among the sample, given the noise of the first one left out; it is 1
    if none is left out. The noise depends on the seed and the key alone, so rows
    of one key and text get equal samples. Null and empty texts have one empty
    segmentation. No rows give no rows; other columns are not looked at.
    """
    wanted = rows.select(*(F.col(c).alias(f"key{k}") for k, c in enumerate(key_cols)), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = schema_like(wanted, {c: f"key{k}" for k, c in enumerate(key_cols)}, [
        ("sample", "int"), ("ids", "array<int>"), ("log_probability", "double"), ("noisy", "double"), ("inclusion", "double")])
    width = len(key_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary_ = pieces(vocabulary)
        for whole in batches:
            for first in range(0, whole.num_rows, 500):
                batch = whole.slice(first, 500)
                keys = list(zip(*(batch.column(k).to_pylist() for k in range(width))))
                out: list[tuple] = []
                for row, text in enumerate(batch.column(width).to_pylist()):
                    draw = random.Random(xxhash.xxh64_intdigest(f"{seed}|{keys[row]!r}"))
                    found = sampled(vocabulary_.lattices(text), count + 1, draw)
                    left_out = found[count][1] if len(found) > count else -math.inf
                    for k, (share, noisy, ids) in enumerate(found[:count]):
                        odds = math.exp(min(share - left_out, 700)) if left_out > -math.inf else math.inf
                        out.append((row, k + 1, ids, share, noisy, -math.expm1(-odds)))
                columns = list(zip(*out)) or [()] * 6
                place = pa.array(columns[0], pa.int64())
                kinds = (pa.int32(), pa.list_(pa.int32()), pa.float64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(place) for k in range(width)), *(pa.array(c, kind) for c, kind in zip(columns[1:], kinds))],
                    names=schema.fieldNames())

    return wanted.mapInArrow(run, schema)


def decoded(ids: Column, vocabulary: str) -> Column:
    """Texts of arrays of ids; null for null. U+2581 stands for blanks in the vocabulary and comes back as one."""
    @F.pandas_udf("string")
    def texts(column: pd.Series) -> pd.Series:
        own = pieces(vocabulary)
        return column.map(lambda some: None if some is None else own.decode(some))

    return texts(ids)
