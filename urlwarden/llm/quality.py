"""Quality classifier on averaged subword embeddings.

Byte n-grams, words, word pairs and marks for immediate repeats are hashed into
buckets. Each bucket has a learned vector; a document is the mean of the vectors
of all that it holds, and a softmax over it gives the score. Training is
stochastic gradient descent in numpy on a bounded sample of labelled documents,
``SAMPLE`` of them, whose hashed counts (never more than ``BUCKETS`` a document)
are made on the executors. Scoring needs no join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlwarden.llm.common import in_one_task

BUCKETS = 1 << 16
DIMENSIONS = 16
SAMPLE = 4000
STEPS = 36_000  # examples seen in training, whatever the sample's size
RATE = 0.4
THRESHOLD = 0.3
GRAMS = (1, 2, 3)
BLOCK = 1 << 20  # bytes hashed at a time
PLACES = np.random.default_rng(7).integers(1, 1 << 32, 256, dtype=np.uint32) | np.uint32(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Upper bits of a multiplied hash, as bucket numbers."""
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    h = h ^ (h >> np.uint32(15))
    return (h * np.uint32(2654435761)) >> shift


def word_hashes(raw: np.ndarray) -> np.ndarray:
    """One number per run of bytes above 32."""
    inside = raw > 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint32)
    spots = np.flatnonzero(inside)
    place = spots - np.repeat(starts, ends - starts)
    parts = (raw[spots].astype(np.uint32) + np.uint32(1)) * PLACES[place & 255]
    sizes = ends - starts
    firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return np.add.reduceat(parts, firsts, dtype=np.uint32) + sizes.astype(np.uint32) * np.uint32(40503)


def features(text: bytes) -> list[np.ndarray]:
    """Bucket numbers, repeats included. Blocks overlap by what an n-gram needs; words split at a block's end."""
    found = []
    raw = np.frombuffer(text, np.uint8)
    reach = max(GRAMS) - 1
    for at in range(0, len(raw), BLOCK):
        some = raw[at:at + BLOCK + reach].astype(np.uint32)
        own = min(BLOCK, len(raw) - at)
        h = np.zeros(len(some), np.uint32)
        for n in range(1, max(GRAMS) + 1):
            h = h[:len(some) - n + 1] * np.uint32(16777619) + some[n - 1:]
            if n in GRAMS:
                found.append(mixed(h[:own] + np.uint32(n * 668265263 & 0xFFFFFFFF)))
        words = word_hashes(raw[at:at + BLOCK])
        if len(words):
            pairs = words[:-1] * np.uint32(31) + words[1:] * np.uint32(17)
            found.append(mixed(words))
            found.append(mixed(pairs + np.uint32(97)))
            repeats = int((words[:-1] == words[1:]).sum())
            found.append(np.full(8 * repeats, BUCKETS - 1, np.uint32))
    return found


def counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    parts = features(text)
    if not parts:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    total = sum(np.bincount(p, minlength=BUCKETS) for p in parts)
    ids = np.flatnonzero(total)
    return ids.astype(np.int32), total[ids].astype(np.float32)


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """``id, label, ids, counts`` of at most ``rows`` labelled documents, chosen by a hash of the id."""
    marked = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("id", F.lit("sample")), "id").limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    joined = texts.join(F.broadcast(marked), "id").select("id", "label", "text")  # `rows` bounds it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [counts(text.as_py() or b"") for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.int32()),
                 pa.array([p[0].tobytes() for p in pairs], pa.binary()), pa.array([p[1].tobytes() for p in pairs], pa.binary())],
                names=["id", "label", "ids", "counts"])

    return joined.mapInArrow(run, "id bigint, label int, ids binary, counts binary")


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 11) -> tuple[np.ndarray, float]:
    """Vectors and softmax by stochastic gradient descent, folded into one weight per bucket and a bias.

    The mean of vectors followed by a linear softmax is linear in the buckets'
    shares, so a score needs no more than those. Without examples all is zero.
    """
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    output = np.zeros((2, DIMENSIONS), np.float32)
    bias = np.zeros(2, np.float32)
    steps = np.full((BUCKETS, 1), 1e-8, np.float32)
    done = 0
    while bags and done < STEPS:
        for k in random.permutation(len(bags))[:STEPS - done]:
            ids, weights = bags[k]
            rate = RATE * (1 - done / STEPS)
            done += 1
            own = vectors[ids]
            hidden = weights @ own
            logits = output @ hidden + bias
            soft = np.exp(logits - logits.max())
            soft /= soft.sum()
            soft[labels[k]] -= 1
            back = soft @ output
            output -= rate * np.outer(soft, hidden)
            bias -= 0.1 * rate * soft
            steps[ids, 0] += (weights * weights) * float(back @ back) * 1e4
            vectors[ids] = own - rate * np.outer(weights, back) / np.sqrt(steps[ids] + 1e-4) * 10
    side = output[1] - output[0]
    return vectors.astype(np.float64) @ side, float(bias[1] - bias[0])


class Classifier:
    """One weight per bucket and a bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def logit(self, text: bytes) -> float:
        parts = features(text)
        size = sum(map(len, parts))
        return self.bias + (sum(float(self.weights[p].sum()) for p in parts) / size if size else 0.0)

    def column(self, text: Column) -> Column:
        """Score of a text column, 0 to 1."""
        weights, bias, spread = self.weights, self.bias, Classifier

        @F.pandas_udf("double")
        def score(texts: pd.Series) -> pd.Series:
            model = spread(weights, bias)
            logits = np.array([model.logit(t or b"") for t in texts], dtype=np.float64)
            return pd.Series(1 / (1 + np.exp(-np.clip(logits, -700, 700))))

        return score(text.cast("string").cast("binary"))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = SAMPLE,
) -> Classifier:
    """Learn from ``labels`` (0 or 1; others and nulls are left out; of several for an id the largest counts).

    Ids, languages and sources are no inputs. Without labelled documents every score is 0.5.
    """
    bags = sample(docs, labels, id_col, text_col, label_col, rows).toPandas().sort_values("id")
    pairs = [(np.frombuffer(i, np.int32), np.frombuffer(c, np.float32)) for i, c in zip(bags["ids"], bags["counts"])]
    shares = [(i, c / max(1.0, float(c.sum()))) for i, c in pairs]
    known = bags["label"].to_numpy()
    return Classifier(*in_one_task(docs.sparkSession, lambda: train(shares, known)))


def scored(docs: DataFrame, model: Classifier, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns of ``docs``, and ``score, predicted`` (1 from ``threshold`` on).

    Null and empty texts get the score of the bias alone. Existing columns of
    these names are replaced.
    """
    return docs.withColumn("score", model.column(F.col(text_col))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
