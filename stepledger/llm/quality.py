"""Quality classifier: supervised subword embeddings.

Every word stands for itself and for its character n-grams; each of them is
hashed to a learned vector, a document is the average of all its vectors, and
a softmax over two classes follows. Training is plain stochastic gradient
descent in numpy on a bounded sample of labelled rows (``max_rows``, half of
it for each class, picked by a hash of doc_id). A word that repeats the word
before it adds a marker token. Because average and output layer are linear,
scoring needs one number for each bucket.

Defined results: null and empty texts have no vectors and score what the
bias gives; rows with a null doc_id are scored, are not held out and are never
learned from; a doc_id with several labels counts with the lowest; without
labels of both classes every score is 0.5; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from itertools import islice
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepledger.llm._shared import hash_share, slices

BUCKETS, DIM, GRAMS = 1 << 14, 8, (3, 4)
MAX_ROWS, EPOCHS, RATE, SEED = 2_000, 12, 0.5, 17
THRESHOLD = 0.3
#: Words whose sums a worker remembers at once.
CACHE = 200_000
#: The marker of a repeated word; no word has a space.
AGAIN = " again"


def word_buckets(word: str) -> list[int]:
    """Buckets of a word and of its character n-grams, ends marked."""
    raw = f"<{word}>"
    grams = [raw[i : i + n] for n in GRAMS for i in range(len(raw) - n + 1)]
    return [crc32(g.encode()) % BUCKETS for g in [raw + " ", *grams]]


def word_counts(text: str | None) -> Counter:
    """How often each word is in a text, and how often one repeats the word before it."""
    words = (text or "").split()
    counts = Counter(words)
    if again := sum(map(eq, words, islice(words, 1, None))):
        counts[AGAIN] = again
    return counts


def document_vector(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text and their shares, which add up to 1."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for word, n in word_counts(text).items():
        np.add.at(total, word_buckets(word), n)
    ids = np.flatnonzero(total)
    return ids.astype("<u2"), (total[ids] / max(1, total.sum())).astype("<f4")


def train(rows: Iterable[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, float]:
    """For each bucket its part in the log odds of label 1, and the bias."""
    rows = list(rows)
    if len({y for y, _, _ in rows}) < 2:
        return np.zeros(BUCKETS), 0.0
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    out, bias = np.zeros((DIM, 2)), np.zeros(2)
    steps, step = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            y, ids, shares = rows[i]
            rate = RATE * (1 - step / steps)
            step += 1
            mean = shares @ vectors[ids]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            grad = out @ p
            out -= rate * np.outer(mean, p)
            bias -= rate * p
            # an average of many vectors moves each of them little; the rate is that of the mean
            vectors[ids] -= rate * np.outer(shares / max(1e-12, shares @ shares), grad) * 0.1
    return vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0])


def held_out(doc_id) -> F.Column:
    """Whether a row is kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, float]:
    """Learn from at most ``max_rows`` labelled rows that are not held out.

    The sampled ids are at most ``max_rows``, so the join that fetches their
    texts sends them to every executor and moves no text; a sampled text comes
    to the driver as at most ``BUCKETS`` numbers.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    # about twice as many as are wanted by their hash, so that no task sends more than its part of them
    picked = [known.where((F.col("y") == y) & hash_share(F.col("doc_id"), max_rows, sizes.get(y, 0))).orderBy(*order).limit(max_rows // 2) for y in (0, 1)]
    wanted = picked[0].unionByName(picked[1])

    def run(batches):
        for batch in slices(batches):
            found = [document_vector(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([i.tobytes() for i, _ in found], pa.binary()), pa.array([s.tobytes() for _, s in found], pa.binary())],
                names=["doc_id", "y", "ids", "shares"],
            )

    sample = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(wanted), "doc_id")
        .select("doc_id", "y", "text")
        .mapInArrow(run, "doc_id long, y int, ids binary, shares binary")
        .orderBy(*order, "ids", "shares")
        .limit(max_rows)
        .collect()
    )
    return train((r["y"], np.frombuffer(r["ids"], "<u2"), np.frombuffer(r["shares"], "<f4").astype(float)) for r in sample)


def scorer(weights: np.ndarray, bias: float):
    """A function from a text to the probability of label 1."""
    cache: dict[str, tuple[float, int]] = {}
    part = weights.tolist().__getitem__

    def look_up(word: str) -> tuple[float, int]:
        ids = word_buckets(word)
        if len(cache) >= CACHE:
            cache.clear()
        cache[word] = found = (sum(map(part, ids)), len(ids))
        return found

    def score(text: str | None) -> float:
        total = size = 0.0
        for word, n in word_counts(text).items():
            s, k = cache.get(word) or look_up(word)
            total += n * s
            size += n * k
        return float(1 / (1 + np.exp(-(total / max(size, 1.0) + bias))))

    return score


def score(docs: DataFrame, weights: np.ndarray, bias: float, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""

    def run(batches):
        of = scorer(weights, bias)
        for batch in slices(batches):
            got = pa.array([of(t) for t in batch.column(2).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), got], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep(docs: DataFrame, weights: np.ndarray, bias: float, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of documents that the model accepts, with all their columns."""
    at = docs.columns.index("text")

    def run(batches):
        of = scorer(weights, bias)
        for batch in slices(batches):
            good = pa.array([of(t) >= threshold for t in batch.column(at).to_pylist()], pa.bool_())
            yield batch.filter(good)

    return docs.mapInArrow(run, docs.schema)
