"""Quality scores from random-indexing word vectors and a two-layer network.

Each token has an index vector: a few entries of +1 and -1 that follow from
its hash. A word's vector is the sum of the index vectors of its neighbours
over the whole corpus; words share ``BUCKETS`` rows by hash, so the table has
one size whatever the corpus. A document is the mean of its words' vectors and
of its tokens' index vectors, with its length, its share of new tokens and its
share of tokens that repeat the one before.

A network with one hidden layer is trained by numpy on ``TRAINING_ROWS``
labelled documents at most, those first in the order of a hash of ``doc_id``.
A tenth of them only sets the temperature that divides its output, so that
scores are calibrated. All else covers all rows.

Null and empty texts have zero vectors and get a score like any other. Rows
with a null ``doc_id`` are scored and count as not held out. Without labels of
both kinds, every score is the share of label 1, or 0.5 without labels.
Several labels of one document count as their mean.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.llm.common import map_arrow, only, query, scratch, staged, table, without
from rowferry.llm.words import Tokens, mixed

WIDTH = 64
ENTRIES = 4
WINDOW = 2
BUCKETS = 1 << 14
BLOCKS = 64
TRAINING_ROWS = 20_000
HIDDEN = 48
STEPS = 2_000
BATCH = 256

_CHUNK = 200_000
_FEATURES = 2 * WIDTH + 3


def entries(hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and signs of the entries of index vectors, one entry of all tokens at a time."""
    bits = mixed(hashes, 7)
    for number in range(ENTRIES):
        part = bits >> np.uint64(16 * number)
        yield (part & np.uint64(WIDTH - 1)).astype(np.int64), 1 - 2 * ((part >> np.uint64(8)) & np.uint64(1)).astype(np.int64)


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


def add_contexts(tokens: Tokens, sums: np.ndarray) -> None:
    """Add the index vectors of the neighbours of each token to its word's row."""
    hashes, rows = tokens.hashes, tokens.rows
    if not hashes.size:
        return
    document = np.repeat(np.arange(rows.size - 1), np.diff(rows))
    base, vectors = bucket(hashes) * WIDTH, list(entries(hashes))
    for step in range(1, WINDOW + 1):
        near = np.flatnonzero(document[step:] == document[:-step])
        for word, other in ((near, near + step), (near + step, near)):
            own = base[word]
            for place, sign in vectors:
                sums += np.bincount(own + place[other], sign[other], sums.size).astype(np.int64)


def word_vectors(docs: DataFrame, *, text_column: str = "text") -> np.ndarray:
    """The table of word vectors, of fixed size, from every text.

    Each task sums its own documents; the sums are added block by block as
    they arrive, so no task holds more than its blocks.
    """
    rows = BUCKETS // BLOCKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS * WIDTH, np.int64)
        for batch in batches:
            add_contexts(Tokens(batch.column(0)), sums)
        yield from _blocks({n: own for n, own in enumerate(sums.reshape(BLOCKS, -1)) if own.any()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = sums.setdefault(block, np.zeros(rows * WIDTH, np.int64))
                own += np.frombuffer(data, np.int64)
        yield from _blocks(sums)

    schema = "block int, sums binary"
    partial = only(docs, text_column).mapInArrow(count, schema)
    total = np.zeros((BLOCKS, rows * WIDTH))
    for row in partial.repartition("block").mapInArrow(add, schema).collect():
        total[row.block] = np.frombuffer(row.sums, np.int64)
    vectors = total.reshape(BUCKETS, WIDTH)
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, lengths, out=np.zeros_like(vectors), where=lengths > 0).astype(np.float32)


def _blocks(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for block, own in sums.items():
        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "sums": pa.array([own.tobytes()], pa.binary())})


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """The features of each text, a row each."""
    tokens = Tokens(column)
    counts = np.diff(tokens.rows)
    found = np.zeros((counts.size, _FEATURES), np.float32)
    document = np.repeat(np.arange(counts.size), counts)
    for start in range(0, tokens.hashes.size, _CHUNK):
        part = tokens.hashes[start:start + _CHUNK]
        own = document[start:start + _CHUNK]
        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        found[own[first], :WIDTH] += np.add.reduceat(vectors[bucket(part)], first)
    size = counts.size * WIDTH
    for place, sign in entries(tokens.hashes):
        found[:, WIDTH:2 * WIDTH] += np.bincount(document * WIDTH + place, sign, size).reshape(-1, WIDTH)
    found[:, :2 * WIDTH] /= np.maximum(counts, 1)[:, None]
    found[:, -2] = np.log1p(counts)
    again = np.flatnonzero((tokens.hashes[1:] == tokens.hashes[:-1]) & (document[1:] == document[:-1]))
    found[:, -3] = np.bincount(document[again], minlength=counts.size) / np.maximum(counts, 1)
    for row in range(counts.size):
        if counts[row]:
            found[row, -1] = np.unique(tokens.hashes[tokens.rows[row]:tokens.rows[row + 1]]).size / counts[row]
    return found


def features(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """``doc_id`` and ``features``, floats as bytes, of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def work(batch: pa.RecordBatch) -> dict:
        rows = pooled(batch.column(1), shared.value)
        return {"doc_id": batch.column(0), "features": pa.array([row.tobytes() for row in rows], pa.binary())}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(only(docs, "doc_id", "text"), work, f"doc_id {kind}, features binary")


class Network(NamedTuple):
    """Two layers, the scale of their input, and the temperature of their output."""

    mean: np.ndarray
    spread: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    bias: float
    temperature: float

    def logits(self, rows: np.ndarray) -> np.ndarray:
        hidden = np.tanh((rows - self.mean) / self.spread @ self.first + self.first_bias)
        return hidden @ self.second + self.bias

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(rows) / self.temperature)


def sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -60, 60)))


def train(rows: np.ndarray, labels: np.ndarray, seed: int = 5) -> Network:
    """Adam on the log loss, then the temperature on the rows kept aside."""
    width = rows.shape[1] if rows.ndim == 2 else _FEATURES
    share = float(labels.mean()) if labels.size else 0.5
    if not labels.size or not 0 < share < 1:
        flat = np.clip(share, 1e-6, 1 - 1e-6)
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(flat / (1 - flat))), 1.0)
    random = np.random.default_rng(seed)
    order = random.permutation(labels.size)
    aside, used = order[:labels.size // 10], order[labels.size // 10:]
    mean, spread = rows[used].mean(0), rows[used].std(0) + 1e-6
    x, y = (rows[used] - mean) / spread, labels[used]
    own = [
        random.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN),
        random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1),
    ]
    drift, force = [np.zeros_like(w) for w in own], [np.zeros_like(w) for w in own]
    for step in range(1, STEPS + 1):
        at = random.integers(0, y.size, BATCH)
        hidden = np.tanh(x[at] @ own[0] + own[1])
        error = (sigmoid(hidden @ own[2] + own[3]) - y[at]) / at.size
        back = np.outer(error, own[2]) * (1 - hidden ** 2)
        slopes = [x[at].T @ back + 1e-4 * own[0], back.sum(0), hidden.T @ error + 1e-4 * own[2], error.sum(keepdims=True)]
        for w, g, d, f in zip(own, slopes, drift, force):
            d *= 0.9
            d += 0.1 * g
            f *= 0.999
            f += 0.001 * g * g
            w -= 0.003 * (d / (1 - 0.9 ** step)) / (np.sqrt(f / (1 - 0.999 ** step)) + 1e-8)
    plain = Network(mean, spread, own[0], own[1], own[2], float(own[3][0]), 1.0)
    return plain._replace(temperature=best_temperature(plain.logits(rows[aside]), labels[aside]))


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of least log loss, from a fixed grid."""
    if not labels.size:
        return 1.0
    grid = np.geomspace(0.5, 8, 65)
    losses = []
    for t in grid:
        p = np.clip(sigmoid(logits / t), 1e-9, 1 - 1e-9)
        losses.append(-(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean())
    return float(grid[int(np.argmin(losses))])


def held_out(doc_id: str = "doc_id"):
    """Whether a row must not be learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, *, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Labels of documents that are held out are never read into the training rows.
    """
    docs = only(docs, "doc_id", "text")
    made = staged(features(docs, word_vectors(docs)), "features")
    known = (
        labels.select(F.col("doc_id"), F.col("quality")).where("doc_id is not null and quality is not null")
        .where(~held_out()).groupBy("doc_id").agg(F.avg("quality").alias("label"))
    )
    sample = (
        made.join(known, "doc_id").select("features", "label", F.xxhash64("doc_id").alias("place"), "doc_id")
        .orderBy("place", "doc_id", "features").limit(training_rows).collect()
    )
    rows = np.array([np.frombuffer(row.features, np.float32) for row in sample], np.float64)
    network = train(rows, np.array([row.label for row in sample], np.float64))
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def work(batch: pa.RecordBatch) -> dict:
        data = b"".join(batch.column(1).to_pylist())
        scores = shared.value.scores(np.frombuffer(data, np.float32).reshape(-1, _FEATURES).astype(np.float64))
        return {"doc_id": batch.column(0), "score": pa.array(scores, pa.float64())}

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = map_arrow(made, work, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents predicted as label 0; same columns.

    Rows without id stay; rows that repeat an id go only if all are rejected.
    """
    with scratch() as keep:
        scored = score_documents(docs, labels).where("doc_id is not null")
        gone = scored.groupBy("doc_id").agg(F.max("predicted").alias("best")).where("best = 0").select("doc_id")
        gone = keep(staged(gone, "rejected"))
    return without(docs, gone)


@query("op3_quality")
def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    return score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))
