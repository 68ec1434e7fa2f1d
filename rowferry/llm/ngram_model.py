"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

1. Tokens of the training texts are counted exactly, by one shuffle of 64-bit
   word hashes, pre-aggregated in each Arrow batch.
2. Pairs of neighbouring tokens are counted the same way, packed into one row
   for each batch and shard. Shards grow in number with the corpus, so each is
   of bounded size, and each task turns its shard into a segment of the filter:
   a pair of quantised count ``q`` is stored as ``q`` items, (pair, 1) to
   (pair, q). Single tokens have a filter of their own, made the same way.
3. Scoring asks for (pair, 1), (pair, 2) and so on until the first miss. The
   count found is smoothed with that of the token alone::

       P(w | v) = (c(v w) + PRIOR * P(w)) / (c(v) + PRIOR),  P(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1))

Segments are sent to the workers in slices of at most ``SLICE_BYTES``, and so
is the table of exact counts behind ``base_score``, in slices of
``SLICE_WORDS``. A pair and a word belong to one slice each, so the scores of
a text are sums over passes, one for each slice; the driver holds one slice at
a time. A corpus of any size goes whole into the filter and needs as many
passes as it has slices. The filter of single tokens has at most
``SLICE_BYTES``; beyond some 100 million distinct words it gets fewer bits for
each item, and more counts read too high.

``BITS`` bits and ``PROBES`` probes for each item let 2.4 % of absent items
pass. A count is never read too low, save for the rounding of its quantum.

A text's first token follows a start mark, its last is an end mark. Null text
counts as empty: an end mark. Rows that repeat id and text count, and are
returned, as often as they are there. A null ``doc_id`` trains and is not held
out. Without training texts all tokens are equally unknown. Words are told
apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.llm.common import map_arrow, only, query, staged, table
from rowferry.llm.words import Words, mixed

FOLDS, HELD_OUT = 5, 1
BASE = 1.5
BITS, PROBES = 8, 4
PRIOR = 200.0
SHARD_TOKENS = 2_000_000
SLICE_BYTES = 96 << 20
SLICE_WORDS = 4_000_000
FETCHES = 8

START, END = np.uint64(0x5B8D3C9F1A7E2460), np.uint64(0xC3A1F0E5D7926B48)
_PAIR = np.uint64(0xA24BAED4963EE407)
# Bits of a hash that tell the items of one shard apart; the shard is told by the highest.
_KEY_BYTES = 6
_KEY = np.uint64((1 << 8 * _KEY_BYTES) - 1)
_HIGH, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)


def _quanta() -> np.ndarray:
    """The least count of each quantum: powers of ``BASE``, rounded up, each once."""
    found, power = [], 1.0
    while power < 2.0 ** 62:
        if not found or np.ceil(power) > found[-1]:
            found.append(np.ceil(power))
        power *= BASE
    return np.array(found)


QUANTA = _quanta()
# The count that a quantum stands for: the middle of those it holds; none for quantum 0.
MIDDLES = np.concatenate(([0.0], (QUANTA[:-1] + QUANTA[1:] - 1) / 2, [QUANTA[-1]]))


def quantum(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(QUANTA, counts, "right")


def tokens_of(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of a batch with an end mark after each text, those before them, and where texts begin."""
    texts = words.rows.size - 1
    tokens = np.insert(words.hashes, words.rows[1:], END)
    starts = words.rows[:-1] + np.arange(texts)
    before = np.roll(tokens, 1)
    before[starts] = START
    return tokens, before, starts


def pairs_of(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mixed(before * _PAIR + tokens)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards are even ranges of the hashes, so ascending hashes have ascending shards."""
    return ((hashes >> _HIGH) * np.uint64(shards) >> _HIGH).astype(np.int64)


def places(keys: np.ndarray, item: int, bits: np.ndarray | int) -> Iterator[np.ndarray]:
    """Bit positions of item number ``item`` of each key, in a segment of ``bits`` bits."""
    hashes = mixed(keys, item)
    first, step = hashes >> _HIGH, (hashes & _LOW) | np.uint64(1)
    for _ in range(PROBES):
        yield first % np.asarray(bits, np.uint64)
        first = first + step


def packed(hashes: np.ndarray, counts: np.ndarray, shards: int) -> dict:
    """Ascending hashes and their counts, a row for each shard."""
    own = shard_of(hashes, shards)
    at = np.flatnonzero(np.diff(own, prepend=-1))
    bounds = np.append(at, hashes.size)
    keys = np.ascontiguousarray((hashes & _KEY).view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES])
    amounts = counts.astype("<u4")
    return {
        "shard": pa.array(own[at], pa.int32()),
        "keys": pa.array([keys[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
        "counts": pa.array([amounts[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
    }


PACKED = "shard int, keys binary, counts binary"


def merged(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a shard's rows and the sums of their counts."""
    raw = np.frombuffer(b"".join(part["keys"].to_pylist()), np.uint8).reshape(-1, _KEY_BYTES)
    keys = np.zeros((len(raw), 8), np.uint8)
    keys[:, :_KEY_BYTES] = raw
    keys = keys.view(np.uint64).ravel()
    counts = np.frombuffer(b"".join(part["counts"].to_pylist()), "<u4").astype(np.int64)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def segment(keys: np.ndarray, counts: np.ndarray, bits_each: float) -> tuple[int, bytes]:
    """The bits of a filter segment that holds each key with its quantised count."""
    quanta = quantum(counts)
    bits = max(64, int(quanta.sum() * bits_each))
    marked = np.zeros(bits, bool)
    for item in range(1, int(quanta.max()) + 1):
        for place in places(keys[quanta >= item], item, bits):
            marked[place] = True
    return bits, np.packbits(marked, bitorder="little").tobytes()


def segments(rows: DataFrame, bits_each: float = BITS) -> DataFrame:
    """``shard, bits, data``: the filter made of packed rows, a segment for each shard."""
    def make(part: pa.Table) -> pa.Table:
        bits, data = segment(*merged(part), bits_each)
        return pa.table({"shard": part["shard"][:1], "bits": pa.array([bits], pa.int64()), "data": pa.array([data], pa.binary())})

    return rows.groupBy("shard").applyInArrow(make, "shard int, bits bigint, data binary")


@dataclass(frozen=True)
class Slice:
    """Segments of the shards from ``first`` to before ``last``, out of ``shards``."""

    shards: int
    first: int
    last: int
    bits: np.ndarray
    offsets: np.ndarray
    data: np.ndarray

    @classmethod
    def read(cls, made: DataFrame, shards: int, first: int, last: int) -> Slice:
        """Fetches the named segments, a partition at a time, into one array; the caller bounds their size."""
        own = made.where((F.col("shard") >= first) & (F.col("shard") < last))
        bits, sizes = np.ones(last - first, np.uint64), np.ones(last - first, np.int64)  # a shard without items has one byte
        for row in own.select("shard", "bits", F.octet_length("data").alias("size")).collect():
            bits[row.shard - first], sizes[row.shard - first] = row.bits, row.size
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        data = np.zeros(offsets[-1], np.uint8)
        for row in own.select("shard", "data").toLocalIterator():
            at = int(offsets[row.shard - first])
            data[at:at + len(row.data)] = np.frombuffer(row.data, np.uint8)
        return cls(shards, first, last, bits, offsets[:-1].astype(np.uint64), data)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Which hashes are asked for here."""
        own = shard_of(hashes, self.shards)
        return (own >= self.first) & (own < self.last)

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """The count that repeated probes find for each hash; the hashes belong to this slice."""
        own = shard_of(hashes, self.shards) - self.first
        bits, offsets, keys = self.bits[own], self.offsets[own], hashes & _KEY
        found, live = np.zeros(hashes.size, np.int64), np.arange(hashes.size)
        for item in range(1, QUANTA.size + 1):
            if not live.size:
                break
            hit = np.ones(live.size, bool)
            for place in places(keys[live], item, bits[live]):
                byte = self.data[(offsets[live] + (place >> np.uint64(3))).astype(np.int64)]
                hit &= (byte >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
            live = live[hit]
            found[live] = item
        return MIDDLES[found]


@dataclass(frozen=True)
class Counts:
    """What the training texts hold: tokens, distinct tokens, texts, and the tables behind the scores."""

    tokens: int
    distinct: int
    texts: int
    words: DataFrame
    pairs: DataFrame
    shards: int

    @property
    def scale(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)


def fold(name: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(name).cast("string")) % FOLDS, F.lit(0).cast("bigint"))


def _word_counts(batch: pa.RecordBatch) -> dict:
    hashes, counts = np.unique(tokens_of(Words(batch.column("text")))[0], return_counts=True)
    return {"hash": hashes.view(np.int64), "n": counts}


def learn(training: DataFrame) -> Counts:
    """Counts of tokens and pairs of all rows of ``training``."""
    words = map_arrow(training.select("text"), _word_counts, "hash bigint, n bigint")
    words = staged(words.groupBy("hash").agg(F.sum("n").alias("n")), "model-words")
    size = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("distinct"),
        F.coalesce(F.sum(F.when(F.col("hash") == int(END.view(np.int64)), F.col("n"))), F.lit(0)).alias("texts"),
    ).first()
    shards = max(1, -(-size.tokens // SHARD_TOKENS))

    def pairs(batch: pa.RecordBatch) -> dict:
        tokens, before, _ = tokens_of(Words(batch.column("text")))
        return packed(*np.unique(pairs_of(before, tokens), return_counts=True), shards)

    made = segments(map_arrow(training.select("text"), pairs, PACKED))
    return Counts(size.tokens, size.distinct, size.texts, words, staged(made, "model-pairs"), shards)


def word_filter(counts: Counts) -> Slice:
    """The filter of single tokens, never of more than ``SLICE_BYTES``."""
    shards = max(1, -(-counts.distinct // SHARD_TOKENS))

    def pack(batch: pa.RecordBatch) -> dict:
        hashes = batch.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        # Counts above 32 bits are beyond any difference that matters here.
        return packed(hashes[order], np.minimum(batch.column("n").to_numpy()[order], 0xFFFFFFFF), shards)

    items = counts.words.agg(F.sum(F.log("n") / float(np.log(BASE)) + 1)).first()[0] or 1.0
    bits_each = min(float(BITS), 8 * SLICE_BYTES / items)
    return Slice.read(staged(segments(map_arrow(counts.words, pack, PACKED), bits_each), "model-filter"), shards, 0, shards)


def _shards_a_slice(pairs: DataFrame) -> int:
    most = pairs.agg(F.max(F.octet_length("data"))).first()[0] or 1
    return max(1, SLICE_BYTES // most)


def _known(words: DataFrame, number: int, slices: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of one slice of the exact counts, ascending, and their counts; fetched in ``FETCHES`` parts."""
    place = F.shiftrightunsigned("hash", 1) % (slices * FETCHES)
    parts = [words.where(place == number + slices * part).toArrow() for part in range(FETCHES)]
    hashes = np.concatenate([part["hash"].to_numpy().view(np.uint64) for part in parts])
    amounts = np.concatenate([part["n"].to_numpy() for part in parts])
    order = np.argsort(hashes)
    return hashes[order], amounts[order]


def partial_scores(docs: DataFrame, counts: Counts, singles: Slice, known: tuple, pair_slice: Slice | None, number: int, slices: int) -> DataFrame:
    """``doc_id, text_hash, n_tokens`` and what one slice of words and one of pairs give: ``known, base, model``."""
    shared = docs.sparkSession.sparkContext.broadcast((singles, known, pair_slice))
    scale, texts = counts.scale, counts.texts

    def work(batch: pa.RecordBatch) -> dict:
        single, (hashes, amounts), pairs = shared.value
        tokens, before, starts = tokens_of(Words(batch.column("text")))
        own, at = np.unique(tokens, return_inverse=True)
        exact = np.zeros(own.size)
        if hashes.size:
            place = np.minimum(np.searchsorted(hashes, own), hashes.size - 1)
            exact = np.where(hashes[place] == own, amounts[place], 0)
        mine = (own >> np.uint64(1)) % np.uint64(slices) == number if number < slices else np.zeros(own.size, bool)
        base = np.where(mine, np.log10((exact + 0.5) / scale), 0.0)
        model = np.zeros(tokens.size)
        if pairs is not None:
            each, where = np.unique(pairs_of(before, tokens), return_inverse=True)
            here = pairs.holds(each)
            found = np.zeros(each.size)
            found[here] = pairs.counts(each[here])
            alone = single.counts(own)[at]
            ahead = np.roll(alone, 1)
            ahead[starts] = texts
            both = np.minimum(found[where], np.maximum(ahead, 1))
            smoothed = (both + PRIOR * (alone + 0.5) / scale) / (np.maximum(ahead, both) + PRIOR)
            model = np.where(here[where], np.log10(smoothed), 0.0)
        add = lambda values: np.add.reduceat(values, starts) if starts.size else np.zeros(0)
        return {
            "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
            "n_tokens": np.diff(np.append(starts, tokens.size)), "known": add(((exact > 0) & mine)[at].astype(np.int64)).astype(np.int64),
            "base": add(base[at]), "model": add(model),
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = staged(map_arrow(
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), work,
        f"doc_id {kind}, text_hash bigint, n_tokens bigint, known bigint, base double, model double",
    ), "model-scores")
    shared.destroy()
    return made


def scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    docs = only(docs, "doc_id", "text")
    counts = learn(docs.where(fold() != HELD_OUT))
    singles = word_filter(counts)
    word_slices = max(1, -(-counts.distinct // SLICE_WORDS))
    step = _shards_a_slice(counts.pairs)
    pair_slices = -(-counts.shards // step)
    parts = None
    passes = max(word_slices, pair_slices)
    for number in range(passes):
        known = _known(counts.words, number, word_slices) if number < word_slices else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        pairs = None
        if number < pair_slices:
            pairs = Slice.read(counts.pairs, counts.shards, number * step, min(counts.shards, (number + 1) * step))
        part = partial_scores(docs, counts, singles, known, pairs, number, word_slices)
        parts = part if parts is None else parts.unionAll(part)
        del known, pairs  # before the next slice is fetched
    # Each pass has each row once, so rows that repeat id and text are so many times the passes.
    copies = F.count("*") / passes
    whole = parts.groupBy("doc_id", "text_hash").agg(
        F.first("n_tokens").alias("n_tokens"), (F.sum("known") / copies).cast("bigint").alias("n_known"),
        (F.sum("base") / copies).alias("base_score"), (F.sum("model") / copies).alias("score"), copies.cast("int").alias("copies"),
    )
    return whole.select("*", F.explode(F.sequence(F.lit(1), "copies"))).select(
        "doc_id", (fold() == HELD_OUT).alias("held_out"), "n_tokens", "n_known",
        F.lit(counts.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )


@query("op12_ngram_model")
def op12_ngram_model(spark: SparkSession, sf: str) -> DataFrame:
    return scores(table(spark, sf, "documents"))
