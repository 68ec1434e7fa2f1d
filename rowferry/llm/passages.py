"""Passages that repeat across documents, fuzzy ones too, by chaining shared seeds.

1. Seeds are runs of ``SEED_WORDS`` words, of which each ``WINDOW`` neighbours
   keep the one of least hash, so a run of 7 equal words shares a seed.
2. Up to ``FEW`` occurrences of a seed are all joined with each other. More are
   joined in order of ``doc_id``: each with the first and with the one of the
   document before. So a seed that a third of all documents hold gives matches
   in proportion to its occurrences, in a stream. Such seeds then form runs of
   3, 8 and 20 in the order of each document, passing over rarer seeds between
   them. Up to ``FEW`` holders of a run all meet; more meet the first and the
   one before if it is a run of 20, some 45 words. So documents that share
   nothing but common seeds meet by the runs that few others have, and copies
   of a common passage meet its first holder instead of each other.
3. The matches of two documents that lie in order in both are chained: a match
   counts its words, and each word skipped in either document costs
   ``GAP_COST``. The best predecessor is found in a Fenwick tree of prefix
   maxima over places in the other document.
4. Each chain is aligned word by word between and around its matches: a match
   counts 1, another column ``-EDIT_COST``. Every maximal stretch is taken, the
   best one and then the best of what is left on either side, so passages far
   apart in one chain are all found. A stretch counts from ``LEAST_WORDS``
   words on.
5. Stretches that a better one of the same document covers are dropped.

A passage is reported in each document but the first that holds it, with the
earlier document it was matched with, and at each place of a document that
holds it several times. A seed that comes again within ``LEAST_WORDS`` words
counts once. Of passages all runs of which more than ``FEW`` documents hold,
the partners are those that hold their runs first and just before. Null and empty
texts have no passages. Rows without ``doc_id`` cannot be named and give
nothing; rows that share a ``doc_id`` are not compared with each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.llm.common import map_arrow, only, query, staged, table
from rowferry.llm.words import Words, mixed, runs

SEED_WORDS = 5
WINDOW = 3
GAP_COST = 0.05
EDIT_COST = 3
LEAST_WORDS = 45
LEAST_SPAN = 10
COVERED = 0.9
MARGIN = 64
BROADCAST_CHAINS = 1_000_000
# Rows of one key that all meet each other.
FEW = 32
# Lengths of runs of common seeds, and places kept of each run, so many that a chain passes over what lies between them.
RUNS, SPREAD = (3, 8, 20), 3
BLOCK_ROWS = 16_000

_ANCHOR = "doc_id bigint, other_id bigint, place int, other_place int"
_CHAIN = "doc_id bigint, other_id bigint, score double, start int, stop int, other_start int, other_stop int, matches binary"
_STRETCH = "doc_id bigint, start_word bigint, end_word bigint, other_id bigint, other_start bigint, other_end bigint, n_matched bigint, score bigint"
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def chosen_seeds(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Positions of the least of each window of neighbours, rows apart."""
    if not hashes.size:
        return np.zeros(0, np.int64)
    row = np.repeat(np.arange(bounds.size - 1), np.diff(bounds))
    least = hashes.copy()
    count = hashes.size
    for step in range(1, WINDOW):
        size = max(0, count - step)
        np.minimum(least[:size], hashes[step:], out=least[:size])
    whole = np.zeros(count, bool)
    if count >= WINDOW:
        whole[:count - WINDOW + 1] = row[:count - WINDOW + 1] == row[WINDOW - 1:]
    least[~whole] = _LAST
    chosen = np.zeros(count, bool)
    for step in range(WINDOW):
        size = max(0, count - step)
        chosen[step:] |= (least[:size] == hashes[step:]) & whole[:size]
    return np.flatnonzero(chosen)


def seeds(docs: DataFrame) -> DataFrame:
    """``key, doc_id, place``: the chosen seeds; of one in a document those that stand ``LEAST_WORDS`` after the one before."""
    def work(batch: pa.RecordBatch) -> dict:
        hashes, bounds = runs(Words(batch.column(1)), SEED_WORDS)
        at = chosen_seeds(hashes, bounds)
        row = np.searchsorted(bounds, at, "right") - 1
        order = np.lexsort((at, hashes[at], row))
        at, row = at[order], row[order]
        first = np.ones(at.size, bool)
        first[1:] = (hashes[at[1:]] != hashes[at[:-1]]) | (row[1:] != row[:-1]) | (at[1:] - at[:-1] >= LEAST_WORDS)
        at, row = at[first], row[first]
        return {
            "key": pa.array(hashes[at].view(np.int64)), "doc_id": batch.column(0).take(pa.array(row)),
            "place": pa.array((at - bounds[row]).astype(np.int32)),
        }

    return map_arrow(docs, work, "key bigint, doc_id bigint, place int")


def anchors(docs: DataFrame) -> DataFrame:
    """Matches of the occurrences of seeds, and of runs of seeds that more than ``FEW`` hold."""
    met = staged(meetings(seeds(docs), common=True), "met")
    common = met.where("other_id is null").select("key", "doc_id", "place")
    short = meetings(common_runs(common, RUNS[:-1]), first=False)
    long = meetings(common_runs(common, RUNS[-1:]))
    columns = ("doc_id", "other_id", "place", "other_place")
    return met.where("other_id is not null").select(*columns).unionAll(short.select(*columns)).unionAll(long.select(*columns))


def meetings(rows: DataFrame, first: bool = True, common: bool = False) -> DataFrame:
    """Matches of the rows ``key, doc_id, places...`` that share a key.

    Up to ``FEW`` rows all meet each other. More meet the first and the one of
    the document before, with ``first``; with ``common`` they are given too,
    without another document.
    """
    width = len(rows.columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done = np.zeros((width, 0), np.int64), 0
        for block in _blocks(batches):
            part = held if block is None else np.concatenate((held, block), 1)
            if not part.shape[1]:
                continue
            starts = np.concatenate(([True], part[0, 1:] != part[0, :-1]))
            keys = np.flatnonzero(starts)
            sizes = np.diff(np.append(keys, starts.size))
            if done:
                sizes[0] = max(sizes[0], FEW + 1)
            last = part[:, keys[-1]:]
            open_ = block is not None and sizes[-1] <= FEW  # a key that may go on is judged with its next rows
            kept = sizes > 1
            kept[-1] &= not open_
            chosen = np.repeat(kept, np.diff(np.append(keys, starts.size)))
            index = np.arange(int(chosen.sum()))
            head = np.maximum.accumulate(np.where(starts[chosen], index, 0)) if index.size else index
            many = np.repeat(sizes[kept] > FEW, np.diff(np.append(keys, starts.size))[kept])
            made = _matched(part[:, chosen], head, many, done, first, common)
            if made.num_rows:
                yield made
            if open_:
                held, done = last, 0
            else:
                others = np.flatnonzero(last[1] != last[1, -1])
                held, done = last[:, [0, int(others[-1]) if others.size else 0, -1]], 3

    ordered = rows.repartition("key").sortWithinPartitions("key", "doc_id", rows.columns[2])
    return ordered.mapInArrow(work, f"key bigint, {_ANCHOR}")


def _matched(part: np.ndarray, head: np.ndarray, many: np.ndarray, done: int, first: bool, common: bool) -> pa.RecordBatch:
    """The matches of whole keys; the first ``done`` rows were matched before."""
    index = np.arange(head.size)
    new = np.flatnonzero(many & (index >= done))
    pairs = []
    if first and new.size:
        own_doc = np.concatenate(([True], (part[1, 1:] != part[1, :-1]) | (head[1:] != head[:-1])))
        before = np.maximum.accumulate(np.where(own_doc, index, 0)) - 1
        pairs.append((new, head[new]))
        at = new[before[new] > head[new]]
        at = at[part[1, before[at]] != part[1, head[at]]]
        pairs.append((at, before[at]))
    at = np.flatnonzero(~many)
    for step in range(1, FEW):
        at = at[at - step >= head[at]]
        if not at.size:
            break
        pairs.append((at, at - step))
    own, other = (np.concatenate([index[:0], *[pair[side] for pair in pairs]]) for side in (0, 1))
    apart = part[1, own] != part[1, other]
    own, other = own[apart], other[apart]
    columns = [np.concatenate([part[c, at] for c in of]) for at, of in (
        (own, [1] * (part.shape[0] - 2)), (other, [1] * (part.shape[0] - 2)),
        (own, range(2, part.shape[0])), (other, range(2, part.shape[0])),
    )]
    matches = _anchor_batch(None, *columns)
    if not common or not new.size:
        return matches
    rows = _anchor_batch(part[0, new], part[1, new], None, part[2, new], None)
    return pa.concat_batches([matches, rows])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray | None]:
    """Columns of several batches at a time, and None after the last."""
    held, size = [], 0
    for batch in batches:
        held.append(_matrix(batch))
        size += batch.num_rows
        if size >= BLOCK_ROWS:
            yield np.concatenate(held, 1)
            held, size = [], 0
    if held:
        yield np.concatenate(held, 1)
    yield None


def _anchor_batch(*columns: np.ndarray | None) -> pa.RecordBatch:
    size = max(0 if column is None else column.size for column in columns)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    made = [pa.nulls(size, k) if column is None else pa.array(column.astype(k.to_pandas_dtype())) for column, k in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(made, names=["key", "doc_id", "other_id", "place", "other_place"])


def common_runs(common: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """``key, doc_id, place0, ...``: runs of common seeds that follow each other, whatever stands between, and places spread over them."""
    places = [f"place{i}" for i in range(SPREAD)]
    kinds = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), *[(place, pa.int32()) for place in places]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, place, seed in _whole(batches):
            keys = seed.view(np.uint64)
            for length in range(2, min(lengths[-1], doc.size) + 1):
                # One seed more: ``keys`` has the run that begins at each row.
                keys = mixed(keys[:doc.size - length + 1] + mixed(seed[length - 1:].view(np.uint64), length))
                if length not in lengths:
                    continue
                at = np.flatnonzero(doc[:doc.size - length + 1] == doc[length - 1:])
                spread = np.linspace(0, length - 1, SPREAD).astype(int)
                made = [pa.array(keys[at].view(np.int64)), pa.array(doc[at])]
                made += [pa.array(place[at + step].astype(np.int32)) for step in spread]
                yield pa.RecordBatch.from_arrays(made, schema=kinds)

    ordered = common.select("doc_id", "place", "key").repartition("doc_id").sortWithinPartitions("doc_id", "place")
    return ordered.mapInArrow(work, "key bigint, doc_id bigint, " + ", ".join(f"{place} int" for place in places))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([column.to_numpy().astype(np.int64) for column in batch.columns])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Columns of rows in blocks that end where the first column changes."""
    held = []
    for batch in batches:
        rows = _matrix(batch)
        cuts = np.flatnonzero(rows[0, 1:] != rows[0, :-1]) + 1
        if held and rows.shape[1] and rows[0, 0] != held[-1][0, -1]:
            cuts = np.concatenate(([0], cuts))
        if cuts.size:
            yield np.concatenate((*held, rows[:, :cuts[-1]]), 1)
            held, rows = [], rows[:, cuts[-1]:]
        if rows.shape[1]:
            held.append(rows)
    if held:
        yield np.concatenate(held, 1)


class PrefixMaxima:
    """A Fenwick tree: the largest value at any rank up to a given one, with its owner."""

    def __init__(self, size: int):
        self.values, self.owners = [0.0] * (size + 1), [-1] * (size + 1)

    def put(self, rank: int, value: float, owner: int) -> None:
        rank += 1
        while rank < len(self.values):
            if value > self.values[rank]:
                self.values[rank], self.owners[rank] = value, owner
            rank += rank & -rank

    def best(self, ranks: int) -> tuple[float, int]:
        """The largest of the first so many ranks; 0 and -1 if there is none."""
        value, owner = 0.0, -1
        while ranks:
            if self.values[ranks] > value:
                value, owner = self.values[ranks], self.owners[ranks]
            ranks -= ranks & -ranks
        return value, owner


def segments(places: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Matches on one diagonal and near each other as one: place, other place, length."""
    order = np.lexsort((places, others - places))
    a, b = places[order], others[order]
    new = np.ones(a.size, bool)
    new[1:] = (b[1:] - a[1:] != b[:-1] - a[:-1]) | (a[1:] - a[:-1] > SEED_WORDS + WINDOW)
    at = np.flatnonzero(new)
    last = np.concatenate((at[1:], [a.size])) - 1
    return np.stack((a[at], b[at], a[last] + SEED_WORDS - a[at]), 1)


def chains(matches: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
    """Score and matches of each chain, best first; a match is in one chain."""
    matches = matches[np.lexsort((matches[:, 1], matches[:, 0]))]
    a, b, length = (matches[:, i].tolist() for i in range(3))
    ends = np.unique(matches[:, 1] + matches[:, 2])
    ranks = np.searchsorted(ends, matches[:, 1] + matches[:, 2]).tolist()
    reach = np.searchsorted(ends, matches[:, 1], "right").tolist()
    events = sorted([(a[i], 1, i) for i in range(len(a))] + [(a[i] + length[i], 0, i) for i in range(len(a))])
    tree, score, before = PrefixMaxima(ends.size), [0.0] * len(a), [-1] * len(a)
    for place, starts, i in events:
        if starts:
            value, owner = tree.best(reach[i])
            value -= GAP_COST * (a[i] + b[i])
            score[i] = length[i] + max(0.0, value)
            before[i] = owner if value > 0 else -1
        else:
            tree.put(ranks[i], score[i] + GAP_COST * (place + b[i] + length[i]), i)
    used = [False] * len(a)
    for i in sorted(range(len(a)), key=lambda i: (-score[i], i)):
        path, at = [], i
        while at >= 0 and not used[at]:
            used[at] = True
            path.append(at)
            at = before[at]
        if path:
            yield score[i] - (score[at] if at >= 0 else 0.0), matches[path[::-1]]


def chained(matches: DataFrame) -> DataFrame:
    """The chains of each pair of documents that span enough words."""
    ordered = matches.repartition("doc_id", "other_id").sortWithinPartitions("doc_id", "other_id", "place", "other_place")
    return ordered.mapInArrow(_chain_pairs, _CHAIN)


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of the rows of each run of equal keys, for one pair of documents at a time."""
    rest = None
    for batch in batches:
        rows = np.stack([column.to_numpy().astype(np.int64) for column in batch.columns])
        rows = rows if rest is None else np.concatenate((rest, rows), 1)
        if not rows.shape[1]:
            continue
        cuts = np.flatnonzero((rows[:keys, 1:] != rows[:keys, :-1]).any(0)) + 1
        bounds = [0, *cuts.tolist()]
        for begin, end in zip(bounds, bounds[1:]):
            yield rows[:, begin:end]
        rest = rows[:, bounds[-1]:]
    if rest is not None and rest.shape[1]:
        yield rest


def _chain_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    for doc, other, places, others in _groups(batches, 2):
        if places[-1] - places[0] + SEED_WORDS < LEAST_SPAN:
            continue
        for score, path in chains(segments(places, others)):
            start, other_start = path[0, :2]
            stop, other_stop = path[-1, :2] + path[-1, 2]
            if stop - start >= LEAST_SPAN:
                blob = path.astype(np.int32).tobytes()
                rows.append((int(doc[0]), int(other[0]), float(score), int(start), int(stop), int(other_start), int(other_stop), blob))
        if len(rows) >= 5_000:
            yield _chain_batch(rows)
            rows = []
    yield _chain_batch(rows)


def _chain_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    names = [part.split()[0] for part in _CHAIN.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], k) for i, k in enumerate(kinds)], names=names)


def uncovered(found: DataFrame) -> DataFrame:
    """Stretches that better stretches of their document do not cover."""
    ordered = found.repartition("doc_id").sortWithinPartitions("doc_id", F.desc("score"), "other_id", "start_word", "other_start")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, taken = None, []
        for batch in batches:
            kept = []
            for own, start, stop in zip(*(batch.column(name).to_pylist() for name in ("doc_id", "start_word", "end_word"))):
                if own != doc:
                    doc, taken = own, []
                shared = max((min(stop, b) - max(start, a) for a, b in taken), default=0)
                kept.append(shared < COVERED * (stop - start))
                if kept[-1]:
                    taken.append((start, stop))
            yield batch.filter(pa.array(kept, pa.bool_()))

    return ordered.mapInArrow(keep, _STRETCH)


def slices(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``slice_id, low, high, first, words``: hashes of the words around each wanted range."""
    ranges = wanted.withColumnRenamed("slice_id", "_slice_id")
    if ranges.count() <= BROADCAST_CHAINS:
        ranges = F.broadcast(ranges)
    cut = docs.join(ranges, F.col("doc_id") == F.col("_slice_id")).select("_slice_id", "low", "high", "text")

    def work(batch: pa.RecordBatch) -> dict:
        words = Words(batch.column(3))
        firsts, blobs = [], []
        for row, (low, high) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
            own = words.hashes[words.rows[row]:words.rows[row + 1]]
            first = max(0, low - MARGIN)
            firsts.append(first)
            blobs.append((own[first:high + MARGIN] >> np.uint64(32)).astype(np.uint32).tobytes())
        return {
            "slice_id": batch.column(0), "low": batch.column(1), "high": batch.column(2),
            "first": pa.array(firsts, pa.int32()), "words": pa.array(blobs, pa.binary()),
        }

    return map_arrow(cut, work, "slice_id bigint, low int, high int, first int, words binary")


class Passage(NamedTuple):
    start: int
    stop: int
    other_start: int
    other_stop: int
    matched: int
    score: int


def stretches(same: np.ndarray) -> list[tuple[int, int]]:
    """All maximal stretches of columns: the best, and in turn the best on either side of it.

    One pass over the runs of equal columns (Ruzzo and Tompa): a run that
    matches joins the nearest stretch that begins no higher, if it ends higher.
    """
    bounds = [0, *(np.flatnonzero(same[1:] != same[:-1]) + 1).tolist(), same.size]
    open_: list[tuple[int, int, int, int, int]] = []  # begin, end, score before, score after, the nearest that begins no higher
    total = 0
    for begin, end in zip(bounds, bounds[1:]):
        if begin == end or not same[begin]:
            total -= EDIT_COST * (end - begin)
            continue
        low, total = total, total + end - begin
        while True:
            at = len(open_) - 1
            while at >= 0 and open_[at][2] > low:
                at = open_[at][4]
            if at < 0 or open_[at][3] >= total:
                break
            begin, low = open_[at][0], open_[at][2]
            del open_[at:]
        open_.append((begin, end, low, total, at))
    return [(begin, end) for begin, end, *_ in open_]


def align(x: np.ndarray, y: np.ndarray, path: np.ndarray) -> list[Passage]:
    """The maximal stretches along a chain; places count from the slices' starts."""
    sizes = np.array([x.size, y.size])
    path = path[((path[:, :2] >= 0) & (path[:, :2] + path[:, 2:] <= sizes)).all(1)]
    if not len(path):
        return []
    same, steps_x, steps_y = [], [], []

    def both(a: int, b: int, length: int) -> None:
        same.append(x[a:a + length] == y[b:b + length])
        steps_x.append(np.ones(length, np.int64))
        steps_y.append(np.ones(length, np.int64))

    def only_one(steps: list, others: list, length: int) -> None:
        same.append(np.zeros(length, bool))
        steps.append(np.ones(length, np.int64))
        others.append(np.zeros(length, np.int64))

    a, b = int(path[0, 0]), int(path[0, 1])
    lead = min(a, b)
    begin_x, begin_y = a - lead, b - lead
    both(begin_x, begin_y, lead)
    for p, q, length in path.tolist():
        if p < a or q < b:
            continue
        gap_x, gap_y = p - a, q - b
        near = min(gap_x, gap_y)
        # One of the texts has words more; they stand where most others match on either side.
        before = np.concatenate(([0], np.cumsum(x[a:a + near] == y[b:b + near])))
        after = np.concatenate(([0], np.cumsum(x[p - near:p] == y[q - near:q])))
        left = int((before + after[-1] - after).argmax())
        both(a, b, left)
        extra = abs(gap_x - gap_y)
        if gap_x > gap_y:
            only_one(steps_x, steps_y, extra)
            both(a + left + extra, b + left, near - left)
        else:
            if extra:
                only_one(steps_y, steps_x, extra)
            both(a + left, b + left + extra, near - left)
        both(p, q, length)
        a, b = p + length, q + length
    tail = min(x.size - a, y.size - b)
    both(a, b, tail)
    same, steps_x, steps_y = (np.concatenate(parts) for parts in (same, steps_x, steps_y))
    along_x, along_y = (np.concatenate(([0], np.cumsum(steps))) for steps in (steps_x, steps_y))
    found = []
    for start, stop in stretches(same):
        matched = int(same[start:stop].sum())
        found.append(Passage(
            begin_x + int(along_x[start]), begin_x + int(along_x[stop]), begin_y + int(along_y[start]), begin_y + int(along_y[stop]),
            matched, matched - EDIT_COST * (stop - start - matched),
        ))
    return found


def repeated_passages(docs: DataFrame) -> DataFrame:
    """``doc_id, start_word, end_word, other_id, other_start, other_end, n_matched``.

    Words are counted from 0, ends are exclusive.
    """
    docs = only(docs, "doc_id", "text").where("doc_id is not null").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    found = staged(chained(anchors(docs)), "chains")
    # Ranges of the other document in steps, so that many chains share a slice.
    low, high = F.expr(f"cast(other_start div {MARGIN} * {MARGIN} as int)"), F.expr(f"cast((other_stop div {MARGIN} + 1) * {MARGIN} as int)")
    found = found.withColumns({"other_low": low, "other_high": high})
    own = slices(docs, found.select(F.col("doc_id").alias("slice_id"), F.col("start").alias("low"), F.col("stop").alias("high")).distinct())
    other = slices(docs, found.select(F.col("other_id").alias("slice_id"), F.col("other_low").alias("low"), F.col("other_high").alias("high")).distinct())
    own = own.select(F.col("slice_id").alias("doc_id"), F.col("low").alias("start"), F.col("high").alias("stop"), "first", "words")
    other = other.select(
        F.col("slice_id").alias("other_id"), F.col("low").alias("other_low"), F.col("high").alias("other_high"),
        F.col("first").alias("other_first"), F.col("words").alias("other_words"),
    )
    pairs = found.join(own, ["doc_id", "start", "stop"]).join(other, ["other_id", "other_low", "other_high"])

    def work(batch: pa.RecordBatch) -> dict:
        rows, places = [], []
        columns = [batch.column(i).to_pylist() for i in range(2, 7)]
        for at, (first, words, other_first, other_words, blob) in enumerate(zip(*columns)):
            path = np.frombuffer(blob, np.int32).reshape(-1, 3).astype(np.int64) - np.array([first, other_first, 0])
            for passage in align(np.frombuffer(words, np.uint32), np.frombuffer(other_words, np.uint32), path):
                if max(passage.stop - passage.start, passage.other_stop - passage.other_start) >= LEAST_WORDS:
                    places.append(at)
                    rows.append((
                        passage.start + first, passage.stop + first, passage.other_start + other_first, passage.other_stop + other_first,
                        passage.matched, passage.score,
                    ))
        values = [pa.array([row[i] for row in rows], pa.int64()) for i in range(6)]
        at = pa.array(places, pa.int64())
        return {
            "doc_id": batch.column(0).take(at), "start_word": values[0], "end_word": values[1],
            "other_id": batch.column(1).take(at), "other_start": values[2], "other_end": values[3], "n_matched": values[4], "score": values[5],
        }

    aligned = map_arrow(pairs.select("doc_id", "other_id", "first", "words", "other_first", "other_words", "matches"), work, _STRETCH)
    return uncovered(aligned).drop("score")


@query("op10_repeated_passages")
def op10_repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_passages(table(spark, sf, "documents"))
