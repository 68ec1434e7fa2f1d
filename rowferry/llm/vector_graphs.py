"""Near-duplicate vectors by navigable small-world graphs, one per shard.

1. Equal vectors are one class; classes are dealt over shards by hash. There
   are ``LEAST_SHARDS``, and more where a shard would pass ``SHARD_VECTORS`` or
   ``SHARD_BYTES``.
2. A shard first takes out its dense groups: a vector with ``BALL_LEAST`` others
   within half the angle of ``LEAST_COSINE`` is the middle of a ball, whose
   members are all linked. Middles are sought among ``BALL_SAMPLE`` vectors;
   a group that the sample misses stays in the graph, with the same links.
   Members are sorted by their angle to the middle, so that for a query those
   near enough are counted, and only those at about the limit compared.
3. Of the other vectors a task builds graphs in layers, each a sixteenth of the
   one below, by adding vectors in blocks: a block searches the graph built so
   far, and of the candidates those are linked that are nearer than to one another.
4. All classes stream through every shard. A search widens its beam while
   all it found is similar enough, and the shard's beam is widened until each
   of three audits against all vectors of the graph finds ``AUDIT_RECALL`` of
   the pairs, those of a vector with itself left out: vectors of the shard,
   near copies made of some of them, so that there are pairs where the data
   has few, and the first of the classes that stream in, most of them of other
   shards. An audit ends at ``AUDIT_PAIRS`` pairs or ``AUDIT_MOST`` vectors.
5. What is found is verified by cosine in double precision. The shard unites its
   own vectors; of a query it gives one row for each united group that the
   query links with, with the number of rows behind those links, not the pairs.
   A group of n vectors so gives n rows for each shard. Groups are united
   across shards by their roots.

A link counts for the vector whose search found it; each of the two searches
for the other on its own.

Vectors that are null, zero, or hold null or non-finite components link with
nothing, and vectors of different lengths do not link. A row's links count all
other rows with an equal or linked vector. Rows that repeat a ``vec_id`` are
each judged by their own vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.llm.common import map_arrow, query, staged, table
from rowferry.llm.components import components

LEAST_COSINE = 0.9
LEAST_SHARDS = 8
SHARD_VECTORS = 200_000
SHARD_BYTES = 128 << 20  # of doubles
BALL_LEAST = 32
BALL_SAMPLE = 2048
BALL_MARGIN = 1e-6  # of angles, in radians
LINKS = 12
BASE_LINKS = 24
LAYER = 16
BLOCK = 256
BUILD_BEAM = 48
FIRST_BEAM = 32
AUDIT = 128
AUDIT_PAIRS = 256
AUDIT_STEP = 32
AUDIT_MOST = 2048
AUDIT_RECALL = 0.98
SLACK = 1e-4  # of single precision in the search
EXPANDED = 4


class Layer:
    """A graph over the first vectors of a shard."""

    def __init__(self, vectors: np.ndarray, size: int, links: int):
        self.vectors, self.size, self.links = vectors, size, links
        self.near = np.full((size, links), -1, np.int32)
        self.built = 0

    def search(self, queries: np.ndarray, entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and similarities of the best found, best first, -1 for none; all queries go step by step together."""
        count = len(queries)
        beam = min(beam, self.built)
        ids = np.full((count, beam), -1, np.int32)
        scores = np.full((count, beam), -2.0, np.float32)
        done = np.ones((count, beam), bool)
        seen = np.zeros((count, self.built + 1), bool)  # the last column stands for -1
        seen[:, -1] = True
        entries = entries[:, :beam]
        rows = np.arange(count)
        seen[rows[:, None], entries] = True
        ids[:, :entries.shape[1]] = entries
        scores[:, :entries.shape[1]] = np.einsum("bed,bd->be", self.vectors[entries], queries)
        scores[ids < 0] = -2.0
        done[:, :entries.shape[1]] = entries < 0
        live = rows
        while live.size:
            open_scores = np.where(done[live], -3.0, scores[live])
            take = min(EXPANDED, beam)
            at = np.argpartition(-open_scores, take - 1, 1)[:, :take] if take < beam else np.tile(np.arange(beam), (live.size, 1))
            chosen = np.take_along_axis(open_scores, at, 1) > -2.0
            keep = chosen.any(1)
            live, at, chosen = live[keep], at[keep], chosen[keep]
            if not live.size:
                break
            done[live[:, None], at] = True
            own = np.where(chosen, ids[live[:, None], at], -1)
            next_ids = np.where(own[:, :, None] >= 0, self.near[own], -1).reshape(live.size, -1)
            next_ids[seen[live[:, None], next_ids]] = -1
            next_ids = np.sort(next_ids, 1)
            next_ids[:, 1:][next_ids[:, 1:] == next_ids[:, :-1]] = -1
            width = int((next_ids >= 0).sum(1).max())
            if not width:
                continue
            next_ids = -np.partition(-next_ids, width - 1, 1)[:, :width] if width < next_ids.shape[1] else next_ids
            seen[live[:, None], next_ids] = True
            next_scores = np.einsum("bmd,bd->bm", self.vectors[next_ids], queries[live])
            next_scores[next_ids < 0] = -2.0
            all_ids = np.concatenate((ids[live], next_ids), 1)
            all_scores = np.concatenate((scores[live], next_scores), 1)
            all_done = np.concatenate((done[live], next_ids < 0), 1)
            best = np.argpartition(-all_scores, beam - 1, 1)[:, :beam]
            ids[live] = np.take_along_axis(all_ids, best, 1)
            scores[live] = np.take_along_axis(all_scores, best, 1)
            done[live] = np.take_along_axis(all_done, best, 1)
        order = np.argsort(-scores, 1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)

    def diverse(self, own: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Of each row's candidates, those nearer to its vector than to better ones kept; then the next best."""
        scores = np.einsum("bcd,bd->bc", self.vectors[candidates], self.vectors[own])
        scores[(candidates < 0) | (candidates == own[:, None])] = -2.0
        order = np.argsort(-scores, 1, kind="stable")
        candidates, scores = np.take_along_axis(candidates, order, 1), np.take_along_axis(scores, order, 1)
        between = np.einsum("bcd,bed->bce", self.vectors[candidates], self.vectors[candidates])
        valid = scores > -2.0
        kept = np.zeros_like(valid)
        for place in range(candidates.shape[1]):
            hidden = (kept & (between[:, place] >= scores[:, place, None])).any(1)
            kept[:, place] = valid[:, place] & ~hidden & (kept.sum(1) < self.links)
        rank = np.where(kept, 0, np.where(valid, 1, 2)) * candidates.shape[1] + np.arange(candidates.shape[1])
        first = np.argsort(rank, 1)[:, :self.links]
        found = np.take_along_axis(np.where(valid, candidates, -1), first, 1)
        return np.pad(found, ((0, 0), (0, self.links - found.shape[1])), constant_values=-1)

    def add(self, own: np.ndarray, found: np.ndarray) -> None:
        """Link a block of new vectors with what a search found and with one another."""
        inside = self.vectors[own] @ self.vectors[own].T
        np.fill_diagonal(inside, -2.0)
        near = min(BUILD_BEAM, own.size - 1)
        block = own[np.argsort(-inside, 1)[:, :near]] if near else np.zeros((own.size, 0), np.int64)
        self.built = int(own[-1]) + 1
        self.near[own] = self.diverse(own, np.concatenate((found, block.astype(np.int32)), 1))
        source = np.repeat(own, self.links)
        target = self.near[own].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, start, counts = np.unique(target, return_index=True, return_counts=True)
        back = np.full((nodes.size, int(counts.max()) if counts.size else 0), -1, np.int32)
        if not nodes.size:
            return
        column = np.arange(target.size) - np.repeat(start, counts)
        back[np.repeat(np.arange(nodes.size), counts), column] = source
        for begin in range(0, nodes.size, BLOCK):
            part = slice(begin, begin + BLOCK)
            both = np.concatenate((self.near[nodes[part]], back[part]), 1)
            both = np.sort(both, 1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            width = max(1, int((both >= 0).sum(1).max()))
            self.near[nodes[part]] = self.diverse(nodes[part], -np.sort(-both, 1)[:, :width])


class Graphs:
    """The layers over unit vectors, the uppermost small enough to look through."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        sizes = [len(vectors)]
        while sizes[-1] > BLOCK:
            sizes.append(max(1, sizes[-1] // LAYER))
        self.layers: list[Layer] = []
        for size in reversed(sizes):
            layer = Layer(vectors, size, BASE_LINKS if size == len(vectors) else LINKS)
            for start in range(0, size, BLOCK):
                own = np.arange(start, min(size, start + BLOCK))
                found = np.zeros((own.size, 0), np.int32)
                if start:
                    found = layer.search(vectors[own], self.entries(vectors[own], start), BUILD_BEAM)[0]
                layer.add(own, found)
            self.layers.append(layer)
        self.beam = FIRST_BEAM
        self.audit_own()

    def entries(self, queries: np.ndarray, below: int) -> np.ndarray:
        """Where to begin in the next layer, of which so many vectors are built."""
        if not self.layers:
            return np.zeros((len(queries), 1), np.int32)
        top = self.layers[0].size
        found = np.argsort(-(queries @ self.vectors[:top].T), 1)[:, :4].astype(np.int32)
        for layer in self.layers[1:]:
            found = layer.search(queries, found, 8)[0][:, :4]
        found = np.where(found < below, found, -1)
        found[:, 0] = np.where((found < 0).all(1), 0, found[:, 0])
        return found

    def similar(self, queries: np.ndarray, least: float, beam: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``queries`` and ids of all found pairs of sufficient similarity."""
        base, beam = self.layers[-1], beam or self.beam
        upper = self.layers
        self.layers = upper[:-1]
        entries = self.entries(queries, base.size)
        self.layers = upper
        ids, scores = base.search(queries, entries, beam)
        good = scores >= least
        full = np.flatnonzero(good.all(1)) if beam < base.size else np.zeros(0, np.int64)
        good[full] = False
        rows, columns = np.nonzero(good)
        found = ids[rows, columns]
        if full.size:
            more, more_ids = self.similar(queries[full], least, 2 * beam)
            rows, found = np.concatenate((rows, full[more])), np.concatenate((found, more_ids))
        return rows, found

    def audit_own(self) -> None:
        """Audit by vectors of the shard and by near copies made of some."""
        count, size = self.vectors.shape
        own = np.linspace(0, count - 1, min(AUDIT_MOST, count)).astype(np.int64)
        self.audit(self.vectors[own], own)
        own = own[np.linspace(0, own.size - 1, min(AUDIT, own.size)).astype(np.int64)]
        if size > 1:
            source = np.random.default_rng(count)
            base = self.vectors[own].astype(np.float64)
            aside = source.normal(size=base.shape)
            aside -= (aside * base).sum(1, keepdims=True) * base
            cosine = source.uniform(LEAST_COSINE, (1 + LEAST_COSINE) / 2, (own.size, 1))
            copies = cosine * base + np.sqrt(1 - cosine ** 2) * unit(aside)
            self.audit(copies.astype(np.float32), np.full(own.size, -1))

    def audit(self, queries: np.ndarray, own: np.ndarray) -> None:
        """Widen the beam until enough pairs of the queries are found; ``own`` is a query's id, or -1."""
        count = len(self.vectors)
        wanted, end, pairs = [], 0, 0
        while end < len(queries) and pairs < AUDIT_PAIRS:
            part = slice(end, end + AUDIT_STEP)
            rows, ids = np.nonzero(queries[part] @ self.vectors.T >= LEAST_COSINE)
            rows += end
            other = ids != own[rows]
            wanted.append(rows[other] * count + ids[other])
            pairs += wanted[-1].size
            end += AUDIT_STEP
        if not pairs:
            return
        wanted = np.concatenate(wanted)
        asked = np.unique(wanted // count)
        while self.beam < count:
            rows, found = self.similar(queries[asked], LEAST_COSINE - SLACK)
            if np.isin(asked[rows] * count + found, wanted).sum() >= AUDIT_RECALL * pairs:
                break
            self.beam *= 2


def classes(vectors: DataFrame) -> DataFrame:
    """``vec_id, cls, vector``; ``vector`` has doubles as bytes, and is null with ``cls`` where a row links with nothing."""
    values = F.col("embedding").cast("array<double>")
    whole = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(values, lambda v: v != 0)
    plain = vectors.select("vec_id", F.when(whole, values).alias("values"))

    def work(batch: pa.RecordBatch) -> dict:
        rows = [None if v is None else np.array(v, np.float64).tobytes() for v in batch.column(2).to_pylist()]
        return {"vec_id": batch.column(0), "cls": batch.column(1), "vector": pa.array(rows, pa.binary())}

    kind = vectors.schema["vec_id"].dataType.simpleString()
    hashed = plain.select("vec_id", F.when(F.col("values").isNotNull(), F.xxhash64("values")).alias("cls"), "values")
    return map_arrow(hashed, work, f"vec_id {kind}, cls bigint, vector binary")


def found_links(distinct: DataFrame, shards: int) -> DataFrame:
    """``a, b, linked``: class ``a`` links with ``linked`` rows of one shard, all in the group of class ``b``.

    ``distinct`` has ``cls, rows, vector``. Classes that are the root of their
    group are rows too.
    """
    shard = F.pmod(F.xxhash64("cls"), F.lit(shards)).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != shard)
    values = [F.length("vector").alias("size"), "cls", "rows", "vector"]
    indexed = distinct.select(shard.alias("shard"), F.lit(0).alias("asked"), *values)
    asked = distinct.select(F.explode(others).alias("shard"), F.lit(1).alias("asked"), *values)
    dealt = indexed.unionAll(asked).repartitionById(shards, "shard").sortWithinPartitions("shard", "size", "asked", "cls")
    dealt = dealt.select("shard", "size", "asked", "cls", "rows", "vector")
    return dealt.mapInArrow(_search_shards, "a bigint, b bigint, linked bigint")


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that large and tiny numbers stay finite."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


class Ball:
    """Vectors within half the angle of a link from a middle, so that all are linked."""

    def __init__(self, vectors: np.ndarray, rows: np.ndarray, members: np.ndarray, angles: np.ndarray):
        order = np.argsort(angles, kind="stable")
        self.members, self.angles = members[order], angles[order]
        self.vectors = vectors[self.members]
        self.middle = self.vectors[0]
        self.before = np.concatenate(([0], np.cumsum(rows[self.members])))
        self.rows = rows[self.members]

    def linked(self, queries: np.ndarray, away: np.ndarray) -> np.ndarray:
        """The rows that each query links with; ``away`` are its angles to the middle."""
        sure = np.searchsorted(self.angles, LINK_ANGLE - away - BALL_MARGIN, "right")
        found = self.before[sure]
        least = np.maximum(sure, np.searchsorted(self.angles, away - LINK_ANGLE - BALL_MARGIN, "left"))
        open_ = np.flatnonzero(least < self.angles.size)
        for start in range(int(least[open_].min()) if open_.size else 0, self.angles.size if open_.size else 0, 16 * BLOCK):
            part = slice(start, start + 16 * BLOCK)
            good = queries[open_] @ self.vectors[part].T >= LEAST_COSINE
            good &= np.arange(start, start + good.shape[1]) >= least[open_, None]
            found[open_] += good @ self.rows[part]
        return found


def angles_of(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


LINK_ANGLE = math.acos(LEAST_COSINE)


def balls_of(vectors: np.ndarray, rows: np.ndarray) -> list[Ball]:
    """Disjoint balls of at least ``BALL_LEAST`` vectors each.

    Middles are sought among a sample of the vectors that are in none yet, the
    densest first, again while that takes out a sixteenth of them.
    """
    found: list[Ball] = []
    single = vectors.astype(np.float32)
    free = np.arange(len(vectors))
    while free.size >= BALL_LEAST:
        sample = free[np.linspace(0, free.size - 1, min(BALL_SAMPLE, free.size)).astype(np.int64)]
        tight = math.cos(LINK_ANGLE / 2)
        own = single[free]
        near = np.concatenate([(single[sample[at:at + BLOCK // 4]] @ own.T >= tight - SLACK).sum(1) for at in range(0, sample.size, BLOCK // 4)])
        order = np.argsort(-near, kind="stable")
        taken = np.zeros(len(vectors), bool)
        for middle in sample[order[near[order] >= BALL_LEAST]]:
            if taken[middle]:
                continue
            close = free[(own @ single[middle] >= tight - SLACK) & ~taken[free]]
            angles = angles_of(vectors[close] @ vectors[middle])
            angles[close == middle] = 0.0
            inside = angles <= LINK_ANGLE / 2 - BALL_MARGIN
            if inside.sum() >= BALL_LEAST:
                found.append(Ball(vectors, rows, close[inside], angles[inside]))
                taken[close[inside]] = True
        count = int(taken.sum())
        if not count:
            break
        free = free[~taken[free]]
        if count < free.size // 16:
            break
    return found


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite ``a[i]`` with ``b[i]``; ``parent`` leads every node straight to the least of its group, before and after."""
    while True:
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        apart = low < high
        if not apart.any():
            return
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        np.minimum.at(parent, high, low)
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]


class Shard:
    """The vectors of one shard and size, and the classes that ask for their like."""

    def __init__(self):
        self.held: list[bytes] = []
        self.ids: list[int] = []
        self.counts: list[int] = []
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.ready = False

    def build(self) -> None:
        exact = unit(np.frombuffer(b"".join(self.held), np.float64).reshape(len(self.held), -1))
        order = np.random.default_rng(len(self.held)).permutation(len(self.held))
        self.exact, self.names, self.held = exact[order], np.array(self.ids, np.int64)[order], []
        self.rows = np.array(self.counts, np.int64)[order]
        self.balls = balls_of(self.exact, self.rows)
        self.middles = np.array([ball.middle for ball in self.balls]).reshape(len(self.balls), exact.shape[1])
        self.centres = np.array([ball.members[0] for ball in self.balls], np.int64)
        rest = np.ones(len(order), bool)
        for ball in self.balls:
            rest[ball.members] = False
        self.rest = np.flatnonzero(rest)
        self.graphs = Graphs(self.exact[self.rest].astype(np.float32)) if self.rest.size else None
        self.root = np.arange(len(order))
        for ball in self.balls:
            unite(self.root, ball.members, np.full(ball.members.size, ball.members[0]))
        self.ready = True

    def ask(self, vectors: list[bytes], classes: list[int]) -> Iterator[pa.RecordBatch]:
        """Links of classes of other shards; the first wait until there are enough for an audit."""
        queries = unit(np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1))
        if self.ready:
            yield from self.answer(queries, np.array(classes, np.int64))
            return
        self.waiting.append((queries, np.array(classes, np.int64)))
        if sum(len(own) for _, own in self.waiting) >= AUDIT_MOST:
            yield from self.finish()

    def finish(self) -> Iterator[pa.RecordBatch]:
        """Audit by the classes that wait, then answer for the shard's own vectors and for those."""
        if self.ready or not self.ids:
            return
        self.build()
        if self.graphs is not None and self.waiting:
            first = np.concatenate([queries for queries, _ in self.waiting])[:AUDIT_MOST].astype(np.float32)
            self.graphs.audit(first, np.full(len(first), -1))
        yield from self.answer_own()
        for queries, own in self.waiting:
            yield from self.answer(queries, own)
        self.waiting = []

    def links(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions in ``queries``, a linked vector of the shard or the middle of a ball, and the rows it stands for."""
        found = []
        if self.graphs is not None:
            at, near = self.graphs.similar(queries.astype(np.float32), LEAST_COSINE - SLACK)
            near = self.rest[near]
            good = np.einsum("nd,nd->n", queries[at], self.exact[near]) >= LEAST_COSINE
            found.append((at[good], near[good], self.rows[near[good]]))
        if self.balls:
            away = angles_of(queries @ self.middles.T)
            for place in np.flatnonzero((away < 1.5 * LINK_ANGLE).any(0)):
                asking = np.flatnonzero(away[:, place] < 1.5 * LINK_ANGLE)
                rows = self.balls[place].linked(queries[asking], away[asking, place])
                asking, rows = asking[rows > 0], rows[rows > 0]
                found.append((asking, np.full(asking.size, self.centres[place]), rows))
        at, near, rows = (np.concatenate(parts) for parts in zip(*found))
        return at, near, rows

    def answer_own(self) -> Iterator[pa.RecordBatch]:
        """The vectors of the shard, after all of them are united; a vector is no link of its own."""
        linked = np.zeros(len(self.names), np.int64)
        for start in range(0, len(linked), BLOCK):
            part = slice(start, min(len(linked), start + BLOCK))
            at, near, rows = self.links(self.exact[part])
            at = at + start
            unite(self.root, at, near)
            np.add.at(linked, at, rows)
            alone = np.isin(np.arange(part.start, part.stop), at[self._itself(at, near)])
            linked[part] -= np.where(alone, self.rows[part], 0)
        own = np.flatnonzero(linked > 0)
        yield self._batch(self.names[own], self.names[self.root[own]], linked[own])

    def _itself(self, at: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Whether what was found for a vector of the shard counts the vector itself."""
        if not hasattr(self, "ball"):
            self.ball = np.arange(len(self.names))
            for ball in self.balls:
                self.ball[ball.members] = ball.members[0]
        return self.ball[at] == near

    def answer(self, queries: np.ndarray, own: np.ndarray) -> Iterator[pa.RecordBatch]:
        count = len(self.names)
        for start in range(0, len(own), BLOCK):
            part = slice(start, start + BLOCK)
            at, near, rows = self.links(queries[part])
            groups, place = np.unique(at * count + self.root[near], return_inverse=True)
            linked = np.zeros(groups.size, np.int64)
            np.add.at(linked, place, rows)
            yield self._batch(own[part][groups // count], self.names[groups % count], linked)

    @staticmethod
    def _batch(a: np.ndarray, b: np.ndarray, linked: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "linked": pa.array(linked, pa.int64())})


def _search_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, own = None, Shard()
    for batch in batches:
        columns = [column.to_pylist() for column in batch.columns]
        begin = 0
        kinds = list(zip(*columns[:3]))
        while begin < len(kinds):
            end = begin
            while end < len(kinds) and kinds[end] == kinds[begin]:
                end += 1
            shard, size, asked = kinds[begin]
            if key != (shard, size):
                yield from own.finish()
                key, own = (shard, size), Shard()
            if not asked:
                own.held += columns[5][begin:end]
                own.ids += columns[3][begin:end]
                own.counts += columns[4][begin:end]
            elif own.ids:
                yield from own.ask(columns[5][begin:end], columns[3][begin:end])
            begin = end
    yield from own.finish()


def link_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors``."""
    marked = staged(classes(vectors.select("vec_id", "embedding")), "vectors")
    whole = marked.where("cls is not null")
    sizes = whole.groupBy("cls").agg(F.count("*").alias("rows"), F.min("vec_id").alias("lowest"))
    distinct = whole.dropDuplicates(["cls"]).select("cls", "vector").join(sizes.select("cls", "rows"), "cls")
    rows, size = whole.agg(F.count("*"), F.coalesce(F.sum(F.length("vector")), F.lit(0))).first()
    shards = max(LEAST_SHARDS, math.ceil(rows / SHARD_VECTORS), math.ceil(size / SHARD_BYTES))
    links = staged(found_links(distinct, shards), "vector-links")
    linked = links.groupBy("a").agg(F.sum("linked").alias("linked"))
    placed = sizes.join(components(links.select("a", "b")), F.col("cls") == F.col("node"), "left")
    placed = placed.select("cls", "rows", "lowest", F.coalesce("root", "cls").alias("root"))
    lowest = placed.groupBy("root").agg(F.min("lowest").alias("component_id"))
    own = placed.join(lowest, "root").join(linked, F.col("cls") == F.col("a"), "left")
    own = own.select("cls", (F.col("rows") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    found = marked.select("vec_id", "cls").join(own, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return found.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


@query("op7_vector_graphs")
def op7_vector_graphs(spark: SparkSession, sf: str) -> DataFrame:
    return link_vectors(table(spark, sf, "embeddings"))
