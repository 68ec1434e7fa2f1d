"""Documents that share four fifths of their word shingles, by a token-group matrix.

A document's set holds its distinct runs of five words. Equal sets are one
class. Tokens of a set are ordered: rare ones by their hash, then frequent
ones by frequency. Two sets of sufficient overlap share a token among the
first fifth of each, so the sparse matrix only holds those.

1. In each row of the matrix, classes are compared with the row's first class.
   Those linked by exact comparison form the groups of similar documents.
2. The rows of the matrix then hold all members of the groups, and go to the
   tasks whole. A query document and a group that share a token have a bound on
   the overlap with any member, from the least and greatest sizes and places of
   that token among the members. Only groups that reach the bound are opened.
3. Members of opened groups are compared by folded bit sets, which bound the
   overlap too, in the same task; the few pairs left are compared exactly. A
   first pass takes the nearest member for each query only, so that groups
   that belong together are united before the second takes all.

The result is exact: no link is lost except by a collision of 64-bit hashes.
A group of copies, however large, gives links in proportion to its size, since
inside a group no further pairs are formed. Of the tokens that ``FREQUENT``
sets hold, at most ``MOST_FREQUENT``, those most held, are sent to the tasks.
That only decides their order, never the result.

Null text counts as empty. An empty set links with nothing. Rows that repeat a
``doc_id`` are each judged by their own text. A row without ``doc_id`` gets the
component of its set.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.llm.common import discard, map_arrow, only, query, scratch, staged, table, without
from rowferry.llm.components import components
from rowferry.llm.words import Words, distinct_runs, mixed

SHINGLE_WORDS = 5
FREQUENT = 16
MOST_FREQUENT = 1_000_000
BROADCAST_IDS = 500_000
BLOCK_ROWS = 1_024
FEW_BYTES = 128
# Pairs that a task holds at a time, and pairs whose bits it holds.
PAIRS, COMPARED = 1 << 18, 1 << 14

# Overlap that two sets of together n tokens need: 9 * overlap >= 4 * n.
_NEEDED = "(4 * ({a} + {b}) + 8) div 9"


def prefix_length(size: int) -> int:
    """So many first tokens of a set meet those of every set it links with."""
    return size - (4 * size + 4) // 5 + 1


def class_hash(tokens: np.ndarray) -> int:
    """One signed 64-bit hash of a set."""
    with np.errstate(over="ignore"):
        both = np.array([mixed(tokens, 1).sum(dtype=np.uint64) ^ np.uint64(tokens.size), np.bitwise_xor.reduce(mixed(tokens, 2))])
        return int((mixed(both[:1], 3) + mixed(both[1:], 4)).view(np.int64)[0])


def bit_set(tokens: np.ndarray) -> bytes:
    """Parities of tokens by hash, as many bits as tokens, up to a power of two."""
    bits = max(64, 1 << int(tokens.size - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, most: int) -> bytes:
    """The same with at most so many bytes; it bounds differences less tightly."""
    own = np.frombuffer(bits, np.uint64)
    while own.size * 8 > most:
        own = own[:own.size // 2] ^ own[own.size // 2:]
    return own.tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound on the number of tokens in one of two sets only."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while x.size > y.size:
        x = x[:x.size // 2] ^ x[x.size // 2:]
    while y.size > x.size:
        y = y[:y.size // 2] ^ y[y.size // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, cls, bits, few_bits`` of every row; ``cls`` is null for an empty set."""
    def work(batch: pa.RecordBatch) -> dict:
        sets = distinct_runs(Words(batch.column(1)), SHINGLE_WORDS)
        return {
            "doc_id": batch.column(0), "n_shingles": pa.array([s.size for s in sets], pa.int64()),
            "cls": pa.array([class_hash(s) if s.size else None for s in sets], pa.int64()),
            "bits": pa.array(bits := [bit_set(s) if s.size else None for s in sets], pa.binary()),
            "few_bits": pa.array([None if b is None else folded(b, FEW_BYTES) for b in bits], pa.binary()),
        }

    return map_arrow(docs, work, f"doc_id {_id_type(docs)}, n_shingles bigint, cls bigint, bits binary, few_bits binary")


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


class Frequent:
    """Tokens that many sets hold, by a short key, with their ranks by frequency.

    A key is one of ``places``, of which there are more with more data, and the
    upper half of the token.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, places: int):
        order = np.argsort(keys)
        self.keys, counts, self.places = keys[order], counts[order], places
        self.ranks = np.empty(self.keys.size, np.int64)
        self.ranks[np.lexsort((self.keys, counts))] = np.arange(self.keys.size)

    def find(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which tokens are frequent, and where their keys stand."""
        if not self.keys.size:
            return np.zeros(tokens.size, bool), np.zeros(tokens.size, np.int64)
        keys = token_place(tokens, self.places) << np.uint64(32) | tokens >> np.uint64(32)
        at = np.minimum(np.searchsorted(self.keys, keys), self.keys.size - 1)
        return self.keys[at] == keys, at


def token_place(tokens: np.ndarray, places: int) -> np.ndarray:
    return mixed(tokens, 5) % np.uint64(places)


def frequent_tokens(docs: DataFrame) -> Frequent:
    """The tokens that ``FREQUENT`` sets or more hold, copies within a task counted once."""
    spark = docs.sparkSession
    places = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for tokens in distinct_runs(Words(batch.column(0)), SHINGLE_WORDS):
                own = class_hash(tokens) if tokens.size else 0
                if tokens.size and own not in seen:
                    seen.add(own)
                    found.append(tokens)
            tokens = np.concatenate(found)
            place = token_place(tokens, places).astype(np.int64)
            order = np.argsort(place, kind="stable")
            bounds = np.searchsorted(place[order], np.arange(places + 1))
            upper = (tokens >> np.uint64(32)).astype(np.uint32)[order]
            blobs = [upper[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_pydict({"place": pa.array(range(places), pa.int32()), "tokens": pa.array(blobs, pa.binary())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: dict[int, list[bytes]] = {}
        for batch in batches:
            for place, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                blobs.setdefault(place, []).append(blob)
        for place, parts in blobs.items():
            upper, counts = np.unique(np.frombuffer(b"".join(parts), np.uint32), return_counts=True)
            many = counts >= FREQUENT
            keys = np.uint64(place) << np.uint64(32) | upper[many].astype(np.uint64)
            yield pa.RecordBatch.from_pydict({"token": pa.array(keys.view(np.int64)), "held": pa.array(counts[many].astype(np.int64))})

    blobs = docs.select("text").mapInArrow(collect, "place int, tokens binary")
    held = staged(blobs.repartition(places, "place").mapInArrow(count, "token bigint, held bigint"), "frequent")
    least, total = FREQUENT, 0
    for row in held.groupBy("held").count().orderBy(F.desc("held")).toLocalIterator():
        total += row["count"]
        if total > MOST_FREQUENT:
            least = row.held + 1
            break
    kept = held.where(F.col("held") >= least).toArrow()
    return Frequent(kept.column("token").to_numpy().view(np.uint64), kept.column("held").to_numpy(), places)


def prefix(tokens: np.ndarray, frequent: Frequent) -> np.ndarray:
    """The first tokens of an ascending set in the common order."""
    need = prefix_length(tokens.size)
    common, at = frequent.find(tokens)
    rare = tokens[~common][:need]
    if rare.size == need:
        return rare
    late = np.flatnonzero(common)
    late = late[np.lexsort((tokens[late], frequent.ranks[at[late]]))][:need - rare.size]
    return np.concatenate((rare, tokens[late]))


def matrix(docs: DataFrame) -> DataFrame:
    """``token, cls, n, place`` of prefix tokens that several classes hold, with the row's first class."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_tokens(docs))

    def work(batch: pa.RecordBatch) -> dict:
        tokens, classes, sizes, places, seen = [np.zeros(0, np.uint64)], [], [], [np.zeros(0, np.int64)], set()
        for own in distinct_runs(Words(batch.column(0)), SHINGLE_WORDS):
            if own.size and (cls := class_hash(own)) not in seen:
                seen.add(cls)
                first = prefix(own, shared.value)
                tokens.append(first)
                places.append(np.arange(first.size))
                classes.append((cls, first.size))
                sizes.append(own.size)
        repeat = np.array([count for _, count in classes], np.int64)
        return {
            "token": pa.array(np.concatenate(tokens).view(np.int64)),
            "cls": pa.array(np.repeat(np.array([cls for cls, _ in classes], np.int64), repeat)),
            "n": pa.array(np.repeat(np.array(sizes, np.int32), repeat)),
            "place": pa.array(np.concatenate(places).astype(np.int32)),
        }

    schema = "token bigint, cls bigint, n int, place int"
    entries = map_arrow(docs.select("text"), work, schema)
    ordered = entries.repartition("token").sortWithinPartitions("token", "cls")
    return ordered.mapInArrow(_shared_rows, schema + ", first_cls bigint, first_n int, first_place int")


def _shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop tokens of one class, repeated entries too; a row's first entry waits for its second."""
    first, told, last = None, False, None
    for batch in batches:
        table = np.stack([column.to_numpy(zero_copy_only=False).astype(np.int64) for column in batch.columns])
        keep = np.ones(table.shape[1], bool)
        keep[1:] = (table[:2, 1:] != table[:2, :-1]).any(0)
        if last is not None and keep.size:
            keep[0] = bool((table[:2, 0] != last[:2]).any())
        table = table[:, keep]
        if not table.shape[1]:
            continue
        last = table[:, -1]
        if first is not None and first[0] == table[0, 0]:
            table = np.concatenate((first[:, None], table), 1)
            old = told
        else:
            old = False
        starts = np.concatenate(([True], table[0, 1:] != table[0, :-1]))
        at = np.maximum.accumulate(np.where(starts, np.arange(starts.size), 0))
        more = np.concatenate((~starts[1:], [False]))
        emit = ~starts | more
        if old:
            emit[0] = False
        begin = int(at[-1])
        first = table[:, begin]
        told = begin < starts.size - 1 or (old and begin == 0)
        rows = table[:, emit]
        heads = table[:, at[emit]]
        kinds = (np.int64, np.int64, np.int32, np.int32, np.int64, np.int32, np.int32)
        names = ("token", "cls", "n", "place", "first_cls", "first_n", "first_place")
        yield pa.RecordBatch.from_pydict({
            name: pa.array(values.astype(kind)) for name, kind, values in zip(names, kinds, (*rows, *heads[1:]))
        })


def _fits(a_n: str, a_place: str, b_n: str, b_place: str):
    """Whether sizes and places allow the overlap; a place is the first that two sets share."""
    needed = _NEEDED.format(a=a_n, b=b_n)
    return F.expr(f"5 * least({a_n}, {b_n}) >= 4 * greatest({a_n}, {b_n}) and least({a_n} - {a_place}, {b_n} - {b_place}) >= {needed}")


def linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Those pairs ``a, b`` of classes whose sets overlap enough, by exact comparison."""
    bits = classes.select("cls", "n", "bits")
    sides = [bits.select(*[F.col(c).alias(f"{side}_{c}") for c in bits.columns]) for side in "ab"]
    near = pairs.join(sides[0], F.col("a") == F.col("a_cls")).join(sides[1], F.col("b") == F.col("b_cls"))
    near = near.select("a", "b", "a_n", "b_n", "a_bits", "b_bits").where("5 * least(a_n, b_n) >= 4 * greatest(a_n, b_n)")

    def bounded(batch: pa.RecordBatch) -> dict:
        a, b, a_n, b_n, x, y = (column.to_pylist() for column in batch.columns)
        keep = [9 * least_difference(p, q) <= n + m for p, q, n, m in zip(x, y, a_n, b_n)]
        return {"a": batch.column(0).filter(pa.array(keep)), "b": batch.column(1).filter(pa.array(keep))}

    near = staged(map_arrow(near, bounded, "a bigint, b bigint"), "near")
    wanted = near.select(F.col("a").alias("cls")).unionAll(near.select("b")).distinct()
    listed = staged(classes.join(wanted, "cls").select(F.col("doc_id").alias("_doc_id")).distinct(), "ids")
    ids = F.broadcast(listed) if listed.count() <= BROADCAST_IDS else listed

    def sets(batch: pa.RecordBatch) -> dict:
        found = [own for own in distinct_runs(Words(batch.column(1)), SHINGLE_WORDS) if own.size]
        return {"cls": pa.array([class_hash(s) for s in found], pa.int64()), "tokens": pa.array([s.tobytes() for s in found], pa.binary())}

    # Equal sets of several rows that repeat an id are compared more than once, at no harm.
    texts = docs.join(ids, docs["doc_id"].eqNullSafe(F.col("_doc_id")), "left_semi")
    tokens = staged(map_arrow(texts, sets, "cls bigint, tokens binary"), "sets")
    both = near.join(tokens.select(F.col("cls").alias("a"), F.col("tokens").alias("x")), "a")
    both = both.join(tokens.select(F.col("cls").alias("b"), F.col("tokens").alias("y")), "b").select("a", "b", "x", "y")

    def compared(batch: pa.RecordBatch) -> dict:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            same = np.intersect1d(p, q, assume_unique=True).size
            keep.append(9 * same >= 4 * (p.size + q.size))
        return {"a": batch.column(0).filter(pa.array(keep)), "b": batch.column(1).filter(pa.array(keep))}

    found = staged(map_arrow(both, compared, "a bigint, b bigint"), "linked")
    discard(near, listed, tokens)
    return found


def between_groups(shared: DataFrame, groups: DataFrame, classes: DataFrame, nearest: bool = False) -> DataFrame:
    """Pairs of classes from different groups whose bounds allow a link; ``nearest``: the best of each class only.

    A row of the matrix that many classes share is cut into blocks of about
    ``BLOCK_ROWS``, and each pair of blocks is looked at in a task of its own.
    """
    placed = shared.join(groups, F.col("cls") == F.col("node"), "left")
    placed = placed.select("token", "cls", "n", "place", F.coalesce("root", "cls").alias("grp"))
    several = placed.groupBy("token").agg(F.min("grp").alias("x"), F.max("grp").alias("y"), F.count("*").alias("rows")).where("x <> y")
    blocks = several.select("token", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("blocks"))
    placed = placed.join(blocks, "token").join(classes.select("cls", F.col("few_bits").alias("bits")), "cls")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("grp", "cls"), "blocks").cast("int"))
    dealt = placed.select("*", F.explode(F.expr("sequence(0, blocks - 1)")).alias("facing")).select(
        "token", F.least("block", "facing").alias("low"), F.greatest("block", "facing").alias("high"),
        "grp", "cls", "n", "place", "block", "bits",
    )
    ordered = dealt.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high", "grp", "cls")
    return ordered.mapInArrow(partial(_open_groups, nearest), "a bigint, b bigint").distinct()


def _open_groups(nearest: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All whole rows of the matrix in a batch are looked at together; the last one waits for its rest."""
    rest, rest_bits = np.zeros((8, 0), np.int64), []
    for batch in batches:
        rows = np.stack([column.to_numpy().astype(np.int64) for column in batch.columns[:8]])
        rows = np.concatenate((rest, rows), 1)
        bits = rest_bits + batch.column(8).to_pylist()
        cuts = np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(0))
        cut = int(cuts[-1]) + 1 if cuts.size else 0
        yield _near_pairs(rows[:, :cut], bits[:cut], nearest)
        rest, rest_bits = rows[:, cut:], bits[cut:]
    yield _near_pairs(rest, rest_bits, nearest)


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each place as often as its count says, and the numbers from 0 on of its repeats."""
    each = np.repeat(np.arange(counts.size), counts)
    return each, np.arange(each.size) - np.repeat(np.cumsum(counts) - counts, counts)


def _near_pairs(rows: np.ndarray, bits: list[bytes], nearest: bool) -> pa.RecordBatch:
    """Pairs within rows of the matrix, each sorted by group: query and group first, then query and member."""
    _, low, high, groups, classes, n, place, block = rows
    found = [np.zeros((2, 0), np.int64)]
    if n.size > 1:
        first = np.concatenate(([True], (rows[:3, 1:] != rows[:3, :-1]).any(0)))
        opens = first | np.concatenate(([True], groups[1:] != groups[:-1]))
        starts, own = np.flatnonzero(opens), np.cumsum(opens) - 1
        ends = np.concatenate((starts[1:], [n.size]))
        least, most = np.minimum.reduceat(n, starts), np.maximum.reduceat(n, starts)
        left = np.maximum.reduceat(n - place, starts)
        # The groups after its own in its row are those a query is compared with.
        row_starts = np.flatnonzero(first)
        row_end = np.concatenate((row_starts[1:], [n.size]))[np.cumsum(first) - 1]
        later_groups, later = own[row_end - 1] - own, row_end - ends[own]
        part = (np.cumsum(later) - later) // PAIRS
        bounds = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
        for begin, end in zip(bounds, bounds[1:]):
            q, g = _spread(later_groups[begin:end])
            q += begin
            g += own[q] + 1
            size, rest = n[q], (n - place)[q]
            needed = (4 * (size + np.maximum(least[g], (4 * size + 4) // 5)) + 8) // 9
            opened = (5 * most[g] >= 4 * size) & (4 * least[g] <= 5 * size) & (np.minimum(rest, left[g]) >= needed)
            q, g = q[opened], g[opened]
            at, b = _spread(ends[g] - starts[g])
            a, b = q[at], starts[g][at] + b
            fits = 5 * np.minimum(n[a], n[b]) >= 4 * np.maximum(n[a], n[b])
            fits &= 9 * np.minimum(n[a] - place[a], n[b] - place[b]) >= 4 * (n[a] + n[b])
            fits &= (low[a] == high[a]) | (block[a] != block[b])
            a, b = a[fits], b[fits]
            over = 9 * differences(bits, a, b) - n[a] - n[b]
            near = over <= 0
            a, b, over = a[near], b[near], over[near]
            if nearest:
                order = np.lexsort((over, a))
                best = order[np.unique(a[order], return_index=True)[1]]
                a, b = a[best], b[best]
            found.append(np.stack((classes[a], classes[b])))
    pairs = np.concatenate(found, 1)
    return pa.RecordBatch.from_pydict({"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})


def differences(bits: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """:func:`least_difference` of many pairs, given by their places in ``bits``."""
    sizes = np.array([len(own) // 8 for own in bits], np.int64)
    words, starts = np.frombuffer(b"".join(bits), np.uint64), np.cumsum(sizes) - sizes
    found = np.zeros(a.size, np.int64)
    kinds = sizes[a] << 32 | sizes[b]
    for kind in np.unique(kinds).tolist():
        own, other = kind >> 32, kind & 0xFFFFFFFF
        common, every = min(own, other), np.flatnonzero(kinds == kind)
        for begin in range(0, every.size, COMPARED):
            at = every[begin:begin + COMPARED]
            x, y = (
                np.bitwise_xor.reduce(words[starts[side[at], None] + np.arange(size)].reshape(at.size, -1, common), 1)
                for side, size in ((a, own), (b, other))
            )
            found[at] = np.bitwise_count(x ^ y).sum(1)
    return found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``."""
    docs = only(docs, "doc_id", "text")
    with scratch() as keep:
        marked = keep(staged(signatures(docs), "signatures"))
        smallest = marked.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
        one = marked.select("cls", "doc_id", F.col("n_shingles").alias("n"), "bits", "few_bits").dropDuplicates(["cls"])
        classes = staged(one.drop("doc_id").join(smallest, "cls"), "classes")
        shared = staged(matrix(docs), "matrix")
        pairs = shared.where("cls <> first_cls").where(_fits("n", "place", "first_n", "first_place"))
        links = linked(pairs.select(F.col("first_cls").alias("a"), F.col("cls").alias("b")).distinct(), classes, docs)
        groups = staged(components(links), "groups")
        links = links.unionAll(linked(between_groups(shared, groups, classes, nearest=True), classes, docs))
        groups = staged(components(links), "groups")
        links = links.unionAll(linked(between_groups(shared, groups, classes), classes, docs))
        discard(shared)
        roots = components(links)
        placed = classes.join(roots, F.col("cls") == F.col("node"), "left")
        placed = placed.select("cls", "doc_id", F.coalesce("root", "cls").alias("root"))
        lowest = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        own = keep(staged(placed.join(lowest, "root").select("cls", "component_id"), "own"))
    found = marked.join(own, "cls", "left")
    return found.select("doc_id", "n_shingles", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with the document of lowest id left of each component; same columns.

    Rows without id stay. Rows that repeat an id stay or go together, and of
    equal ones with equal text one stays.
    """
    with scratch() as keep:
        found = keep(staged(near_duplicates(docs).where("doc_id is not null"), "components"))
    ids = found.groupBy("doc_id").agg(F.max(F.expr("component_id = doc_id")).alias("stays"), F.count("*").alias("rows"))
    left = without(docs, ids.where("not stays").select("doc_id"))
    repeated = staged(ids.where("stays and rows > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return left
    return without(left, repeated).unionAll(without(left, repeated, keep=True).dropDuplicates(["doc_id", "text"]))


@query("op2_jaccard_groups")
def op2_jaccard_groups(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"))
