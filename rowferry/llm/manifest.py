"""Merkle manifest of a dataset, and what becomes of its root when leaves are tampered with.

A leaf is the digest of one row. The leaves of a language, by ``doc_id``, are
joined eight at a time until one node is left; the nodes of all languages are
joined the same way to the root.

1. Leaves are DataFrame expressions; texts are never shuffled. Rows are
   numbered within their language by range partitions and one count for each
   range and language.
2. ``8 ** BLOCK_LEVELS`` consecutive nodes are an aligned block. A block is a
   persistent tree of one task; its top is a node of the next pass, until one
   node is left. So a pass takes a share of ``1 / 4096`` of the one before.
3. From the last pass back to the leaves, each block gets the way from its top
   to the root, and gives each of its nodes the way from there. No row of a
   hot language is in a group of more than one block.
4. Each tampered leaf makes a version of its block's tree that copies the
   leaf's ancestors and shares all other nodes with the first version. The way
   above the block carries the version on to its root, inside the same task.

Order: a null ``lang`` first, then bytewise; in a language a null ``doc_id``
first, equal ids by their leaf, so that repeated rows always give the same
tree. A null ``doc_id`` is never tampered with. A ``doc_id`` that is text is
ordered as text. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowferry.llm.common import only, query, staged, table
from rowferry.operators.numbering import broadcast_if_small

# Fixed values of the manifest's format.
FAN_OUT = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

BLOCK_LEVELS = 4
TAMPERED_SHARE = 3

_WAY = "array<struct<before:binary,after:binary>>"
_ABOVE = f"way {_WAY}, subroot binary, root binary"
_PLACE_BITS = 33


def digest(*parts: bytes) -> bytes:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


@dataclass(frozen=True)
class Node:
    """A node of a persistent tree: never changed, shared by all versions that hold it."""

    digest: bytes
    children: tuple[Node, ...] = ()


def grow(digests: list[bytes], levels: int) -> Node:
    """A tree over the given digests; with no levels, the only digest itself."""
    nodes = [Node(own) for own in digests]
    for _ in range(levels):
        runs = [tuple(nodes[i:i + FAN_OUT]) for i in range(0, len(nodes), FAN_OUT)]
        nodes = [Node(digest(*[child.digest for child in run]), run) for run in runs]
    return nodes[0]


def changed(node: Node, place: int, levels: int, own: bytes) -> Node:
    """A version of the tree with another digest at ``place``; only its ancestors are copied."""
    if not levels:
        return Node(own)
    at, rest = divmod(place, FAN_OUT ** (levels - 1))
    children = node.children[:at] + (changed(node.children[at], rest, levels - 1, own),) + node.children[at + 1:]
    return Node(digest(*[child.digest for child in children]), children)


def way(node: Node, place: int, levels: int) -> list[tuple[bytes, bytes]]:
    """Siblings before and after each node on the way from ``place`` to the top, lowest first."""
    found = []
    for level in reversed(range(levels)):
        at, place = divmod(place, FAN_OUT ** level)
        found.append((
            b"".join(child.digest for child in node.children[:at]),
            b"".join(child.digest for child in node.children[at + 1:]),
        ))
        node = node.children[at]
    return found[::-1]


def levels_of(size: int, most: int) -> int:
    """Levels above ``size`` nodes until one is left, at most ``most``."""
    levels = 0
    while levels < most and FAN_OUT ** levels < size:
        levels += 1
    return levels


def leaf(text: Column) -> Column:
    """The digest of a row, with ``text`` in the place of its text."""
    fields = [F.col(f"`{name}`").cast("string") for name in FIELDS[:-1]] + [text]
    parts = [F.coalesce(F.concat(F.octet_length(field).cast("string"), F.lit(":"), field), F.lit("-")) for field in fields]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """``tree, doc_id, own, other``: each row's language as a sort key, its leaf, and the tampered one or null."""
    lower = F.translate("text", UPPER, UPPER.lower())
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPERED_SHARE == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("1"), F.col("lang").cast("string")), F.lit("0")).alias("tree"), "doc_id",
        F.unhex(leaf(F.col("text"))).alias("own"), F.when(hit, F.unhex(leaf(lower))).alias("other"),
    )


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows``, staged, with ``place`` in their ``tree`` and its ``total``; no single-task window.

    Rows equal in ``order`` are spread by a random last key.
    """
    keys = [F.col("tree"), *[F.col(name) for name in order], F.col("spread")]
    dealt = rows.withColumn("spread", F.rand(0)).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("spread")
    placed = staged(dealt.withColumn("at", F.monotonically_increasing_id()), "manifest-rows")
    ranges = F.shiftright("at", _PLACE_BITS).alias("part")
    counts = placed.groupBy("tree", ranges).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    # One row for each range and tree in it.
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(counts.select(
        F.col("tree").alias("t"), F.col("part").alias("p"), "first",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(tree).alias("total"),
    ), "manifest-ranges")
    same = (F.col("tree") == F.col("t")) & (F.shiftright("at", _PLACE_BITS) == F.col("p"))
    joined = placed.join(broadcast_if_small(starts), same)
    return joined.select(*rows.columns, (F.col("at") - F.col("first") + F.col("start")).alias("place"), "total")


def by_block(nodes: DataFrame, block: int) -> DataFrame:
    """``nodes`` with the number of their ``block`` and their place in it."""
    size = F.lit(FAN_OUT ** block)
    return nodes.withColumn("block", F.floor(F.col("place") / size)).withColumn("place", (F.col("place") % size).cast("int"))


def _tree(part: pa.Table, block: int) -> tuple[pa.Table, Node, int]:
    """The rows of a block in order, their tree and its levels."""
    part = part.sort_by("place")
    levels = levels_of(part["total"][0].as_py(), block)
    return part, grow([own.hex().encode() for own in part["own"].to_pylist()], levels), levels


def tops(nodes: DataFrame, block: int) -> DataFrame:
    """``tree, place, own, total``: the top node of each block of ``nodes``, as nodes of the next pass."""
    def top(part: pa.Table) -> pa.Table:
        _, tree, _ = _tree(part, block)
        total = -(-part["total"][0].as_py() // FAN_OUT ** block)
        return pa.table({
            "tree": part["tree"][:1], "place": part["block"][:1],
            "own": pa.array([bytes.fromhex(tree.digest.decode())], pa.binary()), "total": pa.array([total], pa.int64()),
        })

    blocks = by_block(nodes.select("tree", "place", "own", "total"), block).groupBy("tree", "block")
    return blocks.applyInArrow(top, "tree string, place bigint, own binary, total bigint")


def passes(nodes: DataFrame, block: int) -> list[DataFrame]:
    """``nodes`` and the tops of their blocks, pass after pass, until each tree has one node."""
    found = [nodes]
    while not found[-1].where("total > 1").isEmpty():
        found.append(staged(tops(found[-1], block), "manifest-tops"))
    return found


def _ways(part: pa.Table, above: pa.Table, block: int) -> Iterator[tuple[int, Node, int, list[tuple[bytes, bytes]]]]:
    """For each row of a block: its place, the tree, its levels, and the way to the root, through the way above."""
    on = [(step["before"], step["after"]) for step in above["way"][0].as_py()]
    _, tree, levels = _tree(part, block)
    for place in range(part.num_rows):
        yield place, tree, levels, way(tree, place, levels) + on


def _repeated(part: pa.Table, name: str, rows: int) -> pa.Array:
    return pa.array(part[name][:1].to_pylist() * rows, pa.binary())


def ways_below(nodes: DataFrame, above: DataFrame, block: int) -> DataFrame:
    """``nodes`` as ``tree, place, way, subroot, root``, from the ways of their blocks."""
    def ways(part: pa.Table, way_above: pa.Table) -> pa.Table:
        found = [[{"before": b, "after": a} for b, a in steps] for _, _, _, steps in _ways(part, way_above, block)]
        first = part["block"][0].as_py() * FAN_OUT ** block
        return pa.table({
            "tree": part["tree"], "place": pa.array(range(first, first + part.num_rows), pa.int64()),
            "way": pa.array(found, pa.list_(pa.struct([("before", pa.binary()), ("after", pa.binary())]))),
            "subroot": _repeated(way_above, "subroot", part.num_rows), "root": _repeated(way_above, "root", part.num_rows),
        })

    blocks = by_block(nodes.select("tree", "place", "own", "total"), block).groupBy("tree", "block")
    return blocks.cogroup(above.groupBy("tree", "place")).applyInArrow(ways, f"tree string, place bigint, {_ABOVE}")


def folded(own: bytes, steps: list[tuple[bytes, bytes]]) -> bytes:
    """The digest at the end of the way from a node with the digest ``own``."""
    return reduce(lambda below, step: digest(step[0], below, step[1]), steps, own)


def ways_to_root(subroots: DataFrame, block: int) -> DataFrame:
    """``tree, place, way, subroot, root``: the way from the subroot of each language to the root."""
    over = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("lang_key"), "own")
    over = numbered(over, ["lang_key"])
    levels = passes(over, block)
    no_way = F.array().cast(_WAY).alias("way")
    ways = levels[-1].select("tree", "place", no_way, F.col("own").alias("subroot"), F.col("own").alias("root"))
    for nodes in levels[-2::-1]:
        ways = ways_below(nodes, ways, block)
    found = over.join(ways.select("place", "way", "root"), "place")
    return staged(found.select(
        F.col("lang_key").alias("tree"), F.lit(0).cast("bigint").alias("place"), "way", F.col("own").alias("subroot"), "root",
    ), "manifest-subroots")


def manifest(docs: DataFrame, block: int = BLOCK_LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    ``block`` is how many levels of a tree one task builds; any number gives the same rows.
    """
    docs = only(docs, *FIELDS)
    rows = numbered(leaves(docs), ["doc_id", "own"])
    levels = passes(rows, block)
    ways = ways_to_root(levels[-1], block)
    for nodes in levels[-2:0:-1]:
        ways = staged(ways_below(nodes, ways, block), "manifest-ways")
    return versions(rows, ways, block)


def versions(rows: DataFrame, above: DataFrame, block: int) -> DataFrame:
    """The rows of the manifest: each leaf with its proof and the root of its own version."""
    def made(part: pa.Table, way_above: pa.Table) -> pa.Table:
        ordered = part.sort_by("place")
        owns, others = ordered["own"].to_pylist(), ordered["other"].to_pylist()
        subroot, root = (way_above[name][0].as_py().hex() for name in ("subroot", "root"))
        proofs, roots = [], []
        for place, tree, levels, steps in _ways(part, way_above, block):
            version = tree if others[place] is None else changed(tree, place, levels, others[place].hex().encode())
            proofs.append(digest(*[side for step in steps for side in step]).decode())
            roots.append(folded(version.digest, steps[levels:]).decode())
        return pa.table({
            "doc_id": ordered["doc_id"], "leaf": pa.array([own.hex() for own in owns], pa.string()),
            "subroot": pa.array([subroot] * len(owns), pa.string()), "root": pa.array([root] * len(owns), pa.string()),
            "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(roots, pa.string()),
            "verified": pa.array([found == root for found in roots], pa.bool_()),
        })

    kind = rows.schema["doc_id"].dataType.simpleString()
    names = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    blocks = by_block(rows, block).groupBy("tree", "block")
    return blocks.cogroup(above.groupBy("tree", "place")).applyInArrow(made, f"doc_id {kind}, {names}")


# Checksum of ASCII text, a bit at a time: each byte enters at the first of its eight steps.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    range(1, length(d) + 1), lambda i: [ascii(substr(d, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"""


def _leaf_sql(text: str) -> str:
    fields = [*[f"{name}::VARCHAR" for name in FIELDS[:-1]], text]
    return f"sha256({' || '.join(f"coalesce(strlen({field}) || ':' || {field}, '-')" for field in fields)})"


ORACLE = f"""
WITH RECURSIVE ids AS (
    SELECT doc_id, {_CRC32} % {TAMPERED_SHARE} = 0 AS hit FROM (SELECT doc_id, doc_id::VARCHAR AS d FROM documents)
), leaves AS (
    SELECT doc_id, lang, {_leaf_sql('text')} AS leaf,
        CASE WHEN hit THEN {_leaf_sql(f"translate(text, '{UPPER}', '{UPPER.lower()}')")} END AS other,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY lang) AS total
    FROM documents JOIN ids USING (doc_id)
), nodes AS (
    SELECT 0 AS level, lang, place, total, leaf AS own FROM leaves
    UNION ALL
    SELECT level + 1, lang, place // {FAN_OUT}, (total + {FAN_OUT - 1}) // {FAN_OUT}, sha256(string_agg(own, '' ORDER BY place))
    FROM nodes WHERE total > 1 GROUP BY level, lang, place // {FAN_OUT}, total
), subroots AS (
    SELECT lang, own AS subroot, level AS depth, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place, count(*) OVER () AS total
    FROM nodes WHERE total = 1
), tops AS (
    SELECT 0 AS level, place, total, subroot AS own FROM subroots
    UNION ALL
    SELECT level + 1, place // {FAN_OUT}, (total + {FAN_OUT - 1}) // {FAN_OUT}, sha256(string_agg(own, '' ORDER BY place))
    FROM tops WHERE total > 1 GROUP BY level, place // {FAN_OUT}, total
), steps AS (
    SELECT *, coalesce(string_agg(own, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
        coalesce(string_agg(own, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM (SELECT 'leaves' AS part, level, lang, place, own FROM nodes WHERE total > 1
          UNION ALL SELECT 'tops', level, NULL, place, own FROM tops WHERE total > 1)
    WINDOW run AS (PARTITION BY part, level, lang, place // {FAN_OUT} ORDER BY place)
), ways AS (
    SELECT doc_id, lang, leaf, 'leaves' AS part, 0 AS level, place, coalesce(other, leaf) AS own, '' AS proof FROM leaves
    UNION ALL
    SELECT w.doc_id, w.lang, w.leaf,
        CASE WHEN s.part IS NULL THEN 'tops' ELSE w.part END,
        CASE WHEN s.part IS NULL THEN 0 ELSE w.level + 1 END,
        CASE WHEN s.part IS NULL THEN r.place ELSE w.place // {FAN_OUT} END,
        CASE WHEN s.part IS NULL THEN w.own ELSE sha256(s.before || w.own || s.after) END,
        w.proof || coalesce(s.before, '') || coalesce(s.after, '')
    FROM ways w JOIN subroots r ON r.lang IS NOT DISTINCT FROM w.lang
    LEFT JOIN steps s ON s.part = w.part AND s.level = w.level AND s.place = w.place
        AND (w.part = 'tops' OR s.lang IS NOT DISTINCT FROM w.lang)
    WHERE s.part IS NOT NULL OR w.part = 'leaves'
)
SELECT w.doc_id, w.leaf, r.subroot, t.own AS root, sha256(w.proof) AS proof_sha256, w.own AS folded_root, w.own = t.own AS verified
FROM ways w JOIN subroots r ON r.lang IS NOT DISTINCT FROM w.lang, (SELECT own, level FROM tops WHERE total = 1) t
WHERE w.part = 'tops' AND w.level = t.level
"""


@query("op11_merkle_manifest", ORACLE)
def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return manifest(table(spark, sf, "documents"))
