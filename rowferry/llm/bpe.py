"""Byte-level BPE from a rank file, encoding and decoding.

Each match of the split pattern is merged separately. A segment tree over its
byte positions holds, at each position where a token starts, the rank of the
pair of that token and the next; the root is the leftmost pair of lowest rank.
A merge changes three positions, each in logarithmic time, so that a match of
a million bytes takes no quadratic time.

Null text counts as empty and gives no ids. Ranks must cover all 256 bytes.
"""

from __future__ import annotations

import base64
import hashlib
from array import array

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from rowferry.llm.common import map_arrow, only, query, strings, table
from rowferry.llm.pieces import PieceCache

RANK_FILE = "byte_bpe_50k.tiktoken"

Ranks = dict[bytes, int]


def read_ranks(path: str) -> Ranks:
    """Tokens and their ranks from a file of base64 tokens and numbers."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merge(match: bytes, ranks: Ranks) -> list[int]:
    """Ids of one match of the split pattern."""
    known = ranks.get(match)
    if known is not None:
        return [known]
    count = len(match)
    bits = (count - 1).bit_length()
    size = 1 << bits
    none = len(ranks) << bits  # above every key
    get, nxt, before, mask = ranks.get, list(range(1, count + 2)), list(range(-1, count)), size - 1
    tree = [none] * (2 * size)
    for at in range(count - 1):
        rank = get(match[at:at + 2])
        if rank is not None:
            tree[size + at] = rank << bits | at
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right

    def put(at: int, key: int) -> None:
        node = size + at
        tree[node] = key
        while node > 1:
            other = tree[node ^ 1]
            node >>= 1
            if other < key:
                key = other
            if tree[node] == key:
                return
            tree[node] = key

    while (root := tree[1]) != none:
        at = root & mask
        gone = nxt[at]
        after = nxt[gone]
        nxt[at] = after
        if after <= count:
            before[after] = at
        put(gone, none)
        rank = get(match[at:nxt[after]]) if after < count else None
        put(at, none if rank is None else rank << bits | at)
        left = before[at]
        if left >= 0:
            rank = get(match[left:after])
            put(left, none if rank is None else rank << bits | left)
    found, at = [], 0
    while at < count:
        found.append(ranks[match[at:nxt[at]]])
        at = nxt[at]
    return found


class ByteBpe:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.split = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.cache = PieceCache(self._pieces)

    def _match(self, match: str) -> bytes:
        found = self.known.get(match)
        if found is None:
            found = array("I", merge(match.encode(), self.ranks)).tobytes()
            if len(self.known) >= 2 * self.cache.limit:
                self.known.clear()
            self.known[match] = found
        return found

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        return [b"".join(map(self._match, self.split.findall(piece))) for piece in pieces]

    def encode(self, text: str) -> bytes:
        """Ids as unsigned 32-bit integers, lowest byte first."""
        return self.cache.ids(text)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


_ready: dict[tuple[str, str], ByteBpe] = {}


def coder(path: str, pattern: str) -> ByteBpe:
    """One coder in each Python worker, kept over tasks."""
    if (path, pattern) not in _ready:
        _ready[path, pattern] = ByteBpe(path, pattern)
    return _ready[path, pattern]


def encode_texts(docs: DataFrame, path: str, pattern: str, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``ids``, the ids as bytes of unsigned 32-bit integers; no shuffle.

    One row for each row of ``docs``, repeated and null ids included.
    """
    def work(batch: pa.RecordBatch) -> dict:
        encode = coder(path, pattern).encode
        return {"doc_id": batch.column(0), "ids": pa.array([encode(t) for t in strings(batch.column(1))], pa.binary())}

    return map_arrow(only(docs, id_column, text_column), work, f"doc_id {docs.schema[id_column].dataType.simpleString()}, ids binary")


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded``, the bytes that the ids stand for."""
    def work(batch: pa.RecordBatch) -> dict:
        decode = coder(path, pattern).decode
        return {
            "doc_id": batch.column(0), "ids": batch.column(1),
            "decoded": pa.array([decode(ids) for ids in batch.column(1).to_pylist()], pa.binary()),
        }

    return map_arrow(encoded, work, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, ids binary, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``, coded and decoded in one pass.

    The ids stay in the worker, so only the digests return to Spark.
    """
    def work(batch: pa.RecordBatch) -> dict:
        own = coder(path, pattern)
        coded = [own.encode(t) for t in strings(batch.column(1))]
        return {
            "doc_id": batch.column(0),
            "n_tokens": pa.array([len(ids) // 4 for ids in coded], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(ids).hexdigest() for ids in coded], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(own.decode(ids)).hexdigest() for ids in coded], pa.string()),
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(only(docs, "doc_id", "text"), work, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


@query("op9_byte_bpe")
def op9_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return digests(table(spark, sf, "documents"), public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
