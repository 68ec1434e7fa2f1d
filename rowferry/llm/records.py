"""Token ids as files of length-delimited binary records, with an offset index.

A record file is a run of frames::

    length of the payload        unsigned 64 bits
    masked checksum of those 8 bytes   32 bits
    payload
    masked checksum of the payload     32 bits

and a payload is ``doc_id`` (64 bits), the width of an id in bytes (8 bits),
flags (8 bits, 1: the doc_id is null), then the ids. Everything has its lowest
byte first. A checksum is CRC-32, turned right by 15 bits, plus a constant, so
that a checksum stored as data isn't its own. Beside each file lies an index
of fixed-width entries (``INDEX_ENTRY``), so that a reader can open any record
alone, in any order.

Documents are dealt by ranges of ``doc_id``; each task writes its range in
order, in files of bounded size under names of its own attempt. What counts is
the manifest: it names the files of the attempts that succeeded, so a repeated
task leaves at most files that nobody reads.

Null text counts as empty. Null ids come first. Rows that repeat a ``doc_id``
are kept, ordered by their text.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowferry.llm.common import map_arrow, only, query, strings, table
from rowferry.llm.pieces import PieceCache, odd
from rowferry.session import staging_path

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
FILE_BYTES = 64 << 20
MAX_READERS = 10_000
# Words that go to the library as one text, and how its byte-level tokens spell a space.
JOINED = 500
_SPACE = "\u0120"

INDEX_ENTRY = np.dtype([("offset", "<u8"), ("length", "<u8"), ("doc_id", "<i8"), ("ids_before", "<u8"), ("null_id", "u1")])

MANIFEST = "part int, number int, path string, records bigint, ids bigint, bytes bigint"

_MASK_DELTA = 0xA282EAD8
_HEAD = 10


def masked(data: bytes) -> int:
    """The masked checksum of ``data``."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = len(payload).to_bytes(8, "little")
    return b"".join((length, masked(length).to_bytes(4, "little"), payload, masked(payload).to_bytes(4, "little")))


def pack(doc_id: int | None, ids: np.ndarray) -> bytes:
    """The payload of one document; ids under 65,536 take two bytes each."""
    width = 2 if not ids.size or int(ids.max()) < 1 << 16 else 4
    head = (doc_id or 0).to_bytes(8, "little", signed=True) + bytes([width, doc_id is None])
    return head + ids.astype(f"<u{width}").tobytes()


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id = None if payload[9] else int.from_bytes(payload[:8], "little", signed=True)
    return doc_id, np.frombuffer(payload, f"<u{payload[8]}", offset=_HEAD).astype("<u4")


def read_frame(stream) -> bytes | None:
    """The next payload, or None at the end; a damaged frame raises."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or masked(head[:8]) != int.from_bytes(head[8:], "little"):
        raise ValueError("the length of a record is damaged")
    length = int.from_bytes(head[:8], "little")
    payload, check = stream.read(length), stream.read(4)
    if len(payload) < length or masked(payload) != int.from_bytes(check, "little"):
        raise ValueError("a record is damaged")
    return payload


def record_at(path: str, number: int) -> tuple[int | None, np.ndarray]:
    """One record of a file through its index, without reading the others."""
    system, name = fs.FileSystem.from_uri(path)
    with system.open_input_file(index_of(name)) as index:
        index.seek(number * INDEX_ENTRY.itemsize)
        entry = np.frombuffer(index.read(INDEX_ENTRY.itemsize), INDEX_ENTRY)[0]
    with system.open_input_file(name) as records:
        records.seek(int(entry["offset"]))
        return unpack(read_frame(records))


def index_of(path: str) -> str:
    return path.removesuffix(".records") + ".index"


class _File:
    """One record file and its index while they are written."""

    def __init__(self, folder: str, part: int, number: int):
        self.part, self.number = part, number
        self.path = f"{folder}/part-{part:06}-{number:05}-{uuid.uuid4().hex}.records"
        self.system, self.name = fs.FileSystem.from_uri(self.path)
        self.system.create_dir(os.path.dirname(self.name), recursive=True)
        self.stream = self.system.open_output_stream(self.name)
        self.bytes = self.ids = 0
        self.entries: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        framed = frame(pack(doc_id, ids))
        self.stream.write(framed)
        self.entries.append((self.bytes, len(framed), doc_id or 0, self.ids, doc_id is None))
        self.bytes += len(framed)
        self.ids += ids.size

    def close(self) -> dict:
        self.stream.close()
        with self.system.open_output_stream(index_of(self.name)) as index:
            index.write(np.array(self.entries, INDEX_ENTRY).tobytes())
        row = {"part": self.part, "number": self.number, "path": self.path, "records": len(self.entries), "ids": self.ids, "bytes": self.bytes}
        return {name: [value] for name, value in row.items()}


class Tokenizer:
    """Ids of texts from the tokenizers library, the end id appended to each."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        self.special = [token.content for token in self.library.get_added_tokens_decoder().values()]
        vocabulary = self.library.get_vocab()
        self.after_space = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.after_space[[number for token, number in vocabulary.items() if token.startswith(_SPACE)]] = True
        cutter = self.library.pre_tokenizer
        apart = cutter is not None and [part for part, _ in cutter.pre_tokenize_str(" a,")] == [_SPACE + "a", ","]
        self.cache = PieceCache(self._pieces, marks=apart)

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece; words after a space go to the library joined, since a call costs more than its ids."""
        found: list[bytes] = []
        for at in range(0, len(pieces), JOINED):
            some = pieces[at:at + JOINED]
            found += self._joined(some) or self._each(some)
        return found

    def _joined(self, pieces: list[str]) -> list[bytes] | None:
        """The same from one text; None where it can't be told apart by the spaces before its words."""
        text = "".join(pieces)
        if text.count(" ") != len(pieces) or not all(piece.startswith(" ") for piece in pieces):
            return None
        if odd(text[1:]) or any(token in text for token in self.special):
            return None
        data = self._each([text])[0]
        starts = np.flatnonzero(self.after_space[np.frombuffer(data, "<u4")])
        if starts.size != len(pieces):  # this vocabulary spells spaces in another way
            return None
        bounds = [*(4 * starts).tolist(), len(data)]
        return [data[start:end] for start, end in zip(bounds, bounds[1:])]

    def _each(self, texts: list[str]) -> list[bytes]:
        return [array("I", each.ids).tobytes() for each in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_all(self, texts: list[str], end_id: int) -> Iterator[np.ndarray]:
        """Ids of each text. One that spells out a special token goes to the library whole, which knows it."""
        end = end_id.to_bytes(4, "little")
        whole = [any(token in text for token in self.special) for text in texts]
        rest = self.cache.all_ids([text for text, spelled in zip(texts, whole) if not spelled])
        for text, spelled in zip(texts, whole):
            yield np.frombuffer((self._pieces([text])[0] if spelled else next(rest)) + end, "<u4")


_ready: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """One tokenizer in each Python worker, kept over tasks."""
    if path not in _ready:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _ready[path] = Tokenizer(path)
    return _ready[path]


def write_records(
    docs: DataFrame, folder: str, vocabulary: str, *, end_id: int = END_ID, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Encode ``docs`` into record files below ``folder``; gives the manifest.

    ``folder`` is a URI that executors reach through ``pyarrow.fs``. The
    columns of the manifest are those of ``MANIFEST``; it is written beside
    the files and has one row per file, in ascending order of documents by
    ``part`` and ``number``.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, file = TaskContext.get().partitionId(), 0, None
        encode_all = tokenizer(vocabulary).encode_all
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode_all(strings(batch.column(1)), end_id)):
                if file is None:
                    file = _File(folder, part, number)
                file.add(doc_id, ids)
                if file.bytes >= file_bytes:
                    yield _row(file.close())
                    file, number = None, number + 1
        if file is not None:
            yield _row(file.close())

    def _row(columns: dict) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns.values(), kinds)], names=list(columns))

    ordered = only(docs, "doc_id", "text").repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    manifest = ordered.mapInArrow(work, MANIFEST)
    path = f"{folder}/manifest"
    manifest.write.parquet(path)
    return docs.sparkSession.read.schema(manifest.schema).parquet(path)


def read_records(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every record in the files.

    ``start`` counts the ids of all records before it. One task reads one file
    at a time, frame by frame, and verifies each checksum. The window orders
    the manifest only, a row for each file.
    """
    def work(batch: pa.RecordBatch):
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            system, name = fs.FileSystem.from_uri(path)
            rows: list[tuple] = []
            with system.open_input_stream(name) as stream:
                while (payload := read_frame(stream)) is not None:
                    doc_id, ids = unpack(payload)
                    rows.append((doc_id, start, ids.size, zlib.crc32(ids.tobytes())))
                    start += ids.size
                    if len(rows) == 10_000:
                        yield columns(rows)
                        rows = []
            yield columns(rows)

    def columns(rows: list[tuple]) -> dict:
        names = ("doc_id", "start", "n_tokens", "ids_crc32")
        return {name: pa.array([row[i] for row in rows], pa.int64()) for i, name in enumerate(names)}

    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    files = files.repartition(max(1, min(manifest.count(), MAX_READERS)), "path")
    return map_arrow(files, work, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


@query("op5_token_records")
def op5_token_records(spark: SparkSession, sf: str) -> DataFrame:
    manifest = write_records(
        table(spark, sf, "documents"), _uri(staging_path(spark, "records")), public_tokenizers.path(VOCABULARY),
    )
    return read_records(manifest)


def _uri(path: str) -> str:
    return path if ":/" in path else f"file://{os.path.abspath(path)}"
