"""Token ids, record files and word hashes against the libraries and plain versions."""

import base64
import hashlib
import random
import zlib
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from plain import random_texts, shingle_set, words
from tokenizers import Tokenizer

from rowferry.llm import bpe, pieces, records
from rowferry.llm.common import prepare
from rowferry.llm.words import Words, distinct_runs

PARTS = ["a", "the", "  ", " ", "\n", "\t", "é", "'s", "'", "12", "!", "\x1c", "\x85", "\xa0", "　", "\x00", "😀", "<|endoftext|>", "\r\n", "x" * 40]
EDGE = [None, "", " ", "  a  b ", "one two", "ab" * 2_000, "a" * 3_000, "𝒳 " * 200]
RANKS = public_tokenizers.path(bpe.RANK_FILE)


@pytest.fixture(scope="module")
def texts():
    return EDGE + random_texts(random.Random(11), PARTS, 600, 12)


@pytest.fixture(scope="module")
def encoding():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain_merge(match, ranks):
    parts = [match[i:i + 1] for i in range(len(match))]
    while True:
        pairs = [(ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        if not pairs or min(pairs)[0] == 1 << 30:
            return [ranks[part] for part in parts]
        at = min(pairs)[1]
        parts[at:at + 2] = [parts[at] + parts[at + 1]]


def test_segment_tree_merges_like_a_plain_search():
    source = random.Random(1)
    ranks = {bytes([i]): i for i in range(256)}
    for _ in range(60):
        ranks.setdefault(bytes(source.choice(b"abc") for _ in range(source.randint(2, 5))), len(ranks))
    for _ in range(400):
        match = bytes(source.choice(b"abcd") for _ in range(source.randint(1, 33)))
        if match not in ranks:
            assert bpe.merge(match, ranks) == plain_merge(match, ranks)


def test_digests_are_those_of_the_library(spark, rows, texts, encoding):
    prepare(spark)
    docs = rows("doc_id bigint, ids int, text string", *[(i, 0, t) for i, t in enumerate(texts)], (None, 1, "a"), (0, 1, "a"))
    found = bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(found) == len(texts) + 2
    for row in found[:len(texts)]:
        text = texts[row.doc_id] or ""
        ids = array("I", encoding.encode_ordinary(text)).tobytes()
        assert (row.n_tokens, row.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest()), text
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_ids_decode_to_the_text(spark, rows):
    prepare(spark)
    coded = bpe.encode_texts(rows("doc_id bigint, text string", (1, "é\n x"), (2, None)), RANKS, public_tokenizers.PATTERN)
    back = bpe.decode_ids(coded, RANKS, public_tokenizers.PATTERN).collect()
    assert {row.doc_id: bytes(row.decoded).decode() for row in back} == {1: "é\n x", 2: ""}


def test_pieces_join_to_the_text_and_the_cache_stays_small(texts):
    cache = pieces.PieceCache(lambda own: [piece.encode() for piece in own], limit=20)
    for text in texts:
        if text:
            assert " ".join(pieces.cut(text)) == text
            assert cache.ids(text) == text.encode()
        assert len(cache.new) <= 20 or len(set(pieces.cut(text or " "))) > 20


def test_records_come_back_from_their_files(spark, rows, texts, tmp_path):
    prepare(spark)
    path = public_tokenizers.path(records.VOCABULARY)
    docs = rows("doc_id bigint, text string, start int", *[(7 * i, t, 0) for i, t in enumerate(texts)], (None, "null id", 0), (7, "again", 0))
    manifest = records.write_records(docs, f"file://{tmp_path}/records", path, file_bytes=4_000)
    found = records.read_records(manifest).collect()
    library = Tokenizer.from_file(path)
    wanted = sorted([(-1, "null id"), (7, "again"), *[(7 * i, t or "") for i, t in enumerate(texts)]])
    start = 0
    ordered = sorted(found, key=lambda row: row.start)
    assert len(ordered) == len(wanted) and manifest.count() > 3
    for row, (doc_id, text) in zip(ordered, wanted):
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [0], "<u4")
        assert (row.doc_id, row.start, row.n_tokens) == (None if doc_id < 0 else doc_id, start, ids.size)
        assert row.ids_crc32 == zlib.crc32(ids.tobytes())
        start += ids.size
    first = manifest.orderBy("part", "number").first()
    assert records.record_at(first.path, 1)[0] == 0


def test_special_tokens_and_chunks_as_the_library_reads_them(texts, monkeypatch):
    library, own = (Kind(public_tokenizers.path(records.VOCABULARY)) for Kind in (Tokenizer.from_file, records.Tokenizer))
    own.cache.limit = 40
    monkeypatch.setattr(pieces, "CHUNK", 300)
    odd = [*["" if t is None else t for t in texts], "a<|endoftext|>b", "x " + "y" * 500 + " z", "<|endoftext|>"]
    wanted = [library.encode(text, add_special_tokens=False).ids + [0] for text in odd]
    assert [ids.tolist() for ids in own.encode_all(odd, 0)] == wanted
    assert wanted[-3] == [64, 50256, 65, 0]


def test_unknown_words_go_to_the_library_joined(texts):
    tokenizer = records.Tokenizer(public_tokenizers.path(records.VOCABULARY))
    words = sorted({piece for text in texts if text for piece in text.split() if "<|" not in piece} | {f"word{i}" for i in range(900)})
    pieces = [" " + word for word in words]
    odd = ["", " ", "  x", " a b", " a\n", " \u00a0a", " a\u2028b", "a", " b"]
    expected = [np.array(each.ids, "<u4").tobytes() for each in tokenizer.library.encode_batch(pieces + odd, add_special_tokens=False)]
    asked, each = [], tokenizer._each
    tokenizer._each = lambda some: asked.extend(some) or each(some)
    assert tokenizer._pieces(pieces) == expected[:len(pieces)]
    assert len(asked) <= len(pieces) / records.JOINED + 1
    tokenizer.special.append(pieces[0] + pieces[1])
    for first in range(len(odd)):
        assert tokenizer._pieces(pieces[:50] + odd[first:]) == expected[:50] + expected[len(pieces) + first:]


def test_words_are_encoded_apart_from_the_marks_after_them():
    library, own = (Kind(public_tokenizers.path(records.VOCABULARY)) for Kind in (Tokenizer.from_file, records.Tokenizer))
    ends = ["", ",", ".", "...", "!?", "'", "''", ".\nIt", ",\r\nit's", ".\n\n\ta", "_", "-x", "\u2019", ",\u00e9", "'s", "'s.", "\n."]
    texts = [f"The {word}{end} and {word}{end}" for word in ("word", "fa\u00e7\u00e0", "a1", "\u4e2d", "e\u0301", "don't", "'", "x.y", "\u00b2") for end in ends]
    wanted = [library.encode(text, add_special_tokens=False).ids + [0] for text in texts]
    assert [ids.tolist() for ids in own.encode_all(texts, 0)] == wanted
    asked, each = [], own._each
    own._each = lambda some: asked.extend(some) or each(some)
    list(own.encode_all(["so " + " ".join(f"unheard{end}" for end in (",", ".", ";", "?", ".\nIt", ""))], 0))
    assert sum(text.count("unheard") for text in asked) == 1


def test_records_of_an_empty_table(spark, rows, tmp_path):
    prepare(spark)
    manifest = records.write_records(rows("doc_id bigint, text string"), f"file://{tmp_path}/none", public_tokenizers.path(records.VOCABULARY))
    assert records.read_records(manifest).collect() == []


def test_damaged_records_are_noticed():
    import io

    framed = records.frame(records.pack(5, np.array([1, 70_000], "<u4")))
    assert records.unpack(records.read_frame(io.BytesIO(framed)))[1].tolist() == [1, 70_000]
    for at in (0, 9, 14, len(framed) - 1):
        broken = bytearray(framed)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            records.read_frame(io.BytesIO(bytes(broken)))
    assert records.read_frame(io.BytesIO(b"")) is None


def test_word_hashes_tell_words_apart():
    source, seen = random.Random(9), {}
    parts = ["a", "B", "é", "  ", "\n", "xyzxyzxyzw", "\x0b", "longer-than-eight", " ", "\x1c"]
    texts = [None, "", *random_texts(source, parts, 200, 9)]
    batch = pa.array(["before", *texts])[1:]
    own = Words(batch)
    for text, begin, end in zip(texts, own.rows, own.rows[1:]):
        wanted = words(text)
        assert end - begin == len(wanted)
        for word, value in zip(wanted, own.hashes[begin:end].tolist()):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)
    for text, found in zip(texts, distinct_runs(own, 5)):
        assert found.size == len(shingle_set(text))
