"""Language-model scores and manifests against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from plain import words

from rowferry.llm import manifest, ngram_model
from rowferry.llm.common import prepare

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, own string"


def documents(seed, count):
    source = random.Random(seed)
    found = [(None, None, None, None, None, "x"), (None, "A", "en", None, 1, None), (7, None, "de", "s", None, "y"), (8, "", "", "", 0, "")]
    for i in range(count):
        text = " ".join(source.choice(["the", "The", "of", "cat", "dog", "Ä", "\n", f"w{source.randint(0, 60)}"]) for _ in range(source.randint(0, 40)))
        found.append((20 + i, text, source.choice(["en", "en", "fr", None, "é"]), "s", len(text), "z"))
    return found + found[5:9] + [(500, "again", "en", None, 5, None)] * 5


def plain_scores(docs):
    """``doc_id, n_tokens, n_known, N, base, model`` with exact pair counts, and each token's count and pair."""
    singles, pairs = Counter(), Counter()
    sequences = [(i, ["<s>", *words(text), "</s>"]) for i, text, *_ in docs]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in sequences]
    for (_, own), out in zip(sequences, held):
        if not out:
            singles.update(own[1:])
            pairs.update(zip(own, own[1:]))
    texts, total = held.count(False), sum(singles.values())
    scale = total + 0.5 * (len(singles) + 1)

    def rounded(count):
        return ngram_model.MIDDLES[ngram_model.quantum(np.array([count]))[0]]

    found = []
    for (i, own), out in zip(sequences, held):
        base = sum(math.log10((singles[w] + 0.5) / scale) for w in own[1:])
        model = 0.0
        for v, w in zip(own, own[1:]):
            ahead = texts if v == "<s>" else rounded(singles[v])
            both = min(rounded(pairs[v, w]), max(ahead, 1))
            model += math.log10((both + ngram_model.PRIOR * (rounded(singles[w]) + 0.5) / scale) / (max(ahead, both) + ngram_model.PRIOR))
        found.append((i, out, len(own) - 1, sum(singles[w] > 0 for w in own[1:]), total, base, model))
    return found


def by_row(found):
    return sorted(found, key=lambda row: (row[0] is not None, row[0], row[2], row[5]))


@pytest.mark.parametrize("small", [False, True])
def test_scores_against_exact_counts(spark, rows, monkeypatch, small):
    """With many bits for each item hardly a count is wrong; many small slices give the same sums."""
    prepare(spark)
    monkeypatch.setattr(ngram_model, "segments", lambda rows, bits=0, made=ngram_model.segments: made(rows, 60.0))
    if small:
        for name, value in (("SHARD_TOKENS", 500), ("SLICE_BYTES", 2_000), ("SLICE_WORDS", 30)):
            monkeypatch.setattr(ngram_model, name, value)
    docs = documents(1, 150)
    found = by_row(map(tuple, ngram_model.scores(rows(DOCUMENTS, *docs)).collect()))
    wanted = by_row(plain_scores(docs))
    assert [row[:5] for row in found] == [row[:5] for row in wanted]
    assert np.allclose([row[5] for row in found], [row[5] for row in wanted], rtol=1e-12)
    assert np.allclose([row[6] for row in found], [row[6] for row in wanted], rtol=1e-3)


def test_filter_never_reads_too_low_and_seldom_too_high():
    source = np.random.default_rng(5)
    hashes = np.unique(source.integers(0, 1 << 63, 60_000).astype(np.uint64) * np.uint64(2))
    counts = np.minimum(source.zipf(1.6, hashes.size), 1 << 30)
    keys = hashes & ngram_model._KEY
    order = np.argsort(keys)
    bits, data = ngram_model.segment(keys[order], counts[order], ngram_model.BITS)
    own = ngram_model.Slice(1, 0, 1, np.array([bits], np.uint64), np.zeros(1, np.uint64), np.frombuffer(data, np.uint8))
    found, exact = own.counts(hashes), ngram_model.MIDDLES[ngram_model.quantum(counts)]
    assert (found >= exact).all() and (found > exact).mean() < 0.04
    assert (own.counts(hashes + np.uint64(1)) > 0).mean() < 0.04


def test_model_beats_tokens_alone_on_held_out_texts(spark, sf):
    found = ngram_model.op12_ngram_model(spark, sf).toPandas()
    out = found[found.held_out]
    assert len(out) and np.isfinite(found.score).all() and (found.score < 0).all()
    assert out.score.sum() / out.n_tokens.sum() > out.base_score.sum() / out.n_tokens.sum()


def test_scores_of_empty_tables_and_without_training(spark, rows):
    prepare(spark)
    assert ngram_model.scores(rows(DOCUMENTS)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    found = ngram_model.scores(rows(DOCUMENTS, (held, "a b", "en", "s", 3, ""))).first()
    assert tuple(found)[:5] == (held, True, 3, 0, 0) and abs(found.base_score) < 1e-12


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(docs, id_key=lambda i: i):
    """The manifest rows, by whole trees built anew for each tampered leaf."""
    lower = {i: i + 32 for i in range(65, 91)}

    def leaf(i, text, lang, source, n):
        return hashed(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)])

    def levels(nodes):
        found = [nodes]
        while len(found[-1]) > 1:
            found.append([hashed(*found[-1][i:i + 8]) for i in range(0, len(found[-1]), 8)])
        return found

    def siblings(tree, place):
        found = []
        for nodes in tree[:-1]:
            run = place // 8 * 8
            found += [own for at, own in enumerate(nodes[run:run + 8], run) if at != place]
            place //= 8
        return found

    rows = sorted((d[:5] for d in docs), key=lambda d: (d[2] is not None, (d[2] or "").encode(), d[0] is not None, id_key(d[0]) if d[0] is not None else 0, leaf(*d)))
    langs = list(dict.fromkeys(d[2] for d in rows))
    trees = {lang: levels([leaf(*d) for d in rows if d[2] == lang]) for lang in langs}
    top = levels([trees[lang][-1][0] for lang in langs])
    found = []
    for at, lang in enumerate(langs):
        for place, (i, text, *rest) in enumerate(d for d in rows if d[2] == lang):
            own, tree = leaf(i, text, *rest), trees[lang]
            proof = hashed(*siblings(tree, place), *siblings(top, at))
            root = top[-1][0]
            if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 and text is not None:
                changed = levels([leaf(i, text.translate(lower), *rest) if n == place else node for n, node in enumerate(tree[0])])
                root = levels([changed[-1][0] if n == at else node for n, node in enumerate(top[0])])[-1][0]
            found.append((i, own, tree[-1][0], top[-1][0], proof, root, root == top[-1][0]))
    return found


@pytest.mark.parametrize("block", [1, 4])
def test_manifest_against_whole_trees(spark, rows, block):
    prepare(spark)
    docs = documents(2, 160)
    found = [tuple(row) for row in manifest.manifest(rows(DOCUMENTS, *docs), block).collect()]
    key = lambda row: tuple(map(str, row))
    assert sorted(found, key=key) == sorted(plain_manifest(docs), key=key)
    assert not all(row[-1] for row in found)


def test_manifest_with_many_languages_text_ids_and_no_rows(spark, rows):
    prepare(spark)
    ddl = DOCUMENTS.replace("doc_id bigint", "doc_id string")
    docs = [(f"d{i}", f"Text {i}", f"l{i % 70}", "s", i, "") for i in range(90)]
    found = [tuple(row) for row in manifest.manifest(rows(ddl, *docs)).collect()]
    assert sorted(found) == sorted(plain_manifest(docs))
    assert manifest.manifest(rows(ddl)).count() == 0
    single = manifest.manifest(rows(ddl, ("a", None, None, None, None, None))).first()
    assert single.leaf == single.subroot == single.root == single.folded_root and single.proof_sha256 == hashed()


def test_versions_share_untouched_nodes():
    digests = [hashed(str(i)).encode() for i in range(100)]
    tree = manifest.grow(digests, 3)
    version = manifest.changed(tree, 77, 3, b"other")
    assert manifest.folded(b"other", manifest.way(tree, 77, 3)) == version.digest != tree.digest
    assert [a is b for a, b in zip(tree.children, version.children)] == [True, False]
    middle, copied = tree.children[1], version.children[1]
    assert [a is b for a, b in zip(middle.children, copied.children)].count(False) == 1
