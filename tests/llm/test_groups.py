"""Near duplicates, components and passages against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from plain import shingle_set, smallest_reachable, words
from pyspark.sql import functions as F

from rowferry.llm import components as parts
from rowferry.llm import jaccard_groups, passages
from rowferry.llm.common import prepare


@pytest.fixture(autouse=True)
def prepared(spark):
    return prepare(spark)


def random_words(source, count, vocabulary=400):
    return [f"w{source.randint(0, vocabulary)}" for _ in range(count)]


def corpus():
    """Bases, copies with few and many edits, a passage all share, short, blank and repeated rows."""
    source, texts = random.Random(3), [None, "", " \n ", "one", "One", "one two three four", "Two words", "é ü"]
    passage = random_words(source, 30)
    for _ in range(12):
        base = random_words(source, source.randint(5, 120))
        for edits in (0, 0, 1, 2, 3, 5, 9):
            copy = list(base)
            for _ in range(edits):
                copy[source.randrange(len(copy))] = f"new{source.randint(0, 99)}"
            texts.append(" ".join(copy).upper() if source.random() < 0.2 else "\t".join(copy))
        texts.append(" ".join(base + passage))
    template = random_words(source, 90)
    for number in range(60):
        copy = list(template)
        for _ in range(source.randint(0, 3)):
            copy[source.randrange(90)] = f"own{number}"
        texts.append(" ".join(copy))
    texts.append(" ".join(random_words(source, 5_000, 10 ** 6)))
    return texts


def brute_components(sets):
    links, ids = [], list(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            same = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * same >= 80 * (len(sets[a]) + len(sets[b]) - same):
                links.append((a, b))
    return smallest_reachable(ids, links)


def test_components_of_near_duplicates_are_exact(rows, monkeypatch):
    monkeypatch.setattr(jaccard_groups, "FREQUENT", 3)
    texts = corpus()
    docs = rows("doc_id bigint, text string, cls string, token int", *[(i, t, "x", 0) for i, t in enumerate(texts)])
    sets = {i: shingle_set(t) for i, t in enumerate(texts)}
    expected = brute_components(sets)
    found = {row.doc_id: row for row in jaccard_groups.near_duplicates(docs).collect()}
    assert {i: found[i].n_shingles for i in sets} == {i: len(s) for i, s in sets.items()}
    assert {i: found[i].component_id for i in sets} == expected
    kept = jaccard_groups.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(row.doc_id for row in kept.collect()) == sorted(set(expected.values()))


def test_rows_without_or_with_repeated_ids(rows):
    docs = rows("doc_id bigint, text string", (None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (9, None), (9, "q"), (None, None))
    found = jaccard_groups.near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in found) == [
        (0, 0, 0), (0, 2, 7), (7, 2, 7), (7, 2, 7), (9, 0, 9), (9, 1, 9)]
    assert jaccard_groups.keep_one(docs).where("doc_id = 7").count() == 1
    assert jaccard_groups.near_duplicates(rows("doc_id bigint, text string")).collect() == []


def test_bit_sets_never_exceed_the_difference():
    source = np.random.default_rng(1)
    for _ in range(200):
        pool = source.integers(0, 2 ** 63, 300).astype(np.uint64)
        a, b = (np.unique(source.choice(pool, source.integers(1, 250))) for _ in range(2))
        assert jaccard_groups.least_difference(jaccard_groups.bit_set(a), jaccard_groups.bit_set(b)) <= np.setxor1d(a, b).size


@pytest.mark.parametrize("most", [1, 40, 1 << 18])
def test_rows_of_the_matrix_are_looked_at_together(monkeypatch, most):
    monkeypatch.setattr(jaccard_groups, "PAIRS", most)
    source, rows, bits = np.random.default_rng(4), [], []
    for token in range(120):
        low, proto = int(source.integers(0, 2)), source.integers(0, 2 ** 63, 700).astype(np.uint64)
        high, size = low + int(source.integers(0, 2)), source.integers(30, 600)
        for group in sorted(source.integers(0, 4, source.integers(1, 9)).tolist()):
            own = np.unique(proto[:int(size * source.uniform(0.7, 1.1))])
            own = np.unique(np.where(source.random(own.size) < 0.06, source.integers(0, 2 ** 63, own.size).astype(np.uint64), own))
            block = low if low == high else int(source.choice([low, high]))
            rows.append((token, low, high, group, 1000 + len(rows), own.size, int(source.integers(0, 9)), block))
            bits.append(jaccard_groups.folded(jaccard_groups.bit_set(own), jaccard_groups.FEW_BYTES))
    expected = set()
    for i, x in enumerate(rows):
        for j, y in enumerate(rows):
            if x[:3] == y[:3] and x[3] < y[3] and (x[1] == x[2] or x[7] != y[7]) and 5 * min(x[5], y[5]) >= 4 * max(x[5], y[5]):
                both = x[5] + y[5]
                if 9 * min(x[5] - x[6], y[5] - y[6]) >= 4 * both and 9 * jaccard_groups.least_difference(bits[i], bits[j]) <= both:
                    expected.add((x[4], y[4]))
    calls, compare = [], jaccard_groups.differences
    monkeypatch.setattr(jaccard_groups, "differences", lambda *given: calls.append(1) or compare(*given))
    columns = [np.array(column) for column in zip(*rows)]
    batches = [[*[pa.array(c[at:at + 100]) for c in columns], pa.array(bits[at:at + 100], pa.binary())] for at in range(0, len(rows), 100)]
    for nearest in (False, True):
        found = jaccard_groups._open_groups(nearest, (pa.RecordBatch.from_arrays(batch, list("tlhgcnpbx")) for batch in batches))
        found = {pair for batch in found for pair in zip(*(column.to_pylist() for column in batch.columns))}
        assert found <= expected and {a for a, _ in found} == {a for a, _ in expected}
        assert nearest or found == expected
        assert expected and (most < 1 << 18 or len(calls) <= 2 * len(batches) + 2)


@pytest.mark.parametrize("hot", [2, 10_000])
def test_components_of_chains_hubs_and_loops(rows, monkeypatch, hot):
    monkeypatch.setattr(parts, "HOT_DEGREE", hot)
    source = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(500, i) for i in range(501, 560)] + [(9, 9)]
    links += [(source.randint(1000, 1060), source.randint(1000, 1060)) for _ in range(30)]
    found = {r.node: r.root for r in parts.components(rows("a bigint, b bigint", *links, (None, 3))).collect()}
    expected = smallest_reachable({n for link in links for n in link}, links)
    touched = {n for a, b in links if a != b for n in (a, b)}
    assert found == {n: expected[n] for n in touched}


def test_components_of_no_links(rows):
    assert parts.components(rows("a bigint, b bigint")).collect() == []


def test_chains_score_like_a_quadratic_search():
    source = random.Random(8)
    for _ in range(100):
        m = np.array([[source.randint(0, 80), source.randint(0, 80), source.randint(3, 9)] for _ in range(source.randint(1, 14))])
        best, order = {}, sorted(range(len(m)), key=lambda i: m[i, 0])
        for i in order:
            best[i] = float(m[i, 2])
            for j in order:
                if j in best and j != i and m[j, 0] + m[j, 2] <= m[i, 0] and m[j, 1] + m[j, 2] <= m[i, 1]:
                    gap = (m[i, 0] - m[j, 0] - m[j, 2]) + (m[i, 1] - m[j, 1] - m[j, 2])
                    best[i] = max(best[i], best[j] + m[i, 2] - passages.GAP_COST * gap)
        assert next(passages.chains(m))[0] == pytest.approx(max(best.values()))


def test_prefix_maxima_are_those_of_a_list():
    source, tree, values = random.Random(2), passages.PrefixMaxima(20), [0.0] * 20
    for step in range(200):
        rank, value = source.randrange(20), source.random()
        tree.put(rank, value, step)
        values[rank] = max(values[rank], value)
        upto = source.randint(0, 20)
        assert tree.best(upto)[0] == max(values[:upto], default=0.0)


def test_passages_repeat_across_documents(rows):
    source = random.Random(4)
    passage = random_words(source, 60, 10 ** 6)
    fuzzy = list(passage)
    for at in (9, 25, 41):
        fuzzy[at] = "other"
    del fuzzy[50]
    around = lambda inner: " ".join(random_words(source, 40, 10 ** 6) + inner + random_words(source, 70, 10 ** 6))
    texts = [around(passage), around([]), around(fuzzy), around(passage[:20]), None, "", around(passage), "Un " * 300, "Un " * 200]
    docs = rows("doc_id bigint, text string, seed int", *[(i, t, 1) for i, t in enumerate(texts)], (None, texts[0], 1))
    found = passages.repeated_passages(docs).collect()
    assert {row.doc_id for row in found} == {2, 6}
    exact = [row for row in found if row.doc_id == 6 and row.other_id == 0][0]
    assert words(texts[6])[exact.start_word:exact.end_word] == passage == words(texts[0])[exact.other_start:exact.other_end]
    near = max((row for row in found if row.doc_id == 2), key=lambda row: row.n_matched)
    assert (near.start_word, near.end_word, near.n_matched) == (40, 99, 56)
    assert passages.repeated_passages(docs.limit(0)).collect() == []


def test_a_passage_that_most_documents_hold(rows):
    source = random.Random(6)
    passage = random_words(source, 55, 10 ** 6)
    texts = [" ".join(random_words(source, 30, 10 ** 6) + passage + random_words(source, 30, 10 ** 6)) for _ in range(80)]
    found = passages.repeated_passages(rows("doc_id bigint, text string", *enumerate(texts)))
    counts = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("n_matched").alias("matched")).collect()
    assert {row.doc_id for row in counts} == set(range(1, 80))
    assert all(row.n <= 2 and row.matched == 55 for row in counts)


def test_partners_that_share_nothing_but_common_seeds(rows):
    source = random.Random(16)
    passage = random_words(source, 60, 10 ** 6)
    own = lambda inner: " ".join(random_words(source, 20, 10 ** 6) + inner + random_words(source, 20, 10 ** 6))
    parts_ = lambda count: [own(passage[at:at + 30]) for _ in range(count) for at in (0, 15, 30)]
    texts = parts_(40) + [own(passage)] + parts_(2) + [own(passage)] + parts_(2)
    found = passages.repeated_passages(rows("doc_id bigint, text string", *enumerate(texts))).collect()
    assert [(r.doc_id, r.start_word, r.end_word, r.other_id, r.other_start) for r in found] == [(127, 20, 80, 120, 20)]


@pytest.mark.parametrize("more", [0, 50])
def test_a_passage_that_a_document_holds_twice(rows, more):
    source = random.Random(17)
    passage, own = random_words(source, 60, 10 ** 6), lambda: random_words(source, 25, 10 ** 6)
    texts = [own() + passage + own()] + [own() + passage + own() + passage for _ in range(more + 1)]
    found = passages.repeated_passages(rows("doc_id bigint, text string", *[(i, " ".join(t)) for i, t in enumerate(texts)])).collect()
    assert {(r.doc_id, r.start_word, r.end_word) for r in found} == {(i, at, at + 60) for i in range(1, more + 2) for at in (25, 110)}


def test_all_passages_of_one_pair_and_those_between_them(rows):
    source = random.Random(9)
    first, second, inner = (random_words(source, 60, 10 ** 6) for _ in range(3))
    own = lambda count: random_words(source, count, 10 ** 6)
    texts = [own(20) + first + own(40) + second + own(20), own(30) + inner + own(30)]
    texts += [own(20) + first + own(40) + second + own(20), own(20) + first + inner + second + own(20)]
    found = passages.repeated_passages(rows("doc_id bigint, text string", *[(i, " ".join(t)) for i, t in enumerate(texts)])).collect()
    assert {(r.doc_id, r.start_word, r.end_word) for r in found} == {(2, 20, 80), (2, 120, 180), (3, 20, 80), (3, 80, 140), (3, 140, 200)}
    assert {(r.start_word, r.other_id) for r in found if r.doc_id == 3} == {(20, 0), (80, 1), (140, 0)}


def test_stretches_are_the_best_and_then_the_best_on_either_side():
    source = np.random.default_rng(4)

    def slow(same, begin):
        scores = np.concatenate(([0], np.cumsum(np.where(same, 1, -passages.EDIT_COST))))
        value, start, stop = max(((scores[j] - scores[i], -j, -i) for j in range(len(scores)) for i in range(j)), default=(0, 0, 0))
        start, stop = -stop, -start
        if value <= 0:
            return []
        return slow(same[:start], begin) + [(begin + start, begin + stop)] + slow(same[stop:], begin + stop)

    for _ in range(60):
        same = source.random(source.integers(0, 50)) < source.choice([0.6, 0.8, 0.9])
        assert sum(b - a for a, b in passages.stretches(same)) == sum(b - a for a, b in slow(same, 0))


@pytest.mark.parametrize("every", [8, 10])
def test_passages_with_a_word_replaced_regularly(rows, every):
    source, texts = random.Random(every), []
    for _ in range(100):
        passage = random_words(source, 60, 10 ** 6)
        other = [f"other{i}" if i % every == every - 1 else word for i, word in enumerate(passage)]
        texts += [" ".join(random_words(source, 20, 10 ** 6) + inner + random_words(source, 20, 10 ** 6)) for inner in (passage, other)]
    found = passages.repeated_passages(rows("doc_id bigint, text string", *enumerate(texts))).collect()
    assert {(row.doc_id, row.other_id) for row in found} == {(i + 1, i) for i in range(0, 200, 2)}
