"""Near-duplicate vectors and fuzzy lines against brute force; the pipeline and the registry."""

import os
import random
import re

import numpy as np
import pytest
from plain import smallest_reachable
from pyspark.sql import functions as F

import corpus_pipeline
from rowferry.llm import common, fuzzy_lines, jaccard_groups, queries, vector_graphs
from rowferry.llm.common import prepare
from rowferry.session import staging_root


@pytest.fixture(autouse=True)
def prepared(spark):
    return prepare(spark)


def vectors(count, groups, size=16):
    source = np.random.default_rng(3)
    centers = source.normal(size=(groups, size))
    rows = centers[source.integers(0, groups, count)] + source.normal(size=(count, size)) * source.choice([0.02, 0.3, 0.6], (count, 1))
    return [row.tolist() for row in rows]


def test_links_of_vectors(rows):
    own = vectors(1_500, 40)
    own += own[:30] + [[2 * x for x in own[0]], [1e300 * x for x in own[0]], [1e-300 * x for x in own[0]]]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0], [2.0], own[5][:8]]
    table = rows("vec_id bigint, embedding array<double>, label int", *[(i, v, 0) for i, v in enumerate(own + odd)])
    found = {row.vec_id: row for row in vector_graphs.link_vectors(table).collect()}
    x = np.array(own)
    x /= np.abs(x).max(1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(x @ x.T >= 0.9, 1))
    wanted = np.bincount(np.concatenate((a, b)), minlength=len(own))
    got = np.array([found[i].n_links for i in range(len(own))])
    assert (got <= wanted).all() and got.sum() >= 0.98 * wanted.sum()
    expected = smallest_reachable(range(len(own)), zip(a.tolist(), b.tolist()))
    assert sum(found[i].component_id != expected[i] for i in range(len(own))) <= 0.02 * len(own)
    assert all(row.kept == (row.vec_id == row.component_id) for row in found.values())
    alone = {i for i in range(len(own), len(own) + 9)} - {len(own) + 6, len(own) + 7}
    assert all(found[i].n_links == 0 and found[i].component_id == i for i in alone)
    assert found[len(own) + 7].component_id == len(own) + 6


def families(count, places, spreads, source):
    """A group of vectors for each spread, wide ones with pairs on both sides of the limit, and single vectors."""
    groups = [source.normal(size=places) + source.normal(size=(count, places)) * spread for spread in spreads]
    return np.concatenate((*groups, source.normal(size=(count, places))))


def test_balls_against_brute_force():
    source = np.random.default_rng(5)
    x = vector_graphs.unit(families(300, 16, (0.02, 0.1, 0.2, 0.3), source))
    weights = source.integers(1, 4, len(x))
    found = vector_graphs.balls_of(x, weights)
    members = np.concatenate([ball.members for ball in found])
    assert len(found) >= 2 and members.size == np.unique(members).size >= 300
    assert all((ball.vectors @ ball.vectors.T).min() >= 0.9 for ball in found)
    queries = np.concatenate((x, vector_graphs.unit(x[:900] + source.normal(size=(900, 16)) * 0.15)))
    for ball in found:
        got = ball.linked(queries, vector_graphs.angles_of(queries @ ball.middle))
        assert (got == (queries @ ball.vectors.T >= 0.9) @ weights[ball.members]).all()


def test_large_groups_give_counts_not_pairs(rows):
    source = np.random.default_rng(6)
    x = vector_graphs.unit(families(600, 16, (0.02, 0.1, 0.25), source))
    own = x.tolist() + x[:40].tolist()
    table = rows("vec_id bigint, embedding array<double>", *[(i, v) for i, v in enumerate(own)])
    found = {row.vec_id: row for row in vector_graphs.link_vectors(table).collect()}
    x = vector_graphs.unit(np.array(own))
    near = x @ x.T >= 0.9
    wanted = near.sum(1) - 1
    got = np.array([found[i].n_links for i in range(len(own))])
    assert (got <= wanted).all() and got.sum() >= 0.98 * wanted.sum()
    expected = smallest_reachable(range(len(own)), zip(*(side.tolist() for side in np.nonzero(np.triu(near, 1)))))
    assert sum(found[i].component_id != expected[i] for i in range(len(own))) <= 0.02 * len(own)
    marked = vector_graphs.classes(table)
    distinct = marked.dropDuplicates(["cls"]).selectExpr("cls", "1L AS rows", "vector")
    links = vector_graphs.found_links(distinct, 2).collect()
    assert len(links) <= 4 * len(own) < wanted.sum() / 10


def test_union_of_groups():
    parent = np.arange(9)
    vector_graphs.unite(parent, np.array([8, 7, 3, 5]), np.array([7, 6, 5, 4]))
    assert parent.tolist() == [0, 1, 2, 3, 3, 3, 6, 6, 6]
    vector_graphs.unite(parent, np.array([4, 0]), np.array([8, 0]))
    assert parent.tolist() == [0, 1, 2, 3, 3, 3, 3, 3, 3]


def test_no_vectors(rows):
    assert vector_graphs.link_vectors(rows("vec_id bigint, embedding array<float>")).collect() == []
    assert vector_graphs.link_vectors(rows("vec_id bigint, embedding array<float>", (1, None))).first().kept


def test_beams_widen_for_a_large_group():
    source = np.random.default_rng(1)
    group = source.normal(size=8) + source.normal(size=(700, 8)) * 0.02
    own = vector_graphs.unit(np.concatenate((group, source.normal(size=(900, 8))))).astype(np.float32)
    found = vector_graphs.Graphs(own).similar(own[:3], 0.9)
    assert np.bincount(found[0], minlength=3).min() >= 690


def line_set(line):
    import re

    return {m[1] for m in re.finditer(fuzzy_lines.SHINGLES, line)}


def test_lines_against_brute_force(rows):
    source = random.Random(12)
    vocabulary = ["".join(source.choice("abcdefgh") for _ in range(source.randint(2, 9))) for _ in range(300)]
    bases = [" ".join(source.choice(vocabulary) for _ in range(source.randint(1, 40))) for _ in range(40)]
    texts = [None, "", "\n\n", "  \n x \n"]
    for _ in range(60):
        own = []
        for _ in range(source.randint(1, 8)):
            line = source.choice(bases).split(" ")
            for _ in range(source.choice([0, 0, 1, 2, 6])):
                line[source.randrange(len(line))] = source.choice(vocabulary)
            own.append(source.choice(["", " ", "\t"]) + " ".join(line) + source.choice(["", "\r"]))
        texts.append("\n".join(own))
    docs = rows("doc_id bigint, text string, n_chars int, _gone int", *[(i, t, len(t or ""), 1) for i, t in enumerate(texts)], (None, "x", 1, 1))
    found = fuzzy_lines.line_classes(docs).collect()
    place = {(i, n): line.strip(" \t\r\x0b\x0c") for i, t in enumerate(texts) for n, line in enumerate((t or "").split("\n"))}
    place[None, 0] = "x"
    place = {at: line for at, line in place.items() if line}
    assert {(row.doc_id, row.line_no) for row in found} == set(place)
    kinds = sorted(set(place.values()))
    sets = {k: line_set(k) for k in kinds}
    links = [(a, b) for n, a in enumerate(kinds) for b in kinds[n + 1:] if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    expected = smallest_reachable(kinds, links)
    groups = {}
    for row in found:
        groups.setdefault(row.component, []).append(row)
    for group in groups.values():  # nothing is united that brute force keeps apart
        assert len({expected[place[row.doc_id, row.line_no]] for row in group}) == 1
        assert sum(row.kept for row in group) == 1
        first = min(((row.doc_id is not None, row.doc_id, row.text_hash, row.line_no), row.kept) for row in group)
        assert first[1]
    assert len(set(expected.values())) <= len(groups) <= 1.03 * len(set(expected.values()))

    left = fuzzy_lines.drop_repeated_lines(docs)
    assert left.columns == docs.columns
    result = {row.doc_id: row for row in left.collect()}
    kept = {(row.doc_id, row.line_no) for row in found if row.kept}
    for i, text in enumerate(texts):
        lines = [line for n, line in enumerate((text or "").split("\n")) if (i, n) in kept or (i, n) not in place]
        if text and "".join(lines).strip() != "" or not (text or "").strip():
            assert result[i].text == (None if text is None else "\n".join(lines)), i
            assert result[i].n_chars == len("\n".join(lines))
        else:
            assert i not in result


@pytest.mark.parametrize("inside", [True, False])
def test_audits_leave_self_pairs_out(monkeypatch, inside):
    source = np.random.default_rng(2)
    own = source.normal(size=(3_000, 24))
    own[1::2] = own[::2] + source.normal(size=(1_500, 24)) * 0.05  # each vector has one near copy
    own = vector_graphs.unit(own).astype(np.float32)
    graphs = vector_graphs.Graphs(own)
    if not inside:
        own_ids = np.full(300, -1)
        queries = vector_graphs.unit(own[:300] + source.normal(size=(300, 24)) * 0.02).astype(np.float32)
    else:
        own_ids = np.arange(300)
        queries = own[:300]
    search = graphs.similar

    def only_self(asked, least, beam=None):
        rows, found = search(asked, least, beam)
        if graphs.beam < 128:  # a narrow beam finds nothing but the vector itself
            at = np.argmax(asked @ own.T, 1)
            keep = found == at[rows]
            rows, found = rows[keep], found[keep]
        return rows, found

    monkeypatch.setattr(graphs, "similar", only_self)
    graphs.beam = vector_graphs.FIRST_BEAM
    graphs.audit(queries, own_ids)
    assert graphs.beam >= 128


def united(rows, texts):
    """Component of each text, a line each."""
    docs = rows("doc_id bigint, text string", *enumerate(texts))
    return {row.doc_id: row.component for row in fuzzy_lines.line_classes(docs).collect()}


def test_lines_without_spaces_that_are_shifted(rows):
    source = random.Random(21)
    line = "".join(chr(source.randint(0x4E00, 0x9FA5)) for _ in range(200))
    other = "".join(chr(source.randint(0x4E00, 0x9FA5)) for _ in range(200))
    url = "https://example.org/" + "".join(source.choice("abcdef0123456789/") for _ in range(150))
    texts = [line, "x" + line, line[:10] + "x" + line[10:], line[:100] + line[101:], other, url, url[:30] + url[31:], "short", "shor"]
    found = united(rows, texts)
    nine = [{t[i:i + 9] for i in range(max(1, len(t) - 8))} for t in texts]
    links = [(a, b) for a in range(9) for b in range(a) if len(nine[a] & nine[b]) >= 0.8 * len(nine[a] | nine[b])]
    expected = smallest_reachable(range(9), links)
    assert expected[3] == 0 and expected[6] == 5
    assert all((found[a] == found[b]) == (expected[a] == expected[b]) for a in range(9) for b in range(9))


def test_pairs_in_a_family_of_template_lines(rows):
    source = random.Random(22)
    word = lambda count: "".join(source.choice("abcdefghijklmnop") for _ in range(count))
    template, texts = word(133), []
    for _ in range(400):  # 125 shingles of the template; strangers share two thirds of theirs
        own = word(31)
        texts += [template + own, template + own[:-3] + word(3)]
    source.shuffle(texts)
    sets = [{t[i:i + 9] for i in range(len(t) - 8)} for t in texts]
    near = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    pairs = [(a, b) for a in range(800) for b in range(a) if near(a, b) >= 0.8]
    assert len(pairs) == 400 and near(*pairs[0]) > 0.9
    found = united(rows, texts)
    assert sum(found[a] == found[b] for a, b in pairs) >= 0.95 * len(pairs)
    assert len(set(found.values())) >= 400


def test_all_pairs_of_a_family_whose_rare_hashes_are_common(rows):
    source = random.Random(23)
    word = lambda count: "".join(source.choice("abcdefghijklmnop") for _ in range(count))
    template, texts = word(164), []
    for _ in range(150):  # 156 shingles of the template and 25 others, few of which are among the least hashes
        own = word(25)
        texts += [template + own, template + own[:-2] + word(2)]
    source.shuffle(texts)
    sets = [{t[i:i + 9] for i in range(len(t) - 8)} for t in texts]
    links = [(a, b) for a in range(300) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    expected = smallest_reachable(range(300), links)
    assert len(set(expected.values())) == 150
    found = united(rows, texts)
    groups = {}
    for at, component in found.items():
        groups.setdefault(component, set()).add(at)
    assert sorted(map(sorted, groups.values())) == sorted([a for a in range(300) if expected[a] == root] for root in set(expected.values()))


def test_signatures_travel_only_for_hashes_of_several_roots(rows, monkeypatch):
    seen = {}
    stage = fuzzy_lines.staged
    monkeypatch.setattr(fuzzy_lines, "staged", lambda df, label: seen.setdefault(label, stage(df, label)))
    monkeypatch.setattr(fuzzy_lines, "FEW", 4)
    # Hash 1 is of one root, 2 of two, 3 of six members and roots; the others are held once.
    data = [(1, 1, [1, 11]), (2, 1, [1, 12]), (3, 3, [2, 13]), (4, 4, [2, 13]), *[(n, n, [3, n + 10]) for n in range(5, 11)]]
    members = rows("key bigint, root bigint, sketch array<int>", *[(key, root, sketch) for key, root, sketch in data])
    pairs, many = fuzzy_lines.met_by_rarest(members)
    assert {(row.a, row.b) for row in pairs.collect()} == {(3, 4)}
    assert {(row.hash, row.key) for row in many.collect()} == {(3, n) for n in range(5, 11)}
    assert {row.hash for row in seen["rarest-held"].collect()} == {2, 3, 13}


def test_blocks_of_a_shingle_meet_each_other(rows, monkeypatch):
    monkeypatch.setattr(fuzzy_lines, "BLOCK", 2)
    source = random.Random(24)
    bases = ["".join(source.choice("abcdef") for _ in range(60)) for _ in range(6)]
    texts = sorted({base[:at] + "x" + base[at + 1:] for base in bases for at in source.sample(range(60), 9)} | {b[:50] for b in bases})
    keyed = rows("key bigint, root bigint, line string", *[(i, i, t) for i, t in enumerate(texts)])
    pairs = fuzzy_lines.met_by_shingles(keyed.select("key", "root"), keyed.select("key", "line"))
    found = {(row.a, row.b) for row in fuzzy_lines.similar(pairs, keyed.select("key", "line")).collect()}
    sets = [line_set(t) for t in texts]
    count = range(len(texts))
    assert found == {(a, b) for b in count for a in range(b) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert len(found) > 10


def test_no_lines(rows):
    assert fuzzy_lines.line_classes(rows("doc_id bigint, text string")).collect() == []
    assert fuzzy_lines.line_classes(rows("doc_id bigint, text string", (1, None), (2, " \n"))).collect() == []


def test_pipeline_keeps_its_promises(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "byte_bpe"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf)
        assert after.schema.simpleString() == docs.schema.simpleString(), name
        after.write.parquet(path := f"{tmp_path}/{name}")
        after = spark.read.parquet(path)
        assert after.select("doc_id").exceptAll(before.select("doc_id")).isEmpty()
        before = after
    from rowferry.llm import decontaminate, jaccard_groups

    assert decontaminate.find_overlaps(before, benchmark).isEmpty()
    assert jaccard_groups.near_duplicates(before).where("component_id <> doc_id").isEmpty()
    last = corpus_pipeline.STAGES[-1][1](spark, before, sf)
    assert {r.doc_id for r in last.collect()} == {r.doc_id for r in before.collect()}
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, sf).collect()} == {r.doc_id: r.ids_sha256 for r in last.collect()}


def test_pipeline_of_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).collect() == []


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.all_queries())
    assert numbers == list(range(1, 14))
    assert queries.all_oracles().keys() <= queries.all_queries().keys()


def test_shingles_by_position_are_those_of_the_pattern(rows):
    source = random.Random(25)
    texts = ["".join(source.choice("abé字😀 ") for _ in range(n)) for n in (1, 8, 9, 10, 40, 300)] + ["a" * 500, "abcdefghi" * 300]
    table = rows("line string", *[(t,) for t in texts])
    found = table.select("line", fuzzy_lines.shingle_hashes("line").alias("all"), fuzzy_lines.least_hashes("line").alias("least"))
    for row in found.collect():
        own = [m[1] for m in re.finditer(fuzzy_lines.SHINGLES, row.line)]
        assert len(set(zip(own, row.all))) == len(set(own)) == len(set(row.all)) and len(own) == len(row.all)
        assert row.least == sorted(set(row.all))[:fuzzy_lines.BOTTOM]


def test_small_buckets_are_settled_without_the_rarest_hashes(rows, monkeypatch):
    seen = {}
    stage = fuzzy_lines.staged
    monkeypatch.setattr(fuzzy_lines, "staged", lambda df, label: seen.setdefault(f"{label}-{len(seen)}", stage(df, label)))
    # Strangers in buckets of two, four that are two pairs, and a bucket of more than are all compared.
    signed = [(1, [1, 2, 11]), (2, [1, 2, 12]), (3, [3, 4, 13]), (4, [3, 4, 14]), (5, [3, 4, 13]), (6, [3, 4, 14])]
    signed += [(key, [5, 6, key]) for key in range(20, 60)]
    signed = rows("key bigint, sketch array<int>", *signed)
    buckets = fuzzy_lines.first_buckets(signed)
    assert {(row.key, row.first, row["size"]) for row in buckets.where("key < 20").collect()} >= {(2, 1, 2), (6, 3, 4)}
    roots = rows("node bigint, root bigint", (3, 3), (5, 3))
    rest = fuzzy_lines.not_united(buckets, roots)
    assert {row.key for row in rest.where(F.col("size") <= fuzzy_lines.SMALL).collect()} == {4, 5, 6}
    assert {row.key for row in rest.where(F.col("size") > fuzzy_lines.SMALL).collect()} == set(range(21, 60))
    met = fuzzy_lines.met_in_buckets(rest.where(F.col("size") <= fuzzy_lines.SMALL), signed)
    assert {(row.a, row.b) for row in met.collect()} == {(4, 5), (4, 6), (5, 6)}


def test_pairs_of_rare_hashes_are_made_once(rows, monkeypatch):
    monkeypatch.setattr(fuzzy_lines, "FEW", 3)
    distinct, made = type(rows("a int")).distinct, []

    def counted(df):
        if df.columns == ["a", "b"]:
            made.append(df.count())
        return distinct(df)

    monkeypatch.setattr(type(rows("a int")), "distinct", counted)
    # Two that share all hashes, one of which many hold, and two that share enough of them.
    data = [(1, list(range(10))), (2, list(range(10))), (3, list(range(20, 30))), (4, list(range(23, 33)))]
    data += [(key, [0] + list(range(100 * key, 100 * key + 9))) for key in range(10, 14)]
    members = rows("key bigint, root bigint, sketch array<int>", *[(key, key, sketch) for key, sketch in data])
    pairs, many = fuzzy_lines.met_by_rarest(members)
    assert {(row.a, row.b) for row in pairs.collect()} == {(1, 2), (3, 4)}
    assert made == [2]


def test_lines_leave_no_tables_or_shuffle_files(rows, tmp_path):
    docs = rows("doc_id bigint, text string", *[(n, f"a line that many documents hold\nand {'x' * n} another, number {n}") for n in range(60)])
    spark = docs.sparkSession
    prepare(spark)
    folder = os.path.join(staging_root(spark).removeprefix("file:"), "rowferry")
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = blocks.getAllFiles()
        return {name for at in range(files.size()) if (name := files.apply(at).getName()).startswith("shuffle_")}

    before, shuffles = set(os.listdir(folder)) if os.path.isdir(folder) else set(), shuffled()
    fuzzy_lines.line_classes(docs).write.parquet(str(tmp_path / "lines"))
    assert {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before} == {"lines"}
    assert shuffled() <= shuffles
    before = set(os.listdir(folder))
    jaccard_groups.keep_one(docs).write.parquet(str(tmp_path / "one"))
    assert {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before} == {"components", "ids", "repeated"}
    assert shuffled() <= shuffles


def test_passes_meet_as_one_pass_does(rows, monkeypatch):
    source = random.Random(25)
    monkeypatch.setattr(fuzzy_lines, "FEW", 4)
    bases = ["".join(source.choice("abcdef") for _ in range(60)) for _ in range(4)]
    texts = sorted({base[:at] + "x" + base[at + 1:] for base in bases for at in source.sample(range(60), 9)})
    docs = rows("doc_id bigint, text string", *enumerate(texts))
    signed = fuzzy_lines.signatures(docs)
    members = signed.select("key", F.col("key").alias("root"), "sketch")
    near = fuzzy_lines.first_buckets(signed).select("bucket", "key", F.col("key").alias("root"))
    every = signed.select(F.col("key").alias("a")).crossJoin(signed.select(F.col("key").alias("b"))).where("a < b")
    keyed = docs.select(fuzzy_lines.key("text"), F.col("text").alias("line"))
    steps = [
        (400, lambda most: fuzzy_lines.alike(every, signed, every.count(), most)), (60, lambda most: fuzzy_lines.met_in_buckets(near, signed, most)),
        (120, lambda most: fuzzy_lines.met_by_rarest(members, most)[0]), (400, lambda most: fuzzy_lines.similar(every, keyed, most)),
        (400, lambda most: fuzzy_lines.met_by_shingles(members.drop("sketch"), keyed, most)),
        (20, lambda most: fuzzy_lines.texts_of(docs, members.select("key"), most)),
    ]
    staged = []
    for most, step in steps:
        whole = set(map(tuple, step(None).collect()))
        with monkeypatch.context() as patch:
            patch.setattr(fuzzy_lines, "BROADCAST_KEYS", 1)
            patch.setattr(fuzzy_lines, "staged", lambda df, label: staged.append(label) or common.staged(df, label))
            assert set(map(tuple, step(most).collect())) == whole
        assert whole
    assert min(map(staged.count, ("line-pairs", "rarest", "rarest-held", "rarest-members", "line-prefixes", "line-links", "line-texts"))) > 1
    assert staged.count("pass") > 5
