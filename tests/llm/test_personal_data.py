"""Personal data against a plain search with Python's patterns."""

import hashlib
import random
import re

import pytest
from plain import random_texts

from rowferry.llm import personal_data as pii
from rowferry.llm.common import prepare

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def fits(kind, match):
    figures = [int(c) for c in match if "0" <= c <= "9"]
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        doubled = [n if i % 2 == 0 else n * 2 - 9 * (n > 4) for i, n in enumerate(reversed(figures))]
        return 12 <= len(figures) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 9 <= len(figures) <= 15


def base_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text) if fits(kind, m[0])]
    return sorted(found)


def expected(text):
    spans = base_spans(text or "")
    joined = ",".join(f"{kind}:{start}:{stop}" for start, _, stop, kind in spans)
    return [sum(s[3] == kind for s in spans) for kind in PLAIN], hashlib.sha256(joined.encode()).hexdigest(), joined


CASES = [
    None, "", "a@b", "a@b@c.d", "x@y.z%q@r.s", "é😀 1.2.3.4.5.6.7.8 ü", "1.22.333.4", "001.002.003.0255", "4111 1111 1111 1111",
    "4111-1111-1111-1112", "+1 (650) 555-0100 and +49 30 1234567", "+1((((((((2", "1234567890123", "mail 10.0.0.1,10.0.0.2",
    "7" * 5_000, "a" * 50_000, "a." * 20_000 + "@", "1 " * 20_000, "+1" * 5_000, "9.9.9.9 " * 300,
    "00000000000000000000.0.0.1", "joe [at] example.com or 555-010-2345",
]


@pytest.fixture(scope="module")
def texts():
    parts = ["a", "@", ".", "1", "22", "300", "+", "-", " ", "(", ")", "b.c", "é", "4111111111111111", "%", "x@y.zz", "+1 650 555 0100", "😀"]
    return CASES + random_texts(random.Random(7), parts, 400, 14)


def test_base_spans_are_those_of_a_plain_search(spark, rows, texts):
    prepare(spark)
    docs = rows("doc_id bigint, text string, n_email string, spans int", *[(i, t, "clash", 1) for i, t in enumerate(texts)])
    found = {row.doc_id: row for row in pii.personal_data(docs).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        counts, digest, joined = expected(text)
        row = found[i]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts, text
        assert row.base_sha256 == digest, text
        assert set(filter(None, joined.split(","))) <= set(row.spans.split(",")), text
        assert len(list(filter(None, row.spans.split(",")))) == sum(counts) + row.n_added


def test_no_spans_in_an_empty_table(spark, rows):
    prepare(spark)
    assert pii.personal_data(rows("doc_id bigint, text string")).collect() == []


def test_trees_learn_a_form_and_add_what_no_format_covers(spark, rows):
    prepare(spark)
    random_ = random.Random(1)
    docs = [(i, f"call {random_.randint(10, 99)} or write user{i}@mail{i % 7}.example.com today") for i in range(300)]
    # Only an underscore in the domain keeps these from the base format.
    docs += [(1000 + i, f"write user{i}@mail_{i}.example.com today") for i in range(5)]
    found = {row.doc_id: row for row in pii.personal_data(rows("doc_id bigint, text string", *docs)).collect()}
    assert all(found[i].n_email == 1 for i in range(300))
    assert all(found[1000 + i].n_email == 0 for i in range(5))


def test_hidden_addresses_are_added(spark, rows):
    prepare(spark)
    random_ = random.Random(2)
    docs = [(i, f"call {random_.randint(10, 99)} or write user{i}@mail{i % 7}.example.com today, at 10.{i} @ noon@x") for i in range(300)]
    hidden = ["joe [at] example.com", "joe(at)example.com", "joe.doe { AT } mail.example.com"]
    docs += [(1000 + i, f"write {text} today.") for i, text in enumerate(hidden)] + [(2000, "look (at) this"), (2001, "none")]
    found = {row.doc_id: row for row in pii.personal_data(rows("doc_id bigint, text string", *docs)).collect()}
    for i, text in enumerate(hidden):
        assert (found[1000 + i].n_added, found[1000 + i].spans) == (1, f"hidden_email:6:{6 + len(text)}")
        assert found[1000 + i].n_email == 0
    assert found[2000].n_added == found[2001].n_added == 0


def test_boosting_separates_and_thresholds_keep_precision():
    import numpy as np

    x = np.zeros((4, len(pii.FEATURES)))
    x[:, 0] = [1, 2, 3, 4]
    x[:, 1] = [0, 1, 0, 1]
    hits, total = np.array([0.0, 0, 0, 90]), np.array([100.0, 100, 100, 90])
    trees = pii.boost(x, hits, total)
    scores = sum(tree.values(x) for tree in trees)
    assert scores[3] > scores[:3].max()
    assert pii.calibrated(np.zeros(4, int), scores, hits, total) == {0: scores[3]}
    assert pii.boost(x, hits * 0, total) == []


def test_redaction_masks_the_spans(spark, rows):
    prepare(spark)
    docs = rows("doc_id bigint, text string", (1, "é a@b.cc and 10.0.0.1"), (2, "none"))
    masked = {row.doc_id: row.text for row in pii.redact(docs, pii.personal_data(docs)).collect()}
    assert masked == {1: "é ###### and ########", 2: "none"}
