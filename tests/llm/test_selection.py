"""Quality scores, decontamination and page texts."""

import random
import zlib

import numpy as np
import pytest
from plain import words
from plans import exchanges

from rowferry.llm import common, decontaminate, html_text, quality
from rowferry.llm.common import prepare, staged


@pytest.fixture(autouse=True)
def prepared(spark):
    return prepare(spark)


def labelled(count):
    source = random.Random(2)
    good = ["the", "house", "stood", "near", "a", "quiet", "river", "and", "trees"]
    docs = []
    for i in range(count):
        fine = source.random() < 0.7
        own = [source.choice(good) for _ in range(source.randint(5, 60))]
        docs.append((i, " ".join(own) if fine else " ".join(w.upper() + "!!" for w in own), int(fine)))
    return docs


def test_scores_of_held_out_documents(rows):
    made = labelled(600)
    docs = rows("doc_id bigint, text string, score string", *[(i, t, "") for i, t, _ in made], (9001, None, ""), (9002, "", ""), (None, "river", ""))
    labels = rows("doc_id bigint, quality int", *[(i, q) for i, _, q in made], (3, None), (None, 0))
    found = quality.score_documents(docs, labels).collect()
    assert len(found) == len(made) + 3
    by_id = {row.doc_id: row for row in found}
    for i, _, q in made:
        assert by_id[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert by_id[i].predicted == int(by_id[i].score >= 0.5)
    held = [(by_id[i].predicted, q) for i, _, q in made if by_id[i].held_out]
    assert sum(p == q for p, q in held) > 0.97 * len(held)
    assert not by_id[None].held_out and by_id[9001].score == by_id[9002].score
    left = quality.drop_rejected(docs, labels)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} >= {None} | {i for i, _, q in made if q and by_id[i].predicted}


def test_labels_of_held_out_rows_change_nothing(rows):
    made = labelled(200)
    docs = rows("doc_id bigint, text string", *[(i, t) for i, t, _ in made])
    out = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    scores = []
    for flip in (False, True):
        labels = rows("doc_id bigint, quality int", *[(i, 1 - q if flip and out(i) else q) for i, _, q in made])
        scores.append({r.doc_id: r.score for r in quality.score_documents(docs, labels).collect()})
    assert scores[0] == scores[1]


def test_without_labels_every_score_is_a_half(rows):
    docs = rows("doc_id bigint, text string", (1, "a"), (2, None))
    none = rows("doc_id bigint, quality int")
    assert [round(r.score, 6) for r in quality.score_documents(docs, none).collect()] == [0.5, 0.5]
    assert quality.score_documents(docs.limit(0), none).collect() == []
    one_kind = rows("doc_id bigint, quality int", (1, 1))
    assert all(r.score > 0.99 for r in quality.score_documents(docs, one_kind).collect())


def test_temperature_lowers_the_loss():
    random_ = np.random.default_rng(1)
    labels = (random_.random(4_000) < 0.7).astype(float)
    assert quality.best_temperature(np.where(labels > 0, 1, 1) * 5.0, labels) > 2


def brute_overlaps(text, item):
    """Whether any diagonal has a stretch good enough that holds a seed."""
    own, wanted = words(text), words(item)
    if len(wanted) < decontaminate.SPAN:
        return False
    least = min(decontaminate.LEAST_WORDS, -(-len(wanted) * 4 // 5))
    for shift in range(-len(wanted), len(own)):
        same = [0 <= shift + k < len(own) and own[shift + k] == w for k, w in enumerate(wanted)]
        fits = any(
            all(same[k + i] for i, use in enumerate(mask) if use == "1")
            for mask in decontaminate.MASKS for k in range(len(wanted) - len(mask) + 1)
        )
        begin, end = max(0, -shift), min(len(wanted), len(own) - shift)
        if fits and end > begin:
            start, stop = decontaminate.best_stretch(np.array(same[begin:end]))
            if sum(same[begin + start:begin + stop]) >= least:
                return True
    return False


@pytest.mark.parametrize("slice_items", [4, 1000])
def test_overlaps_are_those_of_all_diagonals(rows, slice_items):
    source = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [" ".join(source.choice(vocabulary) for _ in range(source.randint(3, 25))) for _ in range(12)] + [None, ""]
    texts = [None, "", "w1"]
    for _ in range(60):
        own = [source.choice(vocabulary) for _ in range(source.randint(0, 30))]
        inner = words(source.choice(items))
        for _ in range(source.randint(0, 4)):
            if inner:
                inner[source.randrange(len(inner))] = "other"
        texts.append(" ".join(own + inner[source.randint(0, 3):] + own[:5]).title())
    docs = rows("doc_id bigint, text string, item_id string", *[(i, t, "x") for i, t in enumerate(texts)], (None, texts[5], "x"))
    benchmark = rows("item_id bigint, text string, doc_id int", *[(i, t, 0) for i, t in enumerate(items)])
    found = decontaminate.find_overlaps(docs, benchmark, slice_items=slice_items).where("doc_id is not null").collect()
    wanted = {(i, k) for i, t in enumerate(texts) for k, item in enumerate(items) if item and brute_overlaps(t, item)}
    assert {(row.doc_id, row.item_id) for row in found} == wanted and wanted
    clean = decontaminate.drop_contaminated(docs, benchmark, slice_items=slice_items)
    assert clean.columns == docs.columns
    assert {row.doc_id for row in clean.where("doc_id is not null").collect()} == set(range(len(texts))) - {i for i, _ in wanted}


def test_no_benchmark_leaves_all(rows):
    docs = rows("doc_id bigint, text string", (1, "a b"), (2, None))
    none = rows("item_id bigint, text string")
    assert decontaminate.find_overlaps(docs, none).collect() == []
    assert decontaminate.drop_contaminated(docs, none).count() == 2


PAGES = {
    "": "", "plain text": "plain text",
    "<p>one<p>two&nbsp; three &lt;b&gt; &eacute;<br>four": "one two three <b> é four",
    "<html><head><title>no</title><style>p{}</style></head><body><nav><a href='/'>home</a></nav><div class=ad>buy</div>"
    "<article><h1>Head</h1><p>First, long <b>bold</b>text.</p><script>var a='</p>';</script><p>Second.</p>"
    "<div class='comments'><p>reader says, so, much, more</p></div></article><aside>side</aside><footer>foot</footer></body></html>":
    "Head First, long boldtext. Second.",
    "<div id=menu><ul><li><a href=a>a, b, c</a><li><a href=b>b</a></ul></div><div id=content><p>Text one, with words.</p>"
    "<p>Text two, with words.</p></div><div class='cookie-notice'>We use cookies, lots, of them</div>": "Text one, with words. Text two, with words.",
    "<body><form><p>Name, address, town, and so on</p></form><p>Kept.</p><div hidden>no</div><!-- no, no, no --></body>": "Kept.",
    "<main><section><p>One, a.</p><p>Two, b.</p></section><section><p>Three, c.</p><p>Four, d.</p></section></main>": "One, a. Two, b. Three, c. Four, d.",
    "<table><tr><td>cell<td>next</table>": "cell next",
    "<article><p>open <i>never closed<p>more &am": "open never closed more &am",
    "<p>a<nav>x</nav>b</p>": "a b",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    assert html_text.main_text(page) == PAGES[page]


LONG = ["The report, as read, says " + f"word{i}, " * 40 for i in range(5)]


@pytest.mark.parametrize("name", [
    "content has-sidebar", "no-sidebar", "layout-with-header", "ad-free", "share-page", "legal-news", "page hasSidebar",
])
def test_a_wrapper_named_like_its_surroundings_stays(name):
    body = "".join(f"<p>{p}</p>" for p in LONG)
    side = "<div class='sidebar'><a href='x'>Other news</a> of today</div>"
    page = f"<body><div class='{name}'><div class='menu'><a href='y'>Home</a></div><div>{body}</div>{side}</div></body>"
    assert html_text.main_text(page) == " ".join(" ".join(LONG).split())
    assert html_text.main_text(f"<body><section id='{name}'>{body}</section></body>") == " ".join(" ".join(LONG).split())


def test_short_closings_stay_and_named_neighbours_go():
    body = "".join(f"<p>{p}</p>" for p in LONG)
    page = f"<div><div>{body}</div><div><p>A short closing.</p></div><div class='comments'><p>First, I say!</p></div><div><a href='x'>More</a></div></div>"
    assert html_text.main_text(page) == " ".join((" ".join(LONG) + " A short closing.").split())


def test_odd_pages_end_soon():
    for page in ("<" * 100_000, "<div>" * 50_000 + "deep", "<a href=\"x" * 20_000, "<p>" * 50_000, "&" * 100_000, "<!--" * 50_000):
        html_text.main_text(page)
    assert html_text.main_text("<div>" * 5_000 + "deep") == "deep"


def test_pages_give_a_row_each(rows):
    pages = rows("page_id bigint, url string, html string, text int", (1, "u", None, 0), (1, None, "<p>é😀</p>", 0), (None, "u", "", 0))
    found = html_text.extract(pages).collect()
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in found] == [(1, "u", "", 0), (1, None, "é😀", 2), (None, "u", "", 0)]
    assert html_text.extract(pages.limit(0)).collect() == []


@pytest.mark.parametrize("most, shuffles", [(2, 0), (1, 2)])
def test_texts_stay_where_ids_can_be_sent(spark, rows, monkeypatch, most, shuffles):
    monkeypatch.setattr(common, "BROADCAST_IDS", most)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs, ids = rows("doc_id bigint, text string", (1, "a"), (2, "b"), (3, "c"), (None, "d")), rows("id bigint", (2,), (5,))
        left, kept = common.without(docs, ids), common.without(docs, ids, keep=True)
        assert sorted(row.text for row in left.collect()) == ["a", "c", "d"]
        assert [row.text for row in kept.collect()] == ["b"]
        assert exchanges(common.without(docs, ids)) == exchanges(common.without(docs, ids, keep=True)) == shuffles
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_staged_texts_are_packed_tightly(rows):
    docs = rows("doc_id bigint, text string", (1, "a"))
    assert all(".zstd." in name for name in staged(docs, "packed").inputFiles())
