"""Main text of web pages by scoring the element tree.

A page is parsed into a tree of elements. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts and comments are left out by element name or
role. A class or id that names one leaves an element out unless it holds as
much text as all that is not so named, and few links; then it wraps the page or
its article, and only lowers the points of what is below. Each paragraph gives points for its length and its commas
to its ancestors: all to its parent, half to the next, and less further up.
Points are discounted by the share of text that stands in links. The container
with most points is kept, together with siblings that score well themselves or
have few links; an enclosing article element is kept whole.

Blocks are joined in page order by one space, with white space inside each
turned into one space. Null or empty html gives empty text; nothing is cut
off. One row comes out for each row that goes in, without a shuffle.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rowferry.llm.common import map_arrow, only, query, strings, table

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes template xmp".split())
BLOCKS = frozenset("""
address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary
table tbody td tfoot th thead tr ul
""".split())
CLOSES_P = BLOCKS - frozenset("body head html option td th tr tbody thead tfoot legend".split())
# An opening element ends an open one of these kinds, looked for up to the limits.
ENDS_OPEN = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tbody": (frozenset("tbody thead tfoot tr td th".split()), frozenset(["table"])),
    "tfoot": (frozenset("tbody thead tfoot tr td th".split()), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
LIMITS = frozenset("table td th button caption object".split())

# What surrounds an article.
DROPPED = frozenset("head nav footer aside form button select dialog menu search svg math canvas audio video object map fieldset".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
DROPPED_NAMES = frozenset("""
ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promoted promotion
nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs pager pagination toc skip
sidebar rail aside widget widgets related recommended recommendations trending popular
header masthead topbar footer colophon copyright legal
comment comments commentlist disqus discussion respond replies
cookie cookies consent gdpr notice notices alert popup modal overlay paywall
newsletter subscribe subscription signup login signin share sharing social follow
""".split())
KEPT_WHOLE = frozenset(["html", "body", "article", "main"])
HIDDEN = re.compile(r"\shidden(?=[\s=/>]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none|visibility\s*:\s*hidden", re.I)

PARAGRAPHS = frozenset("p pre td th blockquote li dd div section article main body figcaption h1 h2 h3 h4 h5 h6".split())
POINTS = {"article": 25.0, "main": 15.0}
SIBLING_SHARE = 0.2
PLAIN_LINKS = 0.25
NAMED_WEIGHT = 0.25
# Elements nested deeper become siblings, as in browsers.
DEEPEST = 512

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"<]*\"|'[^'<]*'|[^'\"<>]|['\"])*+)>"
    r"|<[!?][^>]*>|</[^a-zA-Z>][^>]*>", re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z]+")
# What a page says it has, has not or lays out around is not the thing itself.
_HARMLESS = re.compile(r"(?<![a-z])(?:has|have|no|not|non|with|without|hide|show)[-_]+[a-z]+(?:[-_]+[a-z]+)*|(?<![a-z])[a-z]+[-_]+free(?![a-z])")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Element:
    __slots__ = ("tag", "parent", "children", "dropped", "named", "weight", "score", "text", "links", "commas")

    def __init__(self, tag: str, parent: Element | None, dropped: bool = False, named: bool = False):
        self.tag, self.parent, self.dropped, self.named, self.weight = tag, parent, dropped, named, 1.0
        self.children: list[Element | str] = []
        self.score = 0.0
        self.text = self.links = self.commas = 0


def is_dropped(tag: str, attributes: str, stack: list[Element]) -> tuple[bool, bool]:
    """Whether an element stands around the article for sure, and whether its class or id says so."""
    if tag in DROPPED:
        return True, False
    inside = any(e.tag == "article" for e in stack)
    if tag == "header" and not inside:
        return True, False
    if not attributes or tag in KEPT_WHOLE and "comment" not in attributes.lower():
        return False, False
    if HIDDEN.search(attributes):
        return True, False
    named = False
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values)
        if name.lower() == "role":
            if value.lower() in DROPPED_ROLES:
                return True, False
            continue
        words = set(_NAME.findall(_HARMLESS.sub(" ", _CAMEL.sub("-", value).lower()))) & DROPPED_NAMES
        if inside:
            words.discard("header")  # the heading of the article itself
        named = named or bool(words)
    return False, named


def parse(page: str) -> Element:
    """The element tree; what is not closed is closed as browsers do."""
    root = Element("html", None)
    stack, at = [root], 0

    def close(tags: frozenset[str], limits: frozenset[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in tags:
                del stack[depth:]
                return
            if stack[depth].tag in limits:
                return

    while (found := _TOKEN.search(page, at)) is not None:
        if found.start() > at:
            stack[-1].children.append(page[at:found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag == "p" and not any(e.tag == "p" for e in stack):
                continue
            close(frozenset([tag]), LIMITS if tag not in LIMITS and tag not in ("tr", "tbody", "body", "html") else frozenset())
            continue
        if tag in ("html", "body") and any(e.tag == tag for e in stack):
            continue
        if tag in CLOSES_P:
            close(frozenset(["p"]), LIMITS)
        if tag == "body":
            close(frozenset(["head"]), frozenset())
        if tag in ENDS_OPEN:
            close(*ENDS_OPEN[tag])
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        top = stack[-1]
        dropped, named = is_dropped(tag, found[3], stack)
        own = Element(tag, top, top.dropped or dropped, named)
        top.children.append(own)
        if tag not in VOID and len(stack) < DEEPEST and not (found[3].endswith("/") and tag not in BLOCKS and tag not in ("a", "b", "i", "span")):
            stack.append(own)
    if at < len(page):
        stack[-1].children.append(page[at:])
    return root


def in_order(root: Element) -> list[Element]:
    """All kept elements, parents first."""
    found, open_ = [], [root]
    while open_:
        own = open_.pop()
        found.append(own)
        open_ += [c for c in reversed(own.children) if type(c) is Element and not c.dropped]
    return found


def judge_named(root: Element) -> None:
    """Drop the elements named as surroundings, but not one that the text of the page stands in."""
    elements = in_order(root)
    if not any(e.named for e in elements):
        return
    sizes: dict[Element, tuple[int, int, int]] = {}
    for own in reversed(elements):
        text = links = plain = 0
        for child in own.children:
            if type(child) is str:
                text += len(child.strip())
                plain += len(child.strip())
            elif not child.dropped:
                below = sizes[child]
                text, plain = text + below[0], plain + (0 if child.named else below[2])
                links += below[0] if child.tag == "a" else below[1]
        sizes[own] = text, links, plain
    plain = sizes[root][2]
    for own in sorted((e for e in elements if e.named), key=lambda e: -sizes[e][0]):
        above = own.parent
        while above is not None and not above.dropped:
            above = above.parent
        text, links, inner = sizes[own]
        if above is None and text and text >= plain and links <= PLAIN_LINKS * text:
            plain += inner
        else:
            own.dropped = True
    for own in elements:
        if own.parent is not None:
            own.weight = own.parent.weight * (NAMED_WEIGHT if own.named else 1.0)


def score(root: Element) -> list[Element]:
    """Give all elements their points; returns them, parents first."""
    elements = in_order(root)
    for own in reversed(elements):
        direct = 0
        for child in own.children:
            if type(child) is str:
                direct += len(child.strip())
                own.commas += child.count(",")
            elif not child.dropped:
                own.text += child.text
                own.links += child.text if child.tag == "a" else child.links
                if child.tag not in BLOCKS:
                    own.commas += child.commas
                    direct += child.text
        own.text += sum(len(c.strip()) for c in own.children if type(c) is str)
        if own.tag in PARAGRAPHS and direct:
            points = (1 + own.commas + min(direct / 100, 3.0)) * (1 - density(own)) * own.weight
            above, share = own if own.tag in ("div", "section", "article", "main", "body") else own.parent, 1.0
            level = 0
            while above is not None:
                above.score += points * share
                level += 1
                share = 0.5 if level == 1 else 1 / (3 * level)
                above = above.parent
    for own in elements:
        if own.score:
            own.score = (own.score + POINTS.get(own.tag, 0.0)) * (1 - density(own))
    return elements


def density(element: Element) -> float:
    return element.links / element.text if element.text else 0.0


def chosen(root: Element) -> list[Element]:
    """The best container and the siblings to keep, in page order."""
    judge_named(root)
    best = max(score(root), key=lambda e: e.score)
    if not best.score:
        return [root]
    above = best
    while above is not None:
        if above.tag == "article":
            best = above
        above = above.parent
    if best.parent is None:
        return [best]
    least = SIBLING_SHARE * best.score
    kept = []
    for child in best.parent.children:
        if type(child) is str or child.dropped:
            continue
        plain = child.tag in BLOCKS and child.text and density(child) <= PLAIN_LINKS
        if child is best or not child.named and (child.score >= least or plain):
            kept.append(child)
    return kept


def text_of(elements: list[Element]) -> str:
    """Blocks joined by one space, white space inside each turned into one."""
    parts: list[str] = []
    open_: list[Element | str] = list(reversed(elements))
    while open_:
        own = open_.pop()
        if type(own) is str:
            parts.append(own)
        elif not own.dropped:
            edge = " " if own.tag in BLOCKS or own.tag == "br" else ""
            parts.append(edge)
            if edge and own.children:
                open_.append(" ")
            open_ += reversed(own.children)
    joined = "".join(parts)
    return " ".join((unescape(joined) if "&" in joined else joined).split())


def main_text(page: str) -> str:
    """The main text of one page."""
    return text_of(chosen(parse(page))) if page else ""


def extract(pages: DataFrame, *, html_column: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of each page; ``n_chars`` counts code points."""
    def work(batch: pa.RecordBatch) -> dict:
        texts = [main_text(page) for page in strings(batch.column(2))]
        return {
            "page_id": batch.column(0), "url": batch.column(1),
            "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        }

    kinds = {name: pages.schema[name].dataType.simpleString() for name in ("page_id", "url")}
    return map_arrow(
        only(pages, "page_id", "url", html_column), work,
        f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint",
    )


@query("op6_html_text")
def op6_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return extract(table(spark, sf, "pages"))
