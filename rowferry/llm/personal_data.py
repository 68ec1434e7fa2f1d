"""Personal data in texts: candidates, boosted trees, calibrated thresholds; DataFrame functions only.

Base spans follow fixed formats and always stay: the leftmost matches that do
not overlap, kind by kind, less those that fail the kind's rule.

On top, generators of high recall propose spans that may overlap, among them
ones that no format covers. Features of a candidate's form and surroundings
are put into few steps each. Candidates that are a base span are examples for,
those that touch none examples against; the others say nothing. Candidates of
equal features are counted together, and trees of two levels are boosted on
the ``MOST_VECTORS`` most frequent rows of one half of the documents. On all of
the other half the lowest score is sought, kind by kind, from which on
``PRECISION`` of the examples are base spans. A kind in ``STANDS_FOR`` can never
equal a base span: it is no example, its features are those of the text it
stands for, and its threshold is that of that kind, or of all kinds together
where that one has none. The trees become conditional expressions, and candidates that
touch no base span are added from that score on; of added spans that overlap,
the one of best score is kept, then the longer, then the earlier.

The patterns take no quadratic time: their runs are possessive, and begin
where no earlier start can be. Null text counts as empty and has no spans.
One row comes out for each row that goes in, without a shuffle of texts.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.llm.common import only, query, staged, table

# Fixed formats of the base spans, in the order of their kinds.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What texts must hold for a format to be sought at all.
NEEDED = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": "[+][0-9]"}

GENERATORS = {
    "email": r"(?<![^\s@])[^\s@]++@[^\s@]++",
    "hidden_email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[({]\x20?(?i:at)\x20?[\])}]\x20?[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "number": r"(?:[+(]\x20?)?[0-9](?:[\x20().-]{0,2}[0-9])++",
    "dotted": r"(?<![0-9A-Fa-f])[0-9A-Fa-f]++(?:[.:][0-9A-Fa-f]++){3,}+",
}
GENERATORS_NEED = {"email": "@", "hidden_email": r"[\[({]\x20?(?i:at)\x20?[\])}]", "number": "[0-9]", "dotted": r"[0-9A-Fa-f][.:][0-9A-Fa-f]"}

# Kinds no base span can equal: the kind meant, and what turns their text into one of it.
STANDS_FOR = {"hidden_email": ("email", r"\x20?[\[({]\x20?(?i:at)\x20?[\])}]\x20?", "@")}

KINDS = [*BASE, *[kind for kind in GENERATORS if kind not in BASE]]
CONTEXT = r"(?i)(?:phone|tel|call|fax|mobile|mail|contact|card|visa|account|address|ip|host|server)\W{0,4}$"

ROUNDS = 16
RATE = 0.4
PRECISION = 0.95
MOST_VECTORS = 20_000

_SPANS = "array<struct<start:int,stop:int,match:string,before:string,after:string>>"


def matches(pattern: str, needed: str) -> Column:
    """Spans of all matches of a pattern in ``text``, with what stands around them."""
    pieces, found = F.split("text", pattern, -1), F.regexp_extract_all("text", F.lit(pattern), 0)

    def add(so_far: Column, pair: Column) -> Column:
        start = so_far["at"] + F.length(pair["piece"])
        stop = start + F.length(pair["match"])
        span = F.struct(
            start.alias("start"), stop.alias("stop"), pair["match"].alias("match"),
            F.right(pair["piece"], F.lit(24)).alias("before"), F.left(pair["next"], F.lit(8)).alias("after"),
        )
        return F.struct(stop.alias("at"), F.concat(so_far["out"], F.array(span)).alias("out"))

    last = F.size(found)
    zipped = F.zip_with(
        F.zip_with(F.slice(pieces, 1, last), found, lambda piece, match: F.struct(piece.alias("piece"), match.alias("match"))),
        F.slice(pieces, 2, last), lambda pair, after: F.struct(pair["piece"].alias("piece"), pair["match"].alias("match"), after.alias("next")),
    )
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))
    spans = F.aggregate(zipped, begin, add, lambda so_far: so_far["out"])
    return F.when(F.col("text").rlike(needed), spans).otherwise(F.array().cast(_SPANS))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the check digit of a number fits."""
    figures = F.transform(F.split(F.reverse(number), "(?<=.)(?=.)"), lambda c: c.cast("int"))
    doubled = F.transform(figures, lambda n, i: F.when(i % 2 == 1, n * 2 - F.when(n > 4, 9).otherwise(0)).otherwise(n))
    return F.aggregate(doubled, F.lit(0), lambda total, n: total + n) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """The rule of a kind; what fails it is no base span."""
    if kind == "ip":
        def small(part: Column) -> Column:
            plain = F.regexp_replace(part, "^0+(?=.)", "")
            return (F.length(plain) <= 3) & (F.coalesce(plain.try_cast("int"), F.lit(999)) <= 255)

        return F.forall(F.split(match, "[.]"), small)
    if kind == "card":
        return F.when(F.length(digits(match)).between(12, 19), luhn(digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(match)).between(9, 15)
    return F.lit(True)


FEATURES = ("digits", "letters", "ats", "dots", "colons", "groups", "longest", "plus", "bracket", "spaces", "dashes", "upper", "left", "right", "named")


def features(span: Column, kind: str) -> list[Column]:
    """Form and surroundings of a candidate in small whole numbers."""
    text = span["match"]
    if kind in STANDS_FOR:
        text = F.regexp_replace(text, *STANDS_FOR[kind][1:])

    def count(pattern: str, most: int) -> Column:
        return F.least(F.length(F.regexp_replace(text, pattern, "")), F.lit(most))

    groups = F.filter(F.split(text, "[^0-9]+"), lambda part: part != "")
    edge = {
        "left": F.when(span["before"].rlike(r"\w$"), 2).when(span["before"].rlike(r"[^\s\w]$"), 1).otherwise(0),
        "right": F.when(span["after"].rlike(r"^\w"), 2).when(span["after"].rlike(r"^[^\s\w]"), 1).otherwise(0),
    }
    own = {
        "digits": count("[^0-9]", 20), "letters": F.ceil(count("[^A-Za-z]", 24) / 4).cast("int"), "ats": count("[^@]", 2),
        "dots": count("[^.]", 4), "colons": count("[^:]", 3), "groups": F.least(F.size(groups), F.lit(6)),
        "longest": F.least(F.coalesce(F.array_max(F.transform(groups, lambda part: F.length(part))), F.lit(0)), F.lit(8)),
        "plus": text.startswith("+").cast("int"), "bracket": text.rlike(r"[(\[{]").cast("int"),
        "spaces": count(r"[^\x20]", 4), "dashes": count("[^-]", 4), "upper": count("[^A-Z]", 1),
        "named": span["before"].rlike(CONTEXT).cast("int"), **edge,
    }
    return [own[name].alias(name) for name in FEATURES]


def found_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, fold, base, candidates``: base spans by kind and proposed spans with features and label."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def base_spans(kind: str) -> Column:
        good = F.filter(matches(BASE[kind], NEEDED[kind]), lambda span: valid(kind, span["match"]))
        rank = F.lit(KINDS.index(kind)).alias("kind")
        return F.transform(good, lambda span: F.struct(span["start"].alias("start"), rank, span["stop"].alias("stop")))

    base = [base_spans(kind) for kind in BASE]
    marked = texts.select("doc_id", "text", F.array_sort(F.concat(*base)).alias("base"))

    def candidate(span: Column, kind: str) -> Column:
        same = F.exists(F.col("base"), lambda b: (b["start"] == span["start"]) & (b["stop"] == span["stop"]))
        touch = F.exists(F.col("base"), lambda b: (b["start"] < span["stop"]) & (span["start"] < b["stop"]))
        label = F.when(same, 1).when(~touch, 0)
        return F.struct(span["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), span["stop"].alias("stop"), label.alias("label"), *features(span, kind))

    def proposals(kind: str) -> Column:
        return F.transform(matches(GENERATORS[kind], GENERATORS_NEED[kind]), lambda span: candidate(span, kind))

    proposed = [proposals(kind) for kind in GENERATORS]
    fold = F.pmod(F.xxhash64("text"), F.lit(2)).alias("fold")
    return marked.select("doc_id", fold, "base", F.concat(*proposed).alias("candidates"))


class Tree(NamedTuple):
    """One split, and one more on either side: feature and threshold, then the values of four leaves."""

    top: tuple[int, float]
    below: tuple[tuple[int, float], tuple[int, float]]
    leaves: tuple[float, float, float, float]

    def values(self, rows: np.ndarray) -> np.ndarray:
        right = rows[:, self.top[0]] > self.top[1]
        deep = np.where(right, rows[:, self.below[1][0]] > self.below[1][1], rows[:, self.below[0][0]] > self.below[0][1])
        return np.array(self.leaves)[2 * right + deep]

    def column(self, candidate: Column) -> Column:
        def split(at: tuple[int, float], low: Column, high: Column) -> Column:
            return F.when(candidate[FEATURES[at[0]]] <= at[1], low).otherwise(high)

        leaf = [F.lit(float(value)) for value in self.leaves]
        return split(self.top, split(self.below[0], leaf[0], leaf[1]), split(self.below[1], leaf[2], leaf[3]))


def best_split(rows: np.ndarray, slope: np.ndarray, bend: np.ndarray) -> tuple[float, tuple[int, float]]:
    """Gain, feature and threshold of the split that lowers the loss most."""
    best = (0.0, (0, np.inf))
    whole = slope.sum() ** 2 / (bend.sum() + 1)
    for feature in range(rows.shape[1]):
        for threshold in np.unique(rows[:, feature])[:-1]:
            low = rows[:, feature] <= threshold
            g, h = slope[low].sum(), bend[low].sum()
            gain = g ** 2 / (h + 1) + (slope.sum() - g) ** 2 / (bend.sum() - h + 1) - whole
            if gain > best[0] + 1e-9:
                best = (gain, (feature, float(threshold)))
    return best


def boost(rows: np.ndarray, hits: np.ndarray, total: np.ndarray) -> list[Tree]:
    """Trees for rows of features of which ``hits`` of ``total`` candidates are base spans."""
    trees: list[Tree] = []
    if not len(rows) or not 0 < hits.sum() < total.sum():
        return trees
    scores = np.zeros(len(rows))
    for _ in range(ROUNDS):
        share = 1 / (1 + np.exp(-scores))
        slope, bend = hits - total * share, total * share * (1 - share)
        gain, top = best_split(rows, slope, bend)
        if not gain:
            break
        right = rows[:, top[0]] > top[1]
        below, leaves = [], []
        for side in (~right, right):
            at = best_split(rows[side], slope[side], bend[side])[1]
            below.append(at)
            deep = side & (rows[:, at[0]] > at[1])
            for part in (side & ~deep, deep):
                leaves.append(float(RATE * slope[part].sum() / (bend[part].sum() + 1)))
        trees.append(Tree(top, (below[0], below[1]), tuple(leaves)))
        scores = scores + trees[-1].values(rows)
    return trees


def calibrated(kinds: np.ndarray, scores: np.ndarray, hits: np.ndarray, total: np.ndarray) -> dict[int, float]:
    """The lowest score of each kind from which on enough examples are base spans."""
    found = {}
    for kind in np.unique(kinds):
        own = kinds == kind
        levels = np.unique(scores[own])[::-1]
        for level in levels:
            above = own & (scores >= level)
            if hits[above].sum() >= PRECISION * total[above].sum() and hits[above].sum():
                found[int(kind)] = float(level)
    return found


def examples(spans: DataFrame) -> DataFrame:
    """Counts of labelled candidates by features, kind and half of the documents."""
    each = spans.select("fold", F.explode("candidates").alias("c")).select("fold", "c.*").where("label is not null")
    each = each.where(~F.col("kind").isin([KINDS.index(kind) for kind in STANDS_FOR]))
    return each.groupBy("fold", "kind", *FEATURES).agg(F.sum("label").alias("hits"), F.count("*").alias("total"))


def score_of(trees: list[Tree], candidate: Column | None = None) -> Column:
    """The score of a candidate, or of a row that has its features as columns."""
    at = F.struct(*FEATURES) if candidate is None else candidate
    return reduce(lambda a, b: a + b, [tree.column(at) for tree in trees], F.lit(0.0))


def model(spans: DataFrame) -> tuple[list[Tree], dict[int, float]]:
    """Trees learned from the most frequent features, thresholds from all candidates."""
    counted = staged(examples(spans), "examples")
    rows = counted.where("fold = 0").orderBy(F.desc("total"), "kind", *FEATURES).limit(MOST_VECTORS).collect()
    x = np.array([[row[name] for name in FEATURES] for row in rows], float).reshape(-1, len(FEATURES))
    trees = boost(x, np.array([row.hits for row in rows], float), np.array([row.total for row in rows], float))
    # Rounded, so that few scores are left, whatever the number of features.
    scored = counted.where("fold = 1").select("kind", F.round(score_of(trees), 6).alias("score"), "hits", "total")
    levels = scored.groupBy("kind", "score").agg(F.sum("hits").alias("hits"), F.sum("total").alias("total")).collect()
    kinds, scores, hits, total = (np.array([row[i] for row in levels], kind) for i, kind in enumerate((int, float, float, float)))
    least = calibrated(kinds, scores, hits, total)
    pooled = calibrated(kinds * 0, scores, hits, total)
    for kind, (meant, *_) in STANDS_FOR.items():
        level = least.get(KINDS.index(meant), pooled.get(0))
        if level is not None and trees:
            least[KINDS.index(kind)] = level
    return trees, least


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` of every row of ``docs``.

    ``spans`` lists ``kind:start:end`` in code points, end exclusive.
    """
    spans = staged(found_spans(only(docs, "doc_id", "text")), "spans")
    trees, least = model(spans)

    def scored(candidate: Column) -> Column:
        score = F.round(score_of(trees, candidate), 6)
        wanted = F.lit(False)
        for kind, level in least.items():
            wanted = wanted | ((candidate["kind"] == kind) & (score >= level - 1e-9))
        length = candidate["stop"] - candidate["start"]
        return F.struct(
            score.alias("score"), length.alias("length"), (-candidate["start"]).alias("early"),
            candidate["start"].alias("start"), candidate["kind"].alias("kind"), candidate["stop"].alias("stop"),
            ((candidate["label"] == 0) & wanted).alias("wanted"),
        )

    added = F.array_distinct(F.filter(F.transform("candidates", scored), lambda c: c["wanted"]))
    spans = spans.withColumn("added", added)

    def beaten(one: Column, other: Column) -> Column:
        order = lambda c: F.struct(c["score"], c["length"], c["early"], c["kind"])
        return (other["start"] < one["stop"]) & (one["start"] < other["stop"]) & (order(other) > order(one))

    kept = F.filter("added", lambda one: ~F.exists(F.col("added"), lambda other: beaten(one, other)))
    plain = F.transform(kept, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["stop"].alias("stop")))
    names = F.array(*[F.lit(kind) for kind in KINDS])

    def listed(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")

    def count(rank: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == rank)).cast("bigint")

    counts = [count(rank).alias(f"n_{kind}") for rank, kind in enumerate(BASE)]
    return spans.select(
        "doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", plain))).alias("spans"), F.size(plain).cast("bigint").alias("n_added"),
    )


def redact(docs: DataFrame, found: DataFrame, *, mask: str = "#") -> DataFrame:
    """``doc_id, text`` with the characters of each span in ``found`` masked; joined by ``doc_id``."""
    ranges = F.transform(F.filter(F.split("spans", ","), lambda s: s != ""), lambda s: F.struct(
        F.element_at(F.split(s, ":"), 2).cast("int").alias("start"), F.element_at(F.split(s, ":"), 3).cast("int").alias("stop"),
    ))
    both = docs.select("doc_id", "text").join(found.select("doc_id", ranges.alias("ranges")), "doc_id")
    masked = F.aggregate("ranges", F.col("text"), lambda text, r: F.overlay(
        text, F.repeat(F.lit(mask), r["stop"] - r["start"]), r["start"] + 1, r["stop"] - r["start"],
    ))
    return both.select("doc_id", masked.alias("text"))


@query("op1_personal_data")
def op1_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return personal_data(table(spark, sf, "documents"))
