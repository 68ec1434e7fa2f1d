"""Passages of a benchmark in a corpus, found with spaced seeds.

A mask ignores fixed word positions, so a hit survives a replaced word at
such a position. Hashes of all masked windows of the benchmark are joined with
those of every document. Around each hit the two texts are compared word by
word on the hit's diagonal, without gaps, and the stretch of best score is
kept: a match counts 1, a replaced word -4, so a stretch holds four matches
for each replaced word at least.

A stretch counts with ``LEAST_WORDS`` matches, or with all words of a shorter
item but ``REPLACED_SHARE`` of them. Items of fewer words than the masks span
say too little to be sought; they give nothing. Null and empty texts give
nothing; rows that repeat an id are searched on their own.

The benchmark is taken in slices of at most ``SLICE_ITEMS`` items, so what a
task is sent is bounded; more slices mean more passes over the corpus, never
less work. The corpus is not shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.llm.common import map_arrow, only, query, table
from rowferry.llm.words import Words, mixed

# Of every 13 words with two replaced, one of these fits; they weigh six of nine positions.
MASKS = ("111111", "1101011001", "110100111", "101110011")
SPAN = max(map(len, MASKS))
LEAST_WORDS = 13
REPLACED_SHARE = 0.2
REPLACED_COST = 4
SLICE_ITEMS = 50_000

FOUND = "item_id bigint, start_word bigint, end_word bigint, n_matched bigint"

_MANY = np.uint64(0xD6E8FEB86659FD93)
_FILTER_BITS = 22


def masked_windows(hashes: np.ndarray, mask: str) -> np.ndarray:
    """One hash for each window of the mask's span."""
    if hashes.size < len(mask):
        return np.zeros(0, np.uint64)
    found = np.zeros(hashes.size - len(mask) + 1, np.uint64)
    for step, use in enumerate(mask):
        if use == "1":
            found *= _MANY
            found += hashes[step:step + found.size]
    return mixed(found, int(mask, 2))


class SeedTable:
    """Masked windows of benchmark items, sorted by hash, behind a bit filter."""

    def __init__(self, ids: list[int], texts: list[str]):
        words = Words(pa.array(texts, pa.string()))
        self.ids, self.items = ids, [words.hashes[a:b] for a, b in zip(words.rows, words.rows[1:])]
        hashes, items, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for number, item in enumerate(self.items):
            if item.size >= SPAN:
                for mask in MASKS:
                    own = masked_windows(item, mask)
                    hashes.append(own)
                    items.append(np.full(own.size, number))
                    places.append(np.arange(own.size))
        hashes = np.concatenate(hashes)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.item, self.place = hashes[order], np.concatenate(items)[order], np.concatenate(places)[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self._slot(self.hashes)] = True

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def hits(self, words: np.ndarray) -> np.ndarray:
        """Distinct (item, diagonal) of all masks; the diagonal is the place in the text less that in the item."""
        found = []
        for mask in MASKS:
            own = masked_windows(words, mask)
            at = np.flatnonzero(self.filter[self._slot(own)])
            first = np.searchsorted(self.hashes, own[at])
            last = np.searchsorted(self.hashes, own[at], "right")
            count = last - first
            where = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            found.append(np.stack([self.item[where], np.repeat(at, count) - self.place[where]], 1))
        return np.unique(np.concatenate(found), axis=0)

    def overlaps(self, words: np.ndarray) -> Iterator[tuple[int | None, int, int, int]]:
        """``item_id``, start and end of the stretch in the text, and its matches."""
        for number, shift in self.hits(words).tolist():
            item = self.items[number]
            begin, end = max(0, shift), min(words.size, shift + item.size)
            same = words[begin:end] == item[begin - shift:end - shift]
            start, stop = best_stretch(same)
            matches = int(same[start:stop].sum())
            if matches >= min(LEAST_WORDS, math.ceil(item.size * (1 - REPLACED_SHARE))):
                yield self.ids[number], begin + start, begin + stop, matches


def best_stretch(same: np.ndarray) -> tuple[int, int]:
    """Bounds of the stretch of highest score, the first of equals."""
    scores = np.concatenate(([0], np.cumsum(np.where(same, 1, -REPLACED_COST))))
    gains = scores - np.minimum.accumulate(scores)
    stop = int(gains.argmax())
    return int(scores[:stop + 1].argmin()), stop


def seed_tables(benchmark: DataFrame, slice_items: int) -> Iterator[SeedTable]:
    """The benchmark in slices of bounded size."""
    items = only(benchmark, "item_id", "text").where("text is not null")
    slices = max(1, math.ceil(items.count() / slice_items))
    for number in range(slices):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(slices)) == number).orderBy("item_id", "text").collect()
        yield SeedTable([row.item_id for row in part], [row.text for row in part])


def find_overlaps(docs: DataFrame, benchmark: DataFrame, *, slice_items: int = SLICE_ITEMS) -> DataFrame:
    """``doc_id, item_id, start_word, end_word, n_matched``: all benchmark passages in ``docs``.

    Words are counted from 0, ``end_word`` is exclusive. Repeated passages
    within a document give a row each.
    """
    kind, context = docs.schema["doc_id"].dataType.simpleString(), docs.sparkSession.sparkContext
    found = None
    for seeds in seed_tables(benchmark, slice_items):
        own = map_arrow(only(docs, "doc_id", "text"), _searcher(context.broadcast(seeds)), f"doc_id {kind}, {FOUND}")
        found = own if found is None else found.unionAll(own)
    return found


def _searcher(seeds):
    def work(batch: pa.RecordBatch) -> dict:
        words, places, rows = Words(batch.column(1)), [], []
        for at, (begin, end) in enumerate(zip(words.rows, words.rows[1:])):
            for overlap in seeds.value.overlaps(words.hashes[begin:end]):
                places.append(at)
                rows.append(overlap)
        columns = {"doc_id": batch.column(0).take(pa.array(places, pa.int64()))}
        for number, name in enumerate(("item_id", "start_word", "end_word", "n_matched")):
            columns[name] = pa.array([row[number] for row in rows], pa.int64())
        return columns

    return work


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, slice_items: int = SLICE_ITEMS) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage; same columns, no shuffle."""
    at, context = docs.columns.index("text"), docs.sparkSession.sparkContext
    for seeds in seed_tables(benchmark, slice_items):
        docs = docs.mapInArrow(_cleaner(context.broadcast(seeds), at), docs.schema)
    return docs


def _cleaner(seeds, at: int):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column(at))
            each = (words.hashes[begin:end] for begin, end in zip(words.rows, words.rows[1:]))
            yield batch.filter(pa.array([next(seeds.value.overlaps(own), None) is None for own in each], pa.bool_()))

    return clean


@query("op4_decontaminate")
def op4_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return find_overlaps(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
