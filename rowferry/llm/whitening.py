"""Whitening of embeddings: each vector on the leading components of all of them, at unit variance.

1. Entries become whole numbers. Their count and sums are exact: each task
   sums high and low halves, Spark adds those as decimals.
2. The covariance is centred at a whole number next to the mean before
   anything is multiplied, so products of a batch are exact, and so is the
   covariance up to its last rounding.
3. Spectrum slicing (see ``spectrum``) gives the leading components of this
   table of fixed size, on the driver.
4. A further pass measures the covariance of what whitening gives.

A row is left out whose vector is null, empty, or holds null, a non-finite
entry or one whose whole number does not fit, and so is one whose length is
not that of most rows (the shorter one of equally many). Rows that repeat an
id count and are returned as often as they are there; ``vec_id`` may be null.
A component that carries less than ``LEAST_SHARE`` of the variance has no
direction of its own and is not returned, so equal vectors give no rows. A
``deviation`` beyond the range of long is null. The driver holds one matrix of
the vectors' width.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.llm.common import map_arrow, only, query, table
from rowferry.llm.spectrum import leading

COMPONENTS = 8
LEAST_SHARE = 1e-12
# Fixed values of the whole numbers.
SCALE, SHIFT = 1024, 100_000

_LARGEST = 2.0 ** 62
_EXACT = 2.0 ** 53


@dataclass(frozen=True)
class Moments:
    """Count, sums of each place, and the covariance of the whole numbers."""

    count: int
    sums: list[int]
    covariance: np.ndarray

    @property
    def centre(self) -> np.ndarray:
        """A whole number next to each mean, from below."""
        return np.array([total // self.count for total in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """What the sums are above ``count`` times the centre."""
        return [total % self.count for total in self.sums]


@dataclass(frozen=True)
class Whitener:
    """Leading components of the covariance; one column each."""

    moments: Moments
    values: np.ndarray
    axes: np.ndarray

    def apply(self, places: np.ndarray) -> np.ndarray:
        """Whitened rows from whole numbers less the centre."""
        rest = np.array([part / self.moments.count for part in self.moments.rest])
        return (places - rest) @ self.axes / np.sqrt(self.values)

    def explained(self) -> np.ndarray:
        return self.values / np.trace(self.moments.covariance)

    def deviations(self, places: np.ndarray) -> pa.Array:
        """Sums over a row of the squares of ``count * x - sum``; null beyond long."""
        count, rest = self.moments.count, self.moments.rest
        most = count * (float(np.abs(places.astype(float)).max(initial=0)) + 1)
        if places.shape[1] * most * most < 2.0 ** 62:
            return pa.array(((count * places - np.array(rest, np.int64)) ** 2).sum(axis=1))
        exact = [sum((count * int(x) - r) ** 2 for x, r in zip(row, rest)) for row in places]
        return pa.array([value if value < 1 << 63 else None for value in exact], pa.int64())


def clean(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the rows without a fault, entries as double."""
    entry = F.col("embedding").cast("array<double>")
    sound = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < _LARGEST / SCALE / 2))
    return only(vectors, "vec_id", "embedding").where(sound & (F.size("embedding") > 0)).select("vec_id", entry.alias("embedding"))


def whole(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The whole numbers of a batch of vectors of one width, a row each."""
    entries = pc.list_flatten(batch.column("embedding")).to_numpy(zero_copy_only=False)
    return np.floor(SCALE * entries).astype(np.int64).reshape(-1, width) + SHIFT


def _of_batches(df: DataFrame, width: int, work: Callable[[np.ndarray], dict], schema: str) -> DataFrame:
    return map_arrow(df.select("embedding"), lambda batch: work(whole(batch, width)), schema)


def totals(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """Count and exact sums of the whole numbers of vectors that are all ``width`` long."""
    def work(rows: np.ndarray) -> dict:
        return {
            "place": np.arange(rows.shape[1], dtype=np.int32), "n": np.full(rows.shape[1], len(rows), np.int64),
            "high": (rows >> 32).sum(axis=0), "low": (rows & 0xFFFFFFFF).sum(axis=0),
        }

    found = _of_batches(vectors, width, work, "place int, n bigint, high bigint, low bigint").groupBy("place").agg(
        F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(20,0)")).alias("high"), F.sum(F.col("low").cast("decimal(20,0)")).alias("low"),
    ).orderBy("place").collect()  # one row for each place of a vector
    if not found:
        return 0, [0] * width
    return found[0].n, [(int(row.high) << 32) + int(row.low) for row in found]


def moments(vectors: DataFrame, width: int) -> Moments:
    """Count, sums and covariance over all rows of a table of vectors that are all ``width`` long."""
    count, sums = totals(vectors, width)
    result = Moments(count, sums, np.zeros((width, width)))
    if not count:
        return result
    centre = result.centre
    at, to = np.triu_indices(width)

    def work(rows: np.ndarray) -> dict:
        places = (rows - centre).astype(float)
        products = (places.T @ places)[at, to]
        # Whole numbers add without rounding as long as their sum has a place for each bit.
        exact = float(np.square(places).sum(axis=0).max(initial=0)) < _EXACT
        whole_part = products if exact else np.zeros(at.size)
        return {
            "cell": np.arange(at.size, dtype=np.int32), "exact": whole_part.astype(np.int64),
            "rough": np.zeros(at.size) if exact else products,
        }

    cells = _of_batches(vectors, width, work, "cell int, exact bigint, rough double").groupBy("cell").agg(
        F.sum(F.col("exact").cast("decimal(20,0)")).alias("exact"), F.sum("rough").alias("rough"),
    ).orderBy("cell").collect()  # one row for each pair of places
    rest = result.rest
    for cell, i, j in zip(cells, at, to):
        value = (count * int(cell.exact) - rest[i] * rest[j]) / count ** 2 + cell.rough / count
        result.covariance[i, j] = result.covariance[j, i] = value
    return result


def fit(found: Moments) -> Whitener:
    """The leading components that carry variance."""
    values, axes = leading(found.covariance, COMPONENTS)
    carried = values > LEAST_SHARE * max(float(np.trace(found.covariance)), 0.0)
    return Whitener(found, values[carried], axes[:, carried])


def identity_error(vectors: DataFrame, whitener: Whitener) -> float:
    """Largest entry of the covariance of the whitened vectors less the identity, measured over all rows."""
    size = whitener.values.size
    if not size:
        return 0.0
    centre = whitener.moments.centre

    def work(rows: np.ndarray) -> dict:
        own = np.column_stack([whitener.apply(rows - centre), np.ones(len(rows))])
        return {"cell": np.arange((size + 1) ** 2, dtype=np.int32), "total": (own.T @ own).ravel()}

    cells = _of_batches(vectors, centre.size, work, "cell int, total double").groupBy("cell").agg(F.sum("total").alias("total"))
    sums = np.array([row.total for row in cells.orderBy("cell").collect()]).reshape(size + 1, size + 1) / whitener.moments.count
    return float(np.abs(sums[:size, :size] - np.outer(sums[:size, size], sums[:size, size]) - np.eye(size)).max())


def whitened(vectors: DataFrame) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each vector and component."""
    sound = clean(vectors)
    # The width of most rows; only counts of widths are compared.
    widths = sound.groupBy(F.size("embedding").alias("width")).agg(F.count("*").alias("rows"))
    most = widths.orderBy(F.desc("rows"), "width").first()
    width = most.width if most else 0
    sound = sound.where(F.size("embedding") == width)
    found = moments(sound, width)
    whitener = fit(found) if found.count else Whitener(found, np.zeros(0), np.zeros((0, 0)))
    error, size, centre = identity_error(sound, whitener), whitener.values.size, found.centre if found.count else None

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if size else ():
            places = whole(batch, centre.size) - centre
            each = pa.array(np.repeat(np.arange(batch.num_rows), size))
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id").take(each),
                "component": np.tile(np.arange(1, size + 1, dtype=np.int32), batch.num_rows),
                "n": np.full(len(each), found.count, np.int64),
                "deviation": whitener.deviations(places).take(each),
                "whitened": whitener.apply(places).ravel(),
                "explained": np.tile(whitener.explained(), batch.num_rows),
                "identity_error": np.full(len(each), error),
            })

    kind = sound.schema["vec_id"].dataType.simpleString()
    return sound.mapInArrow(rows_of, (
        f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    ))


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitened(table(spark, sf, "embeddings"))
