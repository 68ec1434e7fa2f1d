"""User code between bytes and rows, and on whole rows.

Rows reach the function in Arrow batches on the executors. A raise concerns
the row that caused it and no other.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rowferry.functions.records import name

ERROR = "_error"
FAILED_INPUT = "_input"

# A parser may make many rows of one payload; they leave in batches of about this many.
BATCH_ROWS = 10_000


def apply_row_function(
    df: DataFrame, fn: Callable[[dict[str, Any]], dict[str, Any]], schema: T.StructType
) -> DataFrame:
    """Run ``fn`` on each row. Failed rows have ``_error`` and ``_input`` set."""
    return _map_rows(df, lambda row: [fn(row)], schema)


def refused_rows(df: DataFrame, write: Callable[[list[dict[str, Any]]], None], rows_a_call: int, retries: int = 0) -> DataFrame:
    """Hand the rows to ``write`` in lists; ``_error`` and ``_input`` of those it refuses.

    A list that raises is halved until the refused rows stand alone, so good
    rows cost one call for a whole list, and one bad row some ``2 * log2(rows_a_call)``
    more. Only a row that stands alone is tried ``retries`` times again. Rows of
    a list that raised are handed over again, so ``write`` should use their key.
    """
    if rows_a_call < 1 or retries < 0:
        raise ValueError("a call takes at least one row, and retries are not negative")

    def refused(rows: list[dict[str, Any]]) -> Iterator[dict[str, str]]:
        waiting, tries = [rows], 0
        while waiting:
            part = waiting[-1]
            try:
                write(part)
            except Exception as reason:
                if len(part) > 1:
                    middle = len(part) // 2
                    waiting[-1:] = [part[middle:], part[:middle]]
                    continue
                if tries < retries:
                    tries += 1
                    continue
                yield {ERROR: f"{type(reason).__name__}: {reason}", FAILED_INPUT: json.dumps(part[0], default=str)}
            waiting.pop()
            tries = 0

    arrow = pa.schema([(ERROR, pa.string()), (FAILED_INPUT, pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, Any]] = []
        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= rows_a_call:
                yield pa.RecordBatch.from_pylist(list(refused(held[:rows_a_call])), schema=arrow)
                held = held[rows_a_call:]
        if held:
            yield pa.RecordBatch.from_pylist(list(refused(held)), schema=arrow)

    return df.mapInArrow(run, f"{ERROR} STRING, {FAILED_INPUT} STRING")


def parse_custom(
    df: DataFrame,
    column: str,
    fn: Callable[[Any], Iterable[dict[str, Any]]],
    schema: T.StructType,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Run a user parser on one payload column; it may give several rows.

    The columns in ``keep`` are repeated on each row. A payload the parser
    refuses gives one row with ``_error`` and ``_input`` set.
    """
    kept = list(keep)
    target = T.StructType([df.schema[c] for c in kept] + schema.fields)

    def expand(row: dict[str, Any]) -> list[dict[str, Any]]:
        around = {c: row[c] for c in kept}
        return [{**around, **item} for item in fn(row[column])]

    needed = df.select(*[name(c) for c in dict.fromkeys(kept + [column])])
    return _map_rows(needed, expand, target, kept)


def serialise_custom(df: DataFrame, fn: Callable[[dict[str, Any]], bytes], keep: Iterable[str] = ()) -> DataFrame:
    """Run a user serialiser on each row; the payload is ``value BINARY``."""
    kept = list(keep)
    target = T.StructType([df.schema[c] for c in kept] + [T.StructField("value", T.BinaryType())])
    return _map_rows(df, lambda row: [{**{c: row[c] for c in kept}, "value": fn(row)}], target, kept)


def _map_rows(
    df: DataFrame,
    expand: Callable[[dict[str, Any]], list[dict[str, Any]]],
    schema: T.StructType,
    kept: Iterable[str] = (),
) -> DataFrame:
    target = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in schema.fields]
        + [T.StructField(ERROR, T.StringType()), T.StructField(FAILED_INPUT, T.StringType())]
    )
    arrow = to_arrow_schema(target)
    kept = tuple(kept)

    def failed(row: dict[str, Any], reason: Exception) -> dict[str, Any]:
        marks = {ERROR: f"{type(reason).__name__}: {reason}", FAILED_INPUT: json.dumps(row, default=str)}
        return {**{c: row[c] for c in kept}, **marks}

    def rows_of(row: dict[str, Any]) -> list[dict[str, Any]]:
        try:
            return expand(row)
        except Exception as reason:
            return [failed(row, reason)]

    def fitting(row: dict[str, Any], made: list[dict[str, Any]]) -> list[dict[str, Any]]:
        try:
            pa.RecordBatch.from_pylist(made, schema=arrow)
            return made
        except (pa.ArrowException, TypeError, ValueError, AttributeError) as reason:
            return [failed(row, reason)]

    def batch_of(done: list[tuple[dict[str, Any], list[dict[str, Any]]]]) -> pa.RecordBatch:
        try:
            return pa.RecordBatch.from_pylist([m for _, made in done for m in made], schema=arrow)
        except (pa.ArrowException, TypeError, ValueError, AttributeError):
            # Some value has the wrong type: find its row, keep the rest.
            return pa.RecordBatch.from_pylist([m for row, made in done for m in fitting(row, made)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, held = [], 0
            for row in batch.to_pylist():
                made = rows_of(row)
                done.append((row, made))
                held += len(made)
                if held >= BATCH_ROWS:
                    yield batch_of(done)
                    done, held = [], 0
            if done:
                yield batch_of(done)

    return df.mapInArrow(run, target)
