"""Field mapping, casts, defaults, lineage, record keys."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.config import FieldMapping
from rowferry.errors import TransformError
from rowferry.functions import casts
from rowferry.functions.records import name, record_key

ERRORS = "_errors"

# Stands between error texts while they are joined.
MARK = "\u001f"

# Names of the lineage columns.
LINEAGE_COLUMNS = ("_pipeline_id", "_source_topic", "_pipeline_ingest_timestamp")


def error_list(found: Iterable[Column]) -> Column:
    """The texts that are not null, as an array.

    Joined and split again, which stays in generated code and costs next to
    nothing for the usual row without a fault; a filter with a lambda does not.
    """
    return F.array_remove(F.split(F.concat_ws(MARK, *found), MARK), "")


def add_errors(df: DataFrame, found: Iterable[Column]) -> DataFrame:
    """Append texts to ``_errors``; null items are no error."""
    present = error_list(found)
    if ERRORS in df.columns:
        present = F.concat(F.col(ERRORS), present)
    return df.withColumn(ERRORS, present)


def field_mapper(df: DataFrame, mappings: Iterable[FieldMapping], carry: Iterable[str] = ()) -> DataFrame:
    """Keep the mapped columns only, in mapping order, under their new names.

    Source columns that do not exist are skipped; no mappings leave ``df`` as
    it is. A cast that would lose a value gives null and, when any mapping
    casts, an entry ``cast:<column>`` in ``_errors``. ``carry`` names columns
    that pass through beside the mapped ones.
    """
    wanted = list(mappings)
    if not wanted:
        return df
    found = [m for m in wanted if m.source_field in df.columns]
    if not found:
        raise TransformError("no mapped source field exists")
    carried = [c for c in carry if c in df.columns]
    columns, faults = [], []
    for m in found:
        value = name(m.source_field)
        if m.cast:
            target = casts.cast_type(m.cast)
            faults.append(F.when(casts.does_not_fit(value, target), F.lit(f"cast:{m.sink_field}")))
            value = casts.safe_cast(value, target)
        columns.append(value.alias(m.sink_field))
    if not faults:
        return df.select(*columns, *[name(c) for c in carried])
    marked = error_list(faults)
    if ERRORS in carried:
        marked = F.concat(name(ERRORS), marked)
    others = [name(c) for c in carried if c != ERRORS]
    return df.select(*columns, *others, marked.alias(ERRORS))


def epoch_columns_to_iso(df: DataFrame, columns: Iterable[str], unit: str = "s") -> DataFrame:
    return df.withColumns({c: casts.epoch_to_iso(name(c), unit) for c in columns})


def to_utc(df: DataFrame, column: str, zone: str, into: str | None = None) -> DataFrame:
    return df.withColumn(into or column, casts.to_utc(name(column), zone))


def fill_defaults(df: DataFrame, defaults: dict[str, Any]) -> DataFrame:
    """Replace null by the declared default, in the column's own type."""
    filled = {
        c: F.coalesce(name(c), casts.constant(v, df.schema[c].dataType)) for c, v in defaults.items() if c in df.columns
    }
    return df.withColumns(filled) if filled else df


def add_lineage(df: DataFrame, pipeline_id: str, source: str | Column, at: datetime) -> DataFrame:
    """Who moved the row, from where, and when; the time is passed in, so a retry repeats it."""
    origin = F.lit(source) if isinstance(source, str) else source
    values = (F.lit(pipeline_id), origin, casts.instant(at))
    return df.withColumns(dict(zip(LINEAGE_COLUMNS, values)))


def with_key(df: DataFrame, columns: Iterable[str], into: str = "key") -> DataFrame:
    return df.withColumn(into, record_key(columns))


def chain(df: DataFrame, steps: Iterable[Any]) -> DataFrame:
    """Apply the steps in order; Catalyst merges their projections."""
    return reduce(lambda d, step: d.transform(step), steps, df)
