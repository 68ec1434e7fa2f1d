"""Row filters. The two kinds treat null differently, on purpose."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.errors import TransformError
from rowferry.functions.records import name
from rowferry.operators.mapping import ERRORS


def _keep(df: DataFrame, wanted, spare_errors: bool) -> DataFrame:
    """Filter, but let rows already marked as bad pass when the caller splits them later."""
    if spare_errors and ERRORS in df.columns:
        wanted = wanted | (F.size(ERRORS) > 0)
    return df.where(wanted)


def row_filter(df: DataFrame, column: str, spare_errors: bool = False) -> DataFrame:
    """Keep rows whose Boolean column is true; false and null are dropped."""
    if column not in df.columns:
        raise TransformError(f"filter column {column!r} does not exist")
    if not isinstance(df.schema[column].dataType, T.BooleanType):
        raise TransformError(f"filter column {column!r} is not Boolean")
    return _keep(df, name(column), spare_errors)


def drop_if(df: DataFrame, condition: str, spare_errors: bool = False) -> DataFrame:
    """Drop rows for which the SQL condition is true; false and null are kept."""
    return _keep(df, ~F.coalesce(F.expr(condition), F.lit(False)), spare_errors)
