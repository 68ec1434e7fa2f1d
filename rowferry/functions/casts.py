"""Type coercion by declared name, and time values."""

from __future__ import annotations

from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.errors import ConfigError

# Cast names a mapping may declare.
CAST_TYPES = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


def cast_type(name: str) -> T.DataType:
    try:
        return CAST_TYPES[name.lower()]
    except KeyError:
        raise ConfigError(f"unknown cast {name!r}; known: {', '.join(CAST_TYPES)}") from None


def safe_cast(col: Column, target: T.DataType) -> Column:
    """The value in the target type, or null where it does not fit."""
    return col.try_cast(target)


def does_not_fit(col: Column, target: T.DataType) -> Column:
    """True where a present value would be lost by :func:`safe_cast`."""
    return col.isNotNull() & col.try_cast(target).isNull()


def constant(value: Any, kind: T.DataType) -> Column:
    """A Python value as a literal of the given type.

    A time without a zone is UTC, whatever the zone of the driver's machine.
    """
    if isinstance(value, datetime):
        if isinstance(kind, T.TimestampNTZType):
            aware = value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value
            return F.lit(aware.isoformat(sep=" ")).cast(kind)
        value = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    return F.lit(value).cast(kind)


def instant(at: datetime | None) -> Column:
    return constant(at, T.TimestampType())


def epoch_to_timestamp(col: Column, unit: str = "s") -> Column:
    if unit == "s":
        return F.timestamp_seconds(col)
    if unit == "ms":
        return F.timestamp_millis(col)
    raise ConfigError(f"epoch unit must be 's' or 'ms', not {unit!r}")


def epoch_to_iso(col: Column, unit: str = "s") -> Column:
    """Epoch seconds or milliseconds as ISO 8601 text in UTC (session zone UTC)."""
    pattern = "yyyy-MM-dd'T'HH:mm:ss'Z'" if unit == "s" else "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    return F.date_format(epoch_to_timestamp(col, unit), pattern)


def to_utc(col: Column, zone: str) -> Column:
    """A local wall-clock time of ``zone`` as the wall-clock time in UTC."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), col.cast(T.TimestampNTZType()))
