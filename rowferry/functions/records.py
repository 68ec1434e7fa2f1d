"""Whole-record expressions: keys, JSON text, sizes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that joins key parts, and text that stands for null.
KEY_SEPARATOR = "\u001f"
KEY_NULL = "\u0000"

# Text forms of times in JSON and CSV.
TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def name(column: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + column.replace("`", "``") + "`")


def record_key(columns: Iterable[str]) -> Column:
    """A deterministic id: the same values give the same id on every replay."""
    parts = [F.coalesce(name(c).cast("string"), F.lit(KEY_NULL)) for c in columns]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def record_json(columns: Iterable[str]) -> Column:
    """One JSON object per row; null fields are left out, times keep their microseconds."""
    return F.to_json(F.struct(*[name(c) for c in columns]), TIME_FORMATS)
