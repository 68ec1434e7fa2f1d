"""Masking of personal data. Null stays null everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REDACTED = "***"


def sha256_hex(col: Column, salt: str | None = None) -> Column:
    text = col.cast("string")
    return F.sha2(text if salt is None else F.concat(F.lit(salt), text), 256)


def redact(col: Column) -> Column:
    return F.when(col.isNotNull(), F.lit(REDACTED))


def keep_last(col: Column, keep: int = 4) -> Column:
    text = col.cast("string")
    hidden = F.greatest(F.char_length(text) - F.lit(keep), F.lit(0))
    tail = F.right(text, F.lit(keep)) if keep > 0 else F.lit("")
    return F.concat(F.repeat(F.lit("*"), hidden), tail)
