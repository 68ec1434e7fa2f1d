"""Rows to payload text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.functions.records import record_json


def to_ndjson(df: DataFrame) -> DataFrame:
    """One column ``value``: a JSON object per row, null fields left out."""
    return df.select(record_json(df.columns).alias("value"))


def receipt(df: DataFrame) -> DataFrame:
    """Rows and bytes the NDJSON writer makes of ``df``, line ends included."""
    size = F.octet_length("value") + F.lit(1)
    return to_ndjson(df).agg(
        F.count("*").alias("rows_written"),
        F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("bytes_written"),
    )
