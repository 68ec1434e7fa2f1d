"""Deterministic made-up values for load tests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.functions.records import name


def _digits(id_column: Column, label: str, seed: int) -> Column:
    """Eight hexadecimal digits of a hash, as a number below 2**32."""
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(label), id_column.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def synthetic_columns(df: DataFrame, id_column: str, columns: Iterable[tuple[str, str, int]], seed: int) -> DataFrame:
    """Add ``(name, kind, size)`` columns that depend on the id and the seed alone.

    Kinds: ``integer`` gives 0 to size-1, ``float`` 0 to below size, ``text``
    the first ``size`` digits of a hash.
    """
    made: dict[str, Column] = {}
    for label, kind, size in columns:
        if kind == "integer":
            made[label] = F.pmod(_digits(name(id_column), label, seed), F.lit(size))
        elif kind == "float":
            made[label] = _digits(name(id_column), label, seed) / F.lit(float(2**32)) * F.lit(float(size))
        elif kind == "text":
            text = F.concat_ws(":", F.lit(str(seed)), F.lit(label), name(id_column).cast("string"))
            made[label] = F.substring(F.md5(text), 1, size)
        else:
            raise ValueError(f"unknown kind {kind!r}")
    return df.withColumns(made)


def generate(spark: SparkSession, n: int, columns: Iterable[tuple[str, str, int]], seed: int) -> DataFrame:
    """``n`` rows; the same seed gives the same rows on any cluster."""
    return synthetic_columns(spark.range(n).toDF("id"), "id", columns, seed)


def generate_stream(spark: SparkSession, rows_per_second: int, columns: Iterable[tuple[str, str, int]],
                    seed: int) -> DataFrame:
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return synthetic_columns(ticks.withColumnRenamed("value", "id"), "id", columns, seed)
