"""Catalogue tables and relational tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from rowferry.errors import ConfigError


def read_table(spark: SparkSession, table: str, version: int | str | None = None) -> DataFrame:
    """A table's current rows, or those of an older version where its format keeps any."""
    if version is None:
        return spark.read.table(table)
    return spark.read.option("versionAsOf", str(version)).table(table)


def jdbc_read_options(
    url: str,
    table: str,
    part_column: str,
    bounds: tuple[Any, Any],
    partitions: int,
    fetch_size: int = 10_000,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    if partitions < 1:
        raise ConfigError("a relational read needs at least one partition")
    ranges = {
        "partitionColumn": part_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }
    base = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    return {**base, **ranges}


def read_jdbc(spark: SparkSession, url: str, table: str, part_column: str, bounds: tuple[Any, Any],
              partitions: int, **more: Any) -> DataFrame:
    """A relational table in ranges of ``part_column``, read side by side.

    Bounds only place the ranges; rows outside them are read by the first and
    the last. Filters and column choices reach the database.
    """
    options = jdbc_read_options(url, table, part_column, bounds, partitions, **more)
    return spark.read.format("jdbc").options(**options).load()
