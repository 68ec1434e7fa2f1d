"""File sinks: JSON lines, CSV, staged Parquet, partitioned folders, compaction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.functions.records import TIME_FORMATS, name
from rowferry.operators.routing import TARGET
from rowferry.session import ADVISORY_SIZE, sql_settings

_MB = 1024 * 1024


def write_ndjson(df: DataFrame, path: str, mode: str = "append", compression: str = "none") -> None:
    df.write.mode(mode).options(**TIME_FORMATS).option("compression", compression).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "append", **options: str) -> None:
    df.write.mode(mode).options(**TIME_FORMATS).options(header="true", **options).csv(path)


def write_console(stream: DataFrame):
    return stream.writeStream.format("console").outputMode("append")


def discard(df: DataFrame) -> None:
    """Run the whole plan and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def stage_parquet(df: DataFrame, root: str, rows_per_file: int = 1_000_000, target_mb: int = 50,
                  mode: str = "append", compression: str = "zstd", gather: bool = True) -> None:
    """Larger Parquet files for one bulk load by the warehouse.

    The rebalance lets adaptive execution join small pieces and cut large ones
    to about ``target_mb``; ``rows_per_file`` bounds each file as well. When
    the tasks of ``df`` are large already, ``gather=False`` saves the shuffle.
    """
    with sql_settings(df.sparkSession, {ADVISORY_SIZE: target_mb * _MB}):
        (
            (df.hint("rebalance") if gather else df).write.mode(mode)
            .option("maxRecordsPerFile", rows_per_file).option("compression", compression).parquet(root)
        )


def date_parts(df: DataFrame, ts: str) -> DataFrame:
    """``year, month, day`` of a time column, for object paths."""
    return df.withColumns({"year": F.year(name(ts)), "month": F.month(name(ts)), "day": F.dayofmonth(name(ts))})


def write_partitioned(df: DataFrame, root: str, keys: list[str], fmt: str = "parquet", mode: str = "append",
                      replace_partitions: bool = False, rows_per_file: int = 0, **options: str) -> None:
    """Hive folders ``key=value/``.

    Rows are rebalanced by the keys, so a folder is written by few tasks, and
    one that holds a third of all rows by several. ``replace_partitions``
    overwrites only the folders that occur in ``df``. Text formats keep
    microseconds.
    """
    writer = df.hint("rebalance", *keys).write.partitionBy(*keys).format(fmt)
    writer = writer.options(**(TIME_FORMATS if fmt in ("json", "csv") else {})).options(**options)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if replace_partitions:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(root)
    else:
        writer.mode(mode).save(root)


def write_routed(df: DataFrame, root: str, fmt: str = "parquet", mode: str = "append") -> None:
    """All targets in one write: one folder per ``target_table``."""
    write_partitioned(df, root, [TARGET], fmt, mode)


def fanout(df: DataFrame, targets: list[str], write: Callable[[str, DataFrame], None]) -> None:
    """One write per declared target when the targets are different systems; the input is read once."""
    held = df.persist()
    try:
        for target in targets:
            write(target, held.where(F.col(TARGET) == target).drop(TARGET))
    finally:
        held.unpersist()


def compact(spark: SparkSession, source: str, destination: str, target_mb: int = 128,
            partition_keys: list[str] | None = None) -> None:
    """Many small Parquet files to few, same rows, written beside the source.

    Without partition folders the scan itself packs small files into tasks of
    ``target_mb``, so there is no shuffle. With them rows are rebalanced by
    folder. Afterwards point readers at the new folder (:func:`rowferry.sinks.tables.swap_location`).
    """
    size = target_mb * _MB
    packed = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": 0,
              "spark.sql.files.minPartitionNum": 1, ADVISORY_SIZE: size}
    with sql_settings(spark, packed):
        rows = spark.read.parquet(source)
        if partition_keys:
            write_partitioned(rows, destination, partition_keys, mode="errorifexists")
        else:
            rows.write.mode("errorifexists").parquet(destination)
