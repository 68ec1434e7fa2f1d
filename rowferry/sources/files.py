"""Files that are each read once, with a ledger of the names already read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters that make a path a pattern.
_PATTERN_SIGNS = re.compile(r"([\\*?\[\]{}])")

LEDGER_SCHEMA = T.StructType([T.StructField("path", T.StringType(), False)])


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``path, length, modified`` of every file below ``root``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.load(root).select("path", "length", F.col("modificationTime").alias("modified"))


def as_literal(path: str) -> str:
    """A path that a scan takes as it is, not as a pattern."""
    return _PATTERN_SIGNS.sub(r"\\\1", path)


def new_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """The listed files whose path the ledger does not hold."""
    return files.join(ledger.select("path"), "path", "left_anti")


def read_new_files(
    spark: SparkSession,
    root: str,
    fmt: str,
    ledger: DataFrame,
    schema: T.StructType | str,
    pattern: str = "*",
    max_files: int | None = None,
    **options: str,
) -> tuple[DataFrame, DataFrame]:
    """Rows of the files not yet in the ledger, and the list of those files.

    The comparison is done on file names, not on rows, so files already read
    are never opened. The driver holds the names of the new files, as it does
    for any file scan; ``max_files`` takes that many in name order and leaves
    the others to the next call. Append the list to the ledger when the sink
    confirms.
    """
    fresh = new_files(list_files(spark, root, pattern), ledger).select("path").orderBy("path")
    paths = [r.path for r in (fresh if max_files is None else fresh.limit(max_files)).collect()]
    reader = spark.read.format(fmt).schema(schema).options(**options).option("basePath", root)
    rows = reader.load([as_literal(p) for p in paths]) if paths else spark.createDataFrame([], schema)
    return rows, spark.createDataFrame([(p,) for p in paths], LEDGER_SCHEMA)


def mark_read(read: DataFrame, ledger_path: str) -> None:
    read.select("path").write.mode("append").parquet(ledger_path)


def stream_files(
    spark: SparkSession,
    root: str,
    fmt: str,
    schema: T.StructType | str,
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """The same as a stream; its checkpoint is the ledger."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(root)
