"""A table of finished micro-batches, so that a repeated one is not written again."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.session import one_row

LEDGER = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("finished", T.TimestampType(), False),
])


def _entry(path: str, run_id: str, batch_id: int) -> str:
    """A folder for each entry, so that looking one up reads no other."""
    return f"{path}/{run_id}/{batch_id}"


def finished_batches(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    found = spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(path)
    return found.where(F.col("run_id") == run_id)


def is_finished(spark: SparkSession, path: str, run_id: str, batch_id: int) -> bool:
    try:
        return not spark.read.schema(LEDGER).parquet(_entry(path, run_id, batch_id)).isEmpty()
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def once(df: DataFrame, path: str, run_id: str, batch_id: int, at: datetime, write: Callable[[DataFrame], None]) -> bool:
    """Run ``write`` unless the batch is in the ledger, then enter it.

    ``write`` must replace what an unfinished attempt left (a folder per batch,
    or an upsert by key): a crash between the two steps repeats it.
    """
    spark = df.sparkSession
    if is_finished(spark, path, run_id, batch_id):
        return False
    write(df)
    one_row(spark, LEDGER, run_id, batch_id, at).coalesce(1).write.mode("overwrite").parquet(_entry(path, run_id, batch_id))
    return True
