"""Jobs on tables that are pulled by a growing column instead of streamed.

The state folder has a log of ranges. A range is planned, with both its ends
and the time, before any of its rows is read, so a repeat after a crash reads
the same range and replaces what the first attempt wrote. The batch ledger says
which ranges are finished; the end of the last one is the cursor.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.config import Job
from rowferry.functions.casts import instant
from rowferry.functions.records import name
from rowferry.schemas import LONG, TEXT, fields
from rowferry.session import one_row
from rowferry.streaming import ledger

RANGES = T.StructType([*fields(batch_id=LONG, low=TEXT, high=TEXT).fields, T.StructField("at", T.TimestampType())])


class Range(NamedTuple):
    """Rows above ``low`` and up to ``high``; the ends as text of the column's type."""

    batch_id: int
    low: str | None
    high: str
    at: datetime

    def rows(self, table: DataFrame, column: str) -> DataFrame:
        """Its rows; the comparison reaches the scan."""
        end = _end(table, column, self.high)
        found = table.where(name(column) <= end)
        return found if self.low is None else found.where(name(column) > _end(table, column, self.low))


def _end(table: DataFrame, column: str, value: str) -> Column:
    return F.lit(value).cast(table.schema[column].dataType)


def last_range(spark: SparkSession, path: str) -> Range | None:
    """The newest planned range, or None before the first."""
    try:
        found = spark.read.schema(RANGES).json(path).orderBy(F.desc("batch_id")).first()
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if found is None else Range(*found)


def plan_range(table: DataFrame, column: str, last: Range | None, page_rows: int | None, at: datetime) -> Range | None:
    """The range after ``last``: all newer rows, or about ``page_rows`` of them; None when there are none.

    Rows equal in the column are never parted, so a page is larger by those
    that tie with its last row. Null is never newer.
    """
    low = last.high if last else None
    newer = table if low is None else table.where(name(column) > _end(table, column, low))
    values = newer.select(name(column).alias("v")).where("v is not null")
    if page_rows:
        values = values.orderBy("v").limit(page_rows)
    high = values.agg(F.max("v").cast("string")).first()[0]
    return None if high is None else Range(last.batch_id + 1 if last else 0, low, high, at)


def run_ranges(
    table: DataFrame, job: Job, state: str, run_id: str, process: Callable[[DataFrame, int, datetime], None], at: datetime | None,
) -> int:
    """Pull until nothing is newer; how many ranges were processed."""
    spark, column = table.sparkSession, job.source.require("cursor_column")
    size, path = job.source.get("page_rows"), f"{state}/ranges"
    last, done = last_range(spark, path), 0
    while True:
        if last is not None and not ledger.is_finished(spark, f"{state}/ledger", run_id, last.batch_id):
            current = last
        else:
            now = at or datetime.now(timezone.utc).replace(tzinfo=None)
            current = plan_range(table, column, last, int(size) if size else None, now)
            if current is None:
                return done
            row = one_row(spark, RANGES, current.batch_id, current.low, current.high, current.at).coalesce(1)
            row.withColumn("at", instant(current.at)).write.mode("append").json(path)
        rows = current.rows(table, column)
        ledger.once(rows, f"{state}/ledger", run_id, current.batch_id, current.at, lambda df: process(df, current.batch_id, current.at))
        last, done = current, done + 1
