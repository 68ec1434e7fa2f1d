"""Usage and lag per job and period on a stream, with a watermark and late rows counted.

The watermark is the one of Spark's ``withWatermark``: the newest time of
earlier micro-batches less the delay, and a row is late when its period ended
before it. Spark's own operators drop late rows after they were combined and
report only how many combined rows that were, so the rule is applied here
before rows are combined, where rows and bytes can still be counted.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from rowferry.functions.records import name
from rowferry.schemas import LONG, TEXT, fields
from rowferry.streaming.slots import Slots

_PARTS = T.StructType([
    *fields(pipeline_id=TEXT, start=LONG, records=LONG, bytes=LONG, late_records=LONG, late_bytes=LONG, newest=LONG).fields,
])


def _micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


class UsageWindows:
    """Counts below ``root``, a folder for each micro-batch, and the watermark between them.

    A repeated batch finds the watermark it had and replaces its folder. Rows
    are combined in each task first, so a job with a third of all rows costs
    one row per task and period. Rows without a time have no period and are
    never late; their ``start`` is null. Null sizes count as 0.
    """

    def __init__(self, root: str, every: timedelta = timedelta(days=1), delay: timedelta = timedelta(hours=1)) -> None:
        if every <= timedelta(0) or delay < timedelta(0):
            raise ValueError("a period must last, and a delay must not be negative")
        self.root, self.every, self.delay = root, _micros(every), _micros(delay)
        self.slots = Slots(f"{root}/state", fields(newest=LONG))

    def add(self, df: DataFrame, batch_id: int, pipeline: str, ts: str, size: Column) -> None:
        spark = df.sparkSession
        last = self.slots.before(spark, batch_id)
        mark = last.newest if last else None
        time = F.unix_micros(name(ts).cast("timestamp"))
        start = time - F.pmod(time, F.lit(self.every))
        late = F.lit(False) if mark is None else F.coalesce(start + self.every <= mark - self.delay, F.lit(False))
        rows = df.select(
            name(pipeline).cast("string").alias("pipeline_id"), start.alias("start"), late.alias("late"),
            F.coalesce(size.cast("bigint"), F.lit(0)).alias("size"), time.alias("time"),
        )
        counted = rows.groupBy("pipeline_id", "start").agg(
            F.count_if(~F.col("late")).alias("records"),
            F.sum(F.when(~F.col("late"), F.col("size")).otherwise(0)).alias("bytes"),
            F.count_if("late").alias("late_records"),
            F.sum(F.when(F.col("late"), F.col("size")).otherwise(0)).alias("late_bytes"),
            F.max("time").alias("newest"),
        )
        folder = f"{self.root}/parts/batch_id={batch_id}"
        counted.write.mode("overwrite").parquet(folder)
        seen = spark.read.schema(_PARTS).parquet(folder).agg(F.max("newest")).first()[0]
        self.slots.save(spark, batch_id, max((n for n in (mark, seen) if n is not None), default=None))

    def windows(self, spark: SparkSession, now: datetime | None = None) -> DataFrame:
        """``pipeline_id, start, end, records, bytes, late_records, late_bytes, closed, lag_seconds``.

        A closed period takes no more rows. The lag is that of the job's
        newest row in the period; null without ``now``.
        """
        last = self.slots.before(spark)
        mark = F.lit(last.newest if last else None).cast("bigint") - self.delay
        parts = spark.read.schema(_PARTS).parquet(f"{self.root}/parts")
        sums = [F.sum(c).alias(c) for c in ("records", "bytes", "late_records", "late_bytes")]
        found = parts.groupBy("pipeline_id", "start").agg(*sums, F.max("newest").alias("newest"))
        end = F.col("start") + self.every
        lag = F.floor((F.lit(_micros(now - datetime(1970, 1, 1)) if now else None).cast("bigint") - F.col("newest")) / 1_000_000)
        return found.select(
            "pipeline_id", F.timestamp_micros("start").alias("start"), F.timestamp_micros(end).alias("end"),
            "records", "bytes", "late_records", "late_bytes",
            F.coalesce(end <= mark, F.lit(False)).alias("closed"), lag.cast("bigint").alias("lag_seconds"),
        )


def meter(stream: DataFrame, windows: UsageWindows, pipeline: str, ts: str, size: Column) -> DataStreamWriter:
    """A stream's rows into ``windows``; set trigger and checkpoint on the writer."""
    return stream.writeStream.foreachBatch(lambda rows, batch_id: windows.add(rows, batch_id, pipeline, ts, size))
