"""Micro-batches gathered into large Parquet files for one bulk load each.

A group of micro-batches is open until it holds enough bytes or has waited
long enough; then it is sealed. Loaders see sealed groups only.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.records import name
from rowferry.schemas import LONG, TEXT, fields
from rowferry.session import one_row
from rowferry.sinks.files import stage_parquet
from rowferry.sources.files import list_files
from rowferry.streaming.slots import Slots

_MB = 1024 * 1024
GROUP, PART = "_group", "_part"

SEALED = T.StructType([
    *fields(group=LONG, place=TEXT, parts=LONG, last_batch=LONG, bytes=LONG).fields, T.StructField("sealed", T.TimestampType()),
])
_OPEN = fields(group=LONG, opened=LONG)


def _micros(at: datetime) -> int:
    return (at.replace(tzinfo=None) - datetime(1970, 1, 1)) // timedelta(microseconds=1)


class GatheredStage:
    """One query's groups below ``root``: ``open``, ``staged``, and the seals that make them visible.

    Writing the seal is the one step that publishes a group. A repeated batch
    replaces its own part of the open group, or does nothing when a seal
    already holds it, so every row is in one sealed group exactly once. The
    age of a group is checked when a batch arrives and by :meth:`flush`; files
    of open groups are not deleted.
    """

    def __init__(self, root: str, target_mb: float = 50, max_age: timedelta = timedelta(seconds=60), compression: str = "zstd") -> None:
        self.root, self.target, self.max_age, self.compression = root, int(target_mb * _MB), max_age, compression
        self.slots = Slots(f"{root}/state", _OPEN)

    def _seal_of(self, spark: SparkSession, group: int) -> Row | None:
        try:
            return spark.read.schema(SEALED).json(f"{self.root}/seals/{group}").where(F.col("group").isNotNull()).first()
        except AnalysisException as absent:
            if absent.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def add(self, df: DataFrame, batch_id: int, at: datetime) -> str:
        """Keep one micro-batch, and seal its group when that is due. Returns the folder of the batch."""
        spark, now = df.sparkSession, _micros(at)
        last = self.slots.before(spark, batch_id)
        group, opened = (last.group, last.opened) if last else (0, now)
        while (seal := self._seal_of(spark, group)) is not None:
            if seal.last_batch >= batch_id:
                return f"{self._open(group)}/{PART}={batch_id}"
            group, opened = group + 1, now
        place = f"{self._open(group)}/{PART}={batch_id}"
        stage_parquet(df, place, target_mb=max(1, self.target // _MB), mode="overwrite", compression=self.compression)
        parts, size = self._held(spark, group)
        if parts and (size >= self.target or now - opened >= self.max_age // timedelta(microseconds=1)):
            self._seal(spark, df.schema, group, parts, size, batch_id, at)
        self.slots.save(spark, batch_id, group, opened)
        return place

    def flush(self, spark: SparkSession, at: datetime) -> bool:
        """Seal the open group whatever its size, as at the end of a run; False where nothing is open."""
        last = self.slots.before(spark)
        if last is None or self._seal_of(spark, last.group) is not None:
            return False
        parts, size = self._held(spark, last.group)
        if not parts:
            return False
        schema = spark.read.parquet(self._open(last.group)).drop(PART).schema
        self._seal(spark, schema, last.group, parts, size, last.batch_id, at)
        return True

    def _open(self, group: int) -> str:
        return f"{self.root}/open/{GROUP}={group}"

    def _held(self, spark: SparkSession, group: int) -> tuple[int, int]:
        """Parts and bytes of an open group; it holds what arrived within its age, so few files are listed."""
        files = list_files(spark, self._open(group), "part-*")
        folder = F.regexp_extract("path", f"/{PART}=([0-9]+)/[^/]*$", 1)
        row = files.agg(F.count_distinct(folder).alias("parts"), F.coalesce(F.sum("length"), F.lit(0)).alias("size")).first()
        return row.parts, row.size

    def _seal(self, spark: SparkSession, schema: T.StructType, group: int, parts: int, size: int, batch_id: int, at: datetime) -> None:
        """Gather the parts, unless there is only one, and publish the group."""
        place = "open"
        if parts > 1:
            place = "staged"
            rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(self._open(group))
            target = max(1, self.target // _MB)
            stage_parquet(rows, f"{self.root}/staged/{GROUP}={group}", target_mb=target, mode="overwrite", compression=self.compression)
        sealed = one_row(spark, SEALED, group, place, parts, batch_id, size, at)
        sealed.coalesce(1).write.mode("overwrite").json(f"{self.root}/seals/{group}")

    def seals(self, spark: SparkSession, after: int = -1) -> DataFrame:
        """``group, place, parts, last_batch, bytes, sealed, folder`` of the groups a loader has not taken yet."""
        try:
            found = spark.read.schema(SEALED).option("recursiveFileLookup", "true").json(f"{self.root}/seals")
        except AnalysisException as absent:
            if absent.getCondition() != "PATH_NOT_FOUND":
                raise
            found = spark.createDataFrame([], SEALED)
        folder = F.concat(F.lit(f"{self.root}/"), "place", F.lit(f"/{GROUP}="), F.col("group").cast("string"))
        return found.where(F.col("group") > after).withColumn("folder", folder)

    def rows(self, spark: SparkSession, schema: T.StructType, after: int = -1) -> DataFrame:
        """The rows of all sealed groups; folders of others are pruned by their number."""
        seals = self.seals(spark, after)
        out = spark.createDataFrame([], schema)
        for place, inside in (("open", [T.StructField(PART, LONG)]), ("staged", [])):
            layout = T.StructType([*schema.fields, T.StructField(GROUP, LONG), *inside])
            try:
                held = spark.read.schema(layout).parquet(f"{self.root}/{place}")
            except AnalysisException as absent:
                if absent.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            chosen = seals.where(F.col("place") == place).select(F.col("group").alias(GROUP))
            out = out.unionByName(held.join(chosen, GROUP, "left_semi").select(*[name(f.name) for f in schema.fields]))
        return out
