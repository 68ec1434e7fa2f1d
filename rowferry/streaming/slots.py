"""What a stream has to remember from one micro-batch to the next, in constant space."""

from __future__ import annotations

from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T

from rowferry.schemas import LONG
from rowferry.session import one_row


class Slots:
    """One row of state after each of the last two batches, in two folders written in turn.

    A crash while one is written leaves the other, and a repeated batch finds
    the state that the batch before it left. One query writes them.
    """

    def __init__(self, path: str, schema: T.StructType) -> None:
        self.path, self.schema = path, T.StructType([T.StructField("batch_id", LONG, False), *schema.fields])

    def _read(self, spark: SparkSession, slot: int) -> Row | None:
        try:
            return spark.read.schema(self.schema).json(f"{self.path}/{slot}").where("batch_id IS NOT NULL").first()
        except AnalysisException as absent:
            if absent.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def before(self, spark: SparkSession, batch_id: int | None = None) -> Row | None:
        """The state that the newest batch below ``batch_id`` left; of any batch without it."""
        found = [row for row in (self._read(spark, slot) for slot in (0, 1)) if row and (batch_id is None or row.batch_id < batch_id)]
        return max(found, key=lambda row: row.batch_id, default=None)

    def save(self, spark: SparkSession, batch_id: int, *values: Any) -> None:
        kept = [row.batch_id if row else -1 for row in (self._read(spark, slot) for slot in (0, 1))]
        slot = kept.index(batch_id) if batch_id in kept else kept.index(min(kept))
        one_row(spark, self.schema, batch_id, *values).coalesce(1).write.mode("overwrite").json(f"{self.path}/{slot}")
