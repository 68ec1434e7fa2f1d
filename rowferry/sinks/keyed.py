"""Tables of the current row of each key, merged in the order of the changes.

Rows lie in ``folders`` by a hash of their key. Each keeps the order of the
change that made it, and a deleted key stays as a tombstone, so a change that
comes late never undoes a newer one. A merge reads and writes only the folders
that its changes fall into; all others are shared with the version before.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.errors import ConfigError
from rowferry.functions.casts import instant
from rowferry.functions.records import name
from rowferry.operators import cdc
from rowferry.session import stage
from rowferry.sinks import versions
from rowferry.sinks.files import write_partitioned

FOLDER = "_folder"


@dataclass(frozen=True)
class KeyedTable:
    """``table`` is a view of the live rows; its data, tombstones and index lie below ``path``.

    ``retention`` (an interval such as ``30 days``) ends tombstones: those older
    than that go when their folder is next written. Without it they stay. A
    change may be later than the retention only if its key was never deleted.
    """

    table: str
    path: str
    keys: list[str]
    order: list[str]
    folders: int = 64
    retention: str | None = None
    hidden: list[str] = field(default_factory=lambda: [cdc.ORDER, cdc.GONE, cdc.GONE_AT, FOLDER])

    def create(self, spark: SparkSession, schema: T.StructType, order_types: T.StructType) -> None:
        """An empty table with the columns of ``schema``; one that exists stays."""
        clash = [c for c in schema.names if c in self.hidden]
        if clash:
            raise ConfigError(f"columns {clash} clash with those of a keyed table")
        found = versions.current(spark, self.table)
        if found is None:
            versions.publish(spark, self.table, self.path, self._state(schema, order_types), FOLDER, {}, "start", schema.names, f"NOT {cdc.GONE}")

    def _state(self, schema: T.StructType, order_types: T.StructType) -> T.StructType:
        return T.StructType([
            *schema.fields, T.StructField(cdc.ORDER, T.StructType([order_types[c] for c in self.order])),
            T.StructField(cdc.GONE, T.BooleanType()), T.StructField(cdc.GONE_AT, T.TimestampType()), T.StructField(FOLDER, T.IntegerType()),
        ])

    def _version(self, spark: SparkSession) -> versions.Version:
        found = versions.current(spark, self.table)
        if found is None:
            raise ConfigError(f"{self.table} is no keyed table; create it first")
        return found

    def rows(self, spark: SparkSession) -> DataFrame:
        """The live rows."""
        return spark.table(self.table)

    def state(self, spark: SparkSession) -> DataFrame:
        """All rows with their order, tombstones included."""
        return self._version(spark).rows(spark)

    def _placed(self, changes: DataFrame) -> DataFrame:
        return changes.withColumn(FOLDER, F.pmod(F.xxhash64(*[name(k) for k in self.keys]), F.lit(self.folders)).cast("int"))

    def load(self, rows: DataFrame, step: str) -> None:
        """Rows of unknown order, such as a first copy of another table: any change is newer than they are."""
        spark = rows.sparkSession
        schema = self.state(spark).schema
        unordered = rows.withColumn(cdc.ORDER, F.lit(None).cast(schema[cdc.ORDER].dataType))
        self._merge(self._placed(unordered.withColumn(cdc.GONE, F.lit(False))), step, datetime.now(timezone.utc).replace(tzinfo=None), False)

    def merge(self, changes: DataFrame, step: str, at: datetime | None = None, few: bool = False) -> None:
        """Apply changes; an ``op`` of delete makes a tombstone.

        A repeat of the step that readers see does nothing, and a repeat of an
        unfinished one writes the same folders again. Changes without a key or
        an order cannot be placed and are left out; see :func:`cdc.unplaced`.
        """
        newest = cdc.newest_changes(changes, self.keys, self.order)
        self._merge(self._placed(newest), step, at or datetime.now(timezone.utc).replace(tzinfo=None), few)

    def _merge(self, newest: DataFrame, step: str, at: datetime, few: bool) -> None:
        spark = newest.sparkSession
        version = self._version(spark)
        if version.step == step:
            return
        newest = stage(newest, "changes")
        # At most as many rows as there are folders.
        touched = [row[0] for row in newest.select(FOLDER).distinct().collect()]
        rows = version.rows(spark)
        old = rows.where(F.col(FOLDER).isin(touched))
        merged = cdc.merge_state(old, newest, [*self.keys, FOLDER], instant(at), few)
        if self.retention:
            ended = F.col(cdc.GONE) & (F.col(cdc.GONE_AT) < instant(at) - F.expr(f"INTERVAL {self.retention}"))
            merged = merged.where(~ended)
        out = f"{self.path}/{step}"
        write_partitioned(merged.select(*[name(c) for c in rows.columns]), out, [FOLDER], mode="overwrite")
        kept = {folder: place for folder, place in version.places(spark).items() if int(folder) not in set(touched)}
        places = kept | versions.folders_in(spark, out, rows.schema, FOLDER)
        visible = [c for c in rows.columns if c not in self.hidden]
        versions.publish(spark, self.table, self.path, rows.schema, FOLDER, places, step, visible, f"NOT {cdc.GONE}")
