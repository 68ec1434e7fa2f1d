"""Catalogue tables that take each batch once, whatever happens between writing and publishing.

A batch is written to a folder of its own, which becomes visible by one step of
the catalogue. A repeat of a visible batch does nothing; a repeat of one that
was not finished replaces its files, which no reader has seen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.errors import ConfigError
from rowferry.functions.records import name
from rowferry.sinks import tables
from rowferry.sinks.versions import quoted, text

BATCH = "_batch"
_BATCHES = "rowferry.batches"


@dataclass(frozen=True)
class AppendTable:
    """``table`` is a view; its batches are the partitions of ``<table>__batches``, with data below ``path``."""

    table: str
    path: str

    @property
    def batches(self) -> str:
        return f"{self.table}__batches"

    def exists(self, spark: SparkSession) -> bool:
        """Whether ``table`` is there and is of this kind."""
        try:
            found = spark.sql(f"SHOW TBLPROPERTIES {self.table}").where(F.col("key") == _BATCHES)
        except AnalysisException as absent:
            if absent.getCondition() not in ("TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND"):
                raise
            return False
        return not found.isEmpty()

    def create(self, spark: SparkSession, schema: T.StructType) -> None:
        """An empty table with the columns of ``schema``; one that exists stays."""
        if BATCH in schema.names:
            raise ConfigError(f"the column {BATCH!r} clashes with that of an append table")
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.batches} ({columns}, {quoted(BATCH)} STRING) USING parquet "
            f"PARTITIONED BY ({quoted(BATCH)}) LOCATION '{text(self.path)}/none'"
        )
        self._show(spark)

    def _show(self, spark: SparkSession) -> None:
        chosen = ", ".join(quoted(c) for c in self.schema(spark).names)
        spark.sql(f"CREATE OR REPLACE VIEW {self.table} TBLPROPERTIES ('{_BATCHES}' = '{text(self.batches)}') AS SELECT {chosen} FROM {self.batches}")

    def schema(self, spark: SparkSession) -> T.StructType:
        """The columns that readers see."""
        return T.StructType([f for f in spark.table(self.batches).schema.fields if f.name != BATCH])

    def has(self, spark: SparkSession, step: str) -> bool:
        """Whether the batch is visible; the catalogue looks for this one only."""
        return not spark.sql(f"SHOW PARTITIONS {self.batches} PARTITION ({quoted(BATCH)} = '{text(step)}')").isEmpty()

    def append(self, df: DataFrame, step: str, widen: bool = False) -> bool:
        """Add the rows as batch ``step``; False when it was there before.

        Columns go by name. One the table lacks is refused, or added with
        ``widen``; one that ``df`` lacks is null. A value of another type is
        cast, and one that does not fit fails the batch.
        """
        spark = df.sparkSession
        if self.has(spark, step):
            return False
        if widen and tables.alter_target(spark, self.batches, df.schema):
            self._show(spark)
        schema = self.schema(spark)
        lost = [c for c in df.columns if c not in schema.names]
        if lost:
            raise ConfigError(f"{self.table} has no columns {lost}")
        place = f"{self.path}/{step}"
        df.select(*[_filled(df, field) for field in schema.fields]).write.mode("overwrite").parquet(place)
        spark.sql(f"ALTER TABLE {self.batches} ADD IF NOT EXISTS PARTITION ({quoted(BATCH)} = '{text(step)}') LOCATION '{text(place)}'")
        return True


def _filled(df: DataFrame, field: T.StructField) -> Column:
    value = name(field.name) if field.name in df.columns else F.lit(None)
    return value.cast(field.dataType).alias(field.name)
