"""Versions of a job's contract, and the rows written under each."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rowferry.operators import widening
from rowferry.schemas import LONG, TEXT, fields
from rowferry.session import one_row

VERSION = "schema_version"

_VERSIONS = T.StructType([*fields(version=LONG, ddl=TEXT, first_batch=LONG).fields, T.StructField("at", T.TimestampType())])
_HISTORY = T.StructType([*_VERSIONS.fields[:1], *_VERSIONS.fields[2:], *fields(field=TEXT, change=TEXT, before=TEXT, after=TEXT).fields])


class SchemaRegistry:
    """Numbered versions in a folder, one entry each; a version is never changed.

    One query writes it. An entry names the first batch that its version holds
    for, so a batch that is repeated finds the version it had.
    """

    def __init__(self, path: str) -> None:
        self.path = path

    def versions(self, spark: SparkSession) -> DataFrame:
        """``version, ddl, first_batch, at``; no rows before the first version."""
        try:
            return spark.read.schema(_VERSIONS).option("recursiveFileLookup", "true").json(self.path)
        except AnalysisException as absent:
            if absent.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], _VERSIONS)

    def newest(self, spark: SparkSession) -> tuple[int, T.StructType] | None:
        row = self.versions(spark).orderBy("version", ascending=False).first()
        return (row.version, T.StructType.fromDDL(row.ddl)) if row and row.ddl else None

    def add(self, spark: SparkSession, schema: T.StructType, batch_id: int, at: datetime) -> int:
        """Enter the next version; the number of the newest one where nothing changed."""
        found = self.newest(spark)
        if found and found[1] == schema:
            return found[0]
        number = found[0] + 1 if found else 1
        row = one_row(spark, _VERSIONS, number, schema.toDDL(), batch_id, at)
        row.coalesce(1).write.mode("overwrite").json(f"{self.path}/{number}")
        return number

    def history(self, spark: SparkSession) -> DataFrame:
        """``version, first_batch, at, field, change, before, after``: what each version changed."""
        rows, last = [], T.StructType([])
        for entry in self.versions(spark).orderBy("version").collect():
            schema = T.StructType.fromDDL(entry.ddl) if entry.ddl else T.StructType([])
            rows += [(entry.version, entry.first_batch, entry.at, *change) for change in widening.changes(last, schema)]
            last = schema
        return spark.createDataFrame(rows, _HISTORY)


def read_versions(spark: SparkSession, registry: SchemaRegistry, root: str) -> DataFrame:
    """All rows of a Parquet sink whose schema grew, under the least schema that holds every version.

    Each version is read with its own types; a scan with the newest would
    refuse older files. Columns of the folders (``run_id, batch_id``) stay.
    """
    parts = []
    for row in registry.versions(spark).select("version").orderBy("version").collect():
        try:
            parts.append(spark.read.parquet(f"{root}/{VERSION}={row.version}"))
        except AnalysisException as absent:  # no row of that version was good
            if absent.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    if not parts:
        raise ValueError(f"no version has rows below {root}")
    return widening.union_versions(parts)
