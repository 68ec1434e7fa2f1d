"""Catalogue tables whose readers see one whole version after another.

A version is a table of partition folders, each at a place of its own, so a new
version can share folders with the one before. Readers use a view; replacing
it is one step of the catalogue. The view names its version and the step that
made it, and an index beside the data lists each folder's place.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.schemas import TEXT, fields

VERSION, BEFORE, STEP, INDEX = (f"rowferry.{word}" for word in ("version", "before", "step", "index"))

_PLACES = fields(False, folder=TEXT, place=TEXT)
# Folders that one statement of the catalogue adds.
_FOLDERS_A_STATEMENT = 500


def quoted(identifier: str) -> str:
    return "`" + identifier.replace("`", "``") + "`"


def text(value: str) -> str:
    """The inside of an SQL string literal."""
    return value.replace("\\", "\\\\").replace("'", "\\'")


@dataclass(frozen=True)
class Version:
    """The version that readers of a view see."""

    table: str
    before: str
    step: str
    index: str

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)

    def places(self, spark: SparkSession) -> dict[str, str]:
        """Where each folder is; as many entries as the layout has folders."""
        return {row.folder: row.place for row in spark.read.schema(_PLACES).json(self.index).collect()} if self.index else {}


def current(spark: SparkSession, view: str) -> Version | None:
    """The version of ``view``, or None where there is no such view."""
    try:
        found = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}
    except AnalysisException as absent:
        if absent.getCondition() not in ("TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND"):
            raise
        return None
    return Version(found[VERSION], found[BEFORE], found[STEP], found[INDEX]) if VERSION in found else None


def publish(
    spark: SparkSession, view: str, root: str, schema: T.StructType, folder: str, places: dict[str, str], step: str,
    visible: list[str], condition: str = "true",
) -> Version:
    """Make ``places`` the folders that readers of ``view`` see.

    ``schema`` includes the column ``folder``, which comes last. The version
    before stays for readers that have begun; the one before that is forgotten
    by the catalogue. Data files are left where they are.
    """
    before = current(spark, view)
    mark = hashlib.sha256(f"{root}\0{step}".encode()).hexdigest()[:16]
    head, _, last = view.rpartition(".")
    table = f"{head}.{last}__{mark}" if head else f"{last}__{mark}"
    index = f"{root}/index/{mark}"
    if places:
        spark.createDataFrame(sorted(places.items()), _PLACES).coalesce(1).write.mode("overwrite").json(index)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({quoted(folder)}) LOCATION '{text(root)}/none'")
    listed = sorted(places.items())
    for at in range(0, len(listed), _FOLDERS_A_STATEMENT):
        added = " ".join(
            f"PARTITION ({quoted(folder)} = '{text(value)}') LOCATION '{text(place)}'" for value, place in listed[at:at + _FOLDERS_A_STATEMENT]
        )
        spark.sql(f"ALTER TABLE {table} ADD {added}")
    spark.catalog.refreshTable(table)  # a step that failed may have made it before
    made = Version(table, before.table if before and before.table != table else "", step, index if places else "")
    marks = ", ".join(f"'{key}' = '{text(value)}'" for key, value in ((VERSION, made.table), (BEFORE, made.before), (STEP, step), (INDEX, made.index)))
    chosen = ", ".join(quoted(name) for name in visible)
    spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ({marks}) AS SELECT {chosen} FROM {table} WHERE {condition}")
    if before and before.before and before.before not in (table, made.before):
        spark.sql(f"DROP TABLE IF EXISTS {before.before}")
    return made


def folders_in(spark: SparkSession, path: str, schema: T.StructType, folder: str) -> dict[str, str]:
    """The folders that a partitioned write left below ``path``; only their names are read."""
    found = spark.read.schema(schema).parquet(path).select(F.col(folder).cast("string").alias("value")).distinct().collect()
    return {row.value: f"{path}/{folder}={row.value}" for row in found}
