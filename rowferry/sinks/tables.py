"""Catalogue tables: provision, widen, publish."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rowferry.operators import cdc

TAG = "tag."


def quoted(identifier: str) -> str:
    return "`" + identifier.replace("`", "``") + "`"


def create_target(df: DataFrame, table: str, path: str, keys: list[str] | None = None, buckets: int = 0) -> None:
    """Create the table when it does not exist, with the columns of ``df`` and no rows.

    With ``keys`` and ``buckets`` the table is bucketed by its keys, so later
    merges do not shuffle it.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        return
    writer = df.limit(0).write.format("parquet").option("path", path)
    if keys and buckets:
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    writer.saveAsTable(table)


def alter_target(spark: SparkSession, table: str, batch: T.StructType) -> list[str]:
    """Add one column per field the table lacks; old rows get null there."""
    known = set(spark.table(table).columns)
    added = [f for f in batch.fields if f.name not in known]
    if added:
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return [f.name for f in added]


def append_widening(df: DataFrame, table: str) -> None:
    """Widen the table for ``df`` and append its rows."""
    spark = df.sparkSession
    alter_target(spark, table, df.schema)
    known = spark.table(table).schema
    missing = T.StructType([f for f in known.fields if f.name not in df.columns])
    filled = spark.createDataFrame([], missing)
    df.unionByName(filled, allowMissingColumns=True).select(*known.names).write.insertInto(table)


def location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    # The table's columns come first, so the last row of that name is the location.
    return [r.data_type for r in described if r.col_name == "Location"][-1]


def swap_location(spark: SparkSession, table: str, path: str) -> None:
    """Point the table at other files; readers see either the old or the new rows."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{_text(path)}'")
    spark.catalog.refreshTable(table)


def merge_into(changes: DataFrame, table: str, path: str, keys: list[str], order: list[str], step: str,
               few: bool = False) -> None:
    """Apply changes to a table: write the merged rows to ``path/step``, then swap.

    The table's own files are never overwritten while they are read. A repeat
    of a step that already took effect does nothing.
    """
    spark = changes.sparkSession
    fresh = f"{path}/{step}"
    if location(spark, table).rstrip("/").endswith(f"/{step}"):
        return
    apply = cdc.merge_few if few else cdc.merge
    apply(spark.table(table), changes, keys, order).write.mode("overwrite").parquet(fresh)
    swap_location(spark, table, fresh)


def publish(df: DataFrame, table: str, path: str, tags: dict[str, str] | None = None, comment: str = "") -> None:
    """Save as a catalogue table; governance tags become properties ``tag.<name>``."""
    spark = df.sparkSession
    df.write.format("parquet").mode("overwrite").option("path", path).saveAsTable(table)
    if tags:
        pairs = ", ".join(f"'{_text(TAG + k)}' = '{_text(v)}'" for k, v in tags.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")
    if comment:
        spark.sql(f"COMMENT ON TABLE {table} IS '{_text(comment)}'")


def published_tags(spark: SparkSession, table: str) -> dict[str, str]:
    properties = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r.key.removeprefix(TAG): r.value for r in properties if r.key.startswith(TAG)}


def _text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")
