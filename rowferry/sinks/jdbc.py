"""Relational sinks: batched append, and upsert through a staging table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.records import name
from rowferry.operators.cdc import latest

# Column types of a relational target.
RELATIONAL_TYPES = {
    "string": "TEXT",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE PRECISION",
    "float": "REAL",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "binary": "BYTEA",
}


def quoted(identifier: str) -> str:
    return '"' + identifier.replace('"', '""') + '"'


def relational_type(kind: T.DataType) -> str:
    """The target type; nested values travel as JSON text."""
    if isinstance(kind, T.DecimalType):
        return f"NUMERIC({kind.precision},{kind.scale})"
    return RELATIONAL_TYPES.get(kind.simpleString(), "TEXT")


def create_table_sql(schema: T.StructType, table: str, keys: list[str] | None = None) -> str:
    columns = [f"{quoted(f.name)} {relational_type(f.dataType)}" for f in schema.fields]
    if keys:
        columns.append(f"PRIMARY KEY ({', '.join(quoted(k) for k in keys)})")
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)})"


def upsert_sql(columns: list[str], table: str, staging: str, keys: list[str]) -> str:
    """Move the staged rows in one statement; when every column is a key, conflicts do nothing."""
    listed = ", ".join(quoted(c) for c in columns)
    rest = [c for c in columns if c not in keys]
    action = "NOTHING"
    if rest:
        action = "UPDATE SET " + ", ".join(f"{quoted(c)} = EXCLUDED.{quoted(c)}" for c in rest)
    target = ", ".join(quoted(k) for k in keys)
    return f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {staging} ON CONFLICT ({target}) DO {action}"


def relational_shape(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text; all others keep their type."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.withColumns({
        f.name: F.to_json(name(f.name)) for f in df.schema.fields if isinstance(f.dataType, nested)
    })


def write_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 1000, connections: int = 10,
               properties: dict[str, str] | None = None) -> None:
    """Batched append; at most ``connections`` tasks write at a time."""
    types = ", ".join(f"`{f.name}` {_declared(f.dataType)}" for f in df.schema.fields if _declared(f.dataType))
    writer = (
        relational_shape(df).write.format("jdbc").mode("append")
        .options(url=url, dbtable=table, batchsize=batch_size, numPartitions=connections, **(properties or {}))
    )
    if types:
        writer = writer.option("createTableColumnTypes", types)
    writer.save()


def _declared(kind: T.DataType) -> str:
    return kind.simpleString() if isinstance(kind, T.DecimalType) else ""


def statement_runner(spark: SparkSession, url: str, properties: dict[str, str] | None = None) -> Callable[[str], None]:
    """Send single statements from the driver through the JDBC driver Spark already has."""
    def run(sql: str) -> None:
        jvm = spark.sparkContext._jvm
        settings = jvm.java.util.Properties()
        for key, value in (properties or {}).items():
            settings.setProperty(key, value)
        connection = jvm.java.sql.DriverManager.getConnection(url, settings)
        try:
            connection.createStatement().execute(sql)
        finally:
            connection.close()

    return run


def upsert_jdbc(df: DataFrame, url: str, table: str, keys: list[str], order: list[str],
                run_statement: Callable[[str], None], staging: str | None = None, batch_size: int = 1000,
                connections: int = 10, create: bool = False, properties: dict[str, str] | None = None) -> None:
    """Last row per key wins: reduce in Spark, append to a staging table, merge in the database.

    ``run_statement`` sends one SQL text over the caller's own connection; it
    is used for the table definitions and for the final merge.
    """
    newest = latest(df, keys, order).drop("_arrival")
    staging = staging or f"{table}_staging"
    if create:
        run_statement(create_table_sql(newest.schema, table, keys))
    run_statement(create_table_sql(newest.schema, staging))
    run_statement(f"DELETE FROM {staging}")
    write_jdbc(newest, url, staging, batch_size, connections, properties)
    run_statement(upsert_sql(newest.columns, table, staging, keys))
