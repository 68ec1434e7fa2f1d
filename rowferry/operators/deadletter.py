"""Dead letters: rows that left the main path, with the reason."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.config import DeadLetters
from rowferry.errors import ConfigError
from rowferry.formats.custom import ERROR, apply_row_function, refused_rows
from rowferry.formats.parse import parse_json
from rowferry.functions.casts import instant
from rowferry.functions.records import TIME_FORMATS, name, record_json, record_key
from rowferry.operators.mapping import ERRORS, add_errors, chain
from rowferry.session import ADVISORY_SIZE, sql_settings, stage

# Error categories, and other spellings accepted for them.
CATEGORIES = (
    "schema_validation",
    "transformation_error",
    "sink_error",
    "source_parsing_error",
    "network_error",
    "auth_error",
    "rate_limit_error",
    "other",
)
CATEGORY_ALIASES = {
    "transform_error": "transformation_error",
    "sink_write_error": "sink_error",
    "deserialization_error": "source_parsing_error",
}

DEAD_LETTER = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("pipeline_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("error_category", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("original_data", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])

LAYOUT = ("pipeline_id", "error_category", "date")


def category(text: str) -> str:
    known = CATEGORY_ALIASES.get(text, text)
    if known not in CATEGORIES:
        raise ConfigError(f"unknown error category {text!r}")
    return known


def error_category(errors: Column) -> Column:
    """The category of an ``_errors`` list: unreadable, then contract, then cast faults."""
    def starts(*prefixes: str) -> Column:
        return F.exists(errors, lambda e: F.substring_index(e, ":", 1).isin(*prefixes))

    return (
        F.when(starts("corrupt"), "source_parsing_error")
        .when(starts("missing", "type", "added", "dropped", "type_changed"), "schema_validation")
        .when(starts("cast", "decrypt", "function"), "transformation_error")
        .otherwise("other")
    )


def failures_as_errors(df: DataFrame) -> DataFrame:
    """Rows on which a user function or parser raised, marked ``function:<reason>``; ``_input`` stays."""
    marked = add_errors(df, [F.when(F.col(ERROR).isNotNull(), F.concat(F.lit("function:"), F.col(ERROR)))])
    return marked.drop(ERROR)


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without and with errors; together they are the input.

    Both are filters on ``df``: persist it first when both will be written.
    """
    clean = F.size(ERRORS) == 0
    return df.where(clean).drop(ERRORS), df.where(~clean)


def to_dlq(
    bad: DataFrame,
    pipeline_id: str,
    at: datetime,
    original: Column,
    kind: Column | None = None,
    message: Column | None = None,
    metadata: dict[str, Column] | None = None,
    retry_count: int = 0,
) -> DataFrame:
    """The seven-field envelope. The id depends on the content, so a replay repeats it."""
    kind = error_category(F.col(ERRORS)) if kind is None else kind
    message = F.array_join(F.col(ERRORS), "; ") if message is None else message
    notes = {"retry_count": F.lit(str(retry_count)), **(metadata or {})}
    pairs = [part for label, value in notes.items() for part in (F.lit(label), value.cast("string"))]
    shaped = bad.select(
        F.lit(pipeline_id).alias("pipeline_id"),
        instant(at).alias("timestamp"),
        kind.alias("error_category"),
        message.alias("error_message"),
        original.alias("original_data"),
        F.create_map(*pairs).alias("metadata"),
    )
    identity = record_key(["pipeline_id", "error_category", "error_message", "original_data"])
    return shaped.select(identity.alias("id"), "*")


def write_dlq(letters: DataFrame, root: str, settings: DeadLetters = DeadLetters(), batch_id: int | None = None,
              run_id: str = "") -> None:
    """One folder per job, category and day, each row in its own.

    Rows are rebalanced by folder: small folders get one file, and a folder
    that holds most of the rows is cut into several tasks of about the largest
    file size. A micro-batch of a run has folders of its own, which a repeat replaces.
    """
    dated = letters.withColumn("date", F.to_date("timestamp"))
    layout = list(LAYOUT)
    if batch_id is not None:
        dated = dated.withColumns({"run_id": F.lit(run_id or "none"), "batch_id": F.lit(batch_id)})
        layout += ["run_id", "batch_id"]
    with sql_settings(letters.sparkSession, {ADVISORY_SIZE: settings.max_file_size_bytes}):
        writer = (
            dated.hint("rebalance", *layout).write.partitionBy(*layout).options(**TIME_FORMATS)
            .option("maxRecordsPerFile", settings.max_records_per_file)
            .option("compression", settings.compression)
        )
        if batch_id is None:
            writer.mode("append").json(root)
        else:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").json(root)


def read_dlq(spark: SparkSession, root: str) -> DataFrame:
    stored = T.StructType(DEAD_LETTER.fields + [T.StructField("date", T.DateType())])
    return spark.read.schema(stored).options(**TIME_FORMATS).json(root)


def replay(
    letters: DataFrame,
    ledger: DataFrame,
    schema: T.StructType,
    fix: Callable[[DataFrame], DataFrame] = lambda df: df,
    steps: Iterable[Any] = (),
) -> DataFrame:
    """Unwrap the letters not yet replayed, mend them, and run the steps again.

    Letters whose text still cannot be read come back with ``_corrupt`` set,
    ready for another split.
    """
    waiting = letters.join(ledger.select("id"), "id", "left_anti")
    mended = fix(waiting.select("id", "original_data"))
    return chain(parse_json(mended, "original_data", schema, keep=["id", "original_data"]), steps)


def mark_replayed(replayed: DataFrame, ledger_path: str) -> None:
    replayed.select("id").distinct().write.mode("append").parquet(ledger_path)


def record_size(columns: Iterable[str]) -> Column:
    """Bytes of the JSON text of a record."""
    return F.octet_length(record_json(columns)).cast("bigint")


def dlq_stats(letters: DataFrame, by: Iterable[str] = ("pipeline_id", "error_category")) -> DataFrame:
    """Waiting records, bytes and last write, per job and category."""
    size = record_size([f.name for f in DEAD_LETTER.fields])
    return letters.groupBy(*by).agg(
        F.count("*").alias("pending"),
        F.sum(size).alias("bytes"),
        F.max("timestamp").alias("last_write"),
    )


def write_or_dlq(
    df: DataFrame,
    write: Callable[[dict[str, Any]], None],
    pipeline_id: str,
    at: datetime,
    retries: int = 2,
) -> DataFrame:
    """Write row by row on the executors; rows that still fail come back as dead letters.

    The writes happen once, here: their outcome is staged, so reading the
    result again does not write again. A lost executor repeats its task, so
    ``write`` should use the record key.
    """
    nothing = T.StructType([])

    def attempt(row: dict[str, Any]) -> dict[str, Any]:
        for left in range(retries, -1, -1):
            try:
                write(row)
                return {}
            except Exception:
                if left == 0:
                    raise
        return {}

    outcome = apply_row_function(df, attempt, nothing).where(F.col(ERROR).isNotNull())
    return _sink_letters(outcome, pipeline_id, at, retries)


def write_batches_or_dlq(
    df: DataFrame,
    write: Callable[[list[dict[str, Any]]], None],
    pipeline_id: str,
    at: datetime,
    rows_a_call: int = 500,
    retries: int = 2,
) -> DataFrame:
    """The same with lists of rows: one that fails is halved until the bad rows stand alone (see :func:`refused_rows`)."""
    return _sink_letters(refused_rows(df, write, rows_a_call, retries), pipeline_id, at, retries)


def _sink_letters(outcome: DataFrame, pipeline_id: str, at: datetime, retries: int) -> DataFrame:
    return to_dlq(
        stage(outcome, "sink-failures"), pipeline_id, at,
        original=name("_input"), kind=F.lit(category("sink_error")), message=name(ERROR),
        retry_count=retries,
    )
