"""Incremental pulls, paging, and landed API pages."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.formats.parse import evaluate_once
from rowferry.functions.casts import constant
from rowferry.functions.records import name
from rowferry.operators.contract import nullable, read_records
from rowferry.operators.mapping import ERRORS
from rowferry.operators.numbering import number_rows
from rowferry.session import one_row

CURSOR_SCHEMA = T.StructType([
    T.StructField("pipeline_id", T.StringType(), False),
    T.StructField("offset", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("records_since_last", T.LongType(), False),
])

# Pages that end beyond this row are found by numbering, not by one top-k task.
TOP_K_ROWS = 100_000


def pull_since(df: DataFrame, column: str, cursor: Any) -> DataFrame:
    """Rows newer than the cursor; the comparison reaches the scan."""
    if cursor is None:
        return df
    return df.where(name(column) > constant(cursor, df.schema[column].dataType))


def next_cursor(df: DataFrame, column: str, cursor: Any) -> DataFrame:
    """One row with the highest value seen, or the old cursor when there is none."""
    old = constant(cursor, df.schema[column].dataType)
    return df.agg(F.coalesce(F.max(name(column)), old).alias("cursor"))


def pull_after(df: DataFrame, key: str, last: Any, n: int) -> DataFrame:
    """The first ``n`` rows beyond ``last`` in key order."""
    return pull_since(df, key, last).orderBy(name(key)).limit(n)


def pull_page(df: DataFrame, order: list[str], page: int, per_page: int) -> DataFrame:
    """Page ``page`` (from 0) of the table in a total order.

    Near pages are a top-k. Far pages would make one task hold every row before
    them, so those are found by distributed row numbers.
    """
    start = page * per_page
    if start + per_page <= TOP_K_ROWS:
        return df.orderBy(*[name(c) for c in order]).offset(start).limit(per_page)
    numbered = number_rows(df, order, "_at")
    return numbered.where((F.col("_at") >= start) & (F.col("_at") < start + per_page)).drop("_at")


def page_items(df: DataFrame, column: str, item: T.StructType, path: str = "") -> DataFrame:
    """Landed page bodies to one row per item, with ``_errors`` and the item's text in ``_raw``.

    ``path`` names the array inside the body, such as ``data.items``; without
    it the body is the array. A body without that array is one row with the
    fault ``corrupt`` and itself in ``_raw``; an item that is no object, or has
    a value that does not fit, is a row with its own faults. Rows keep the
    other columns of the page and the item's position ``pos``.
    """
    kept = [c for c in df.columns if c != column]
    body = name(column)
    if path:
        body = F.get_json_object(body, "$" + "".join(f"['{part}']" for part in path.split(".")))
    found = evaluate_once(df, "_items", F.when(F.startswith(F.ltrim(body), F.lit("[")), F.from_json(body, "array<string>")))
    whole = F.array(F.struct(F.lit(None).cast("int").alias("pos"), name(column).alias("_raw"), F.lit(True).alias("_refused")))
    each = F.transform("_items", lambda text, pos: F.struct(pos.alias("pos"), text.alias("_raw"), F.lit(False).alias("_refused")))
    rows = found.select(*[name(c) for c in kept], F.explode(F.coalesce(each, whole)).alias("_at"))
    rows = rows.select(*[name(c) for c in kept if c not in ("pos", "_raw")], "_at.*")
    read = read_records(rows, "_raw", nullable(item), unknown=False)
    corrupt = F.array(F.lit("corrupt"))
    shown = [c for c in kept if c not in [*item.names, "pos", "_raw"]]
    return read.withColumn(ERRORS, F.when(F.col("_refused"), corrupt).otherwise(F.col(ERRORS))).select(
        *[name(c) for c in shown], "pos", *[name(c) for c in item.names], ERRORS, "_raw",
    )


def explode_pages(df: DataFrame, column: str, item: T.StructType, path: str = "") -> tuple[DataFrame, DataFrame]:
    """The items of landed pages, and what is refused: bodies without the array, and items with faults.

    Refused rows have the columns of ``df``, with the text of the body or the
    item. Together items and refused rows are all that the pages hold.
    """
    marked = page_items(df, column, item, path)
    good, bad = marked.where(F.size(ERRORS) == 0), marked.where(F.size(ERRORS) > 0)
    return good.drop(ERRORS, "_raw"), bad.select(*[name("_raw").alias(c) if c == column else name(c) for c in df.columns])


def save_cursor(spark: SparkSession, path: str, pipeline_id: str, offset: str, at: datetime, records: int) -> None:
    """Append a position; call it after the sink has confirmed."""
    one_row(spark, CURSOR_SCHEMA, pipeline_id, offset, at, records).write.mode("append").parquet(path)


def load_cursor(spark: SparkSession, path: str, pipeline_id: str) -> str | None:
    """The last saved position of a job, or None, as on its first run."""
    try:
        saved = spark.read.schema(CURSOR_SCHEMA).parquet(path).where(F.col("pipeline_id") == pipeline_id)
        return saved.agg(F.max_by("offset", "timestamp")).first()[0]
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
