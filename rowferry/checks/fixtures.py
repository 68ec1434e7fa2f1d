"""Inputs derived from the test tables.

The tables are clean, so faults are made by rule from ``event_id``; each
function uses every row of its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.schemas import DOUBLE, LONG, TEXT, fields

RECORD = fields(False, event_id=LONG, user_id=LONG, event_type=TEXT, value=DOUBLE)

_MONEY = "CAST(CAST(value AS DECIMAL(18,2)) AS STRING)"

_RAW_LINE = f"""
CASE event_id % 50
  WHEN 0 THEN '{{"event_id": ' || event_id || ', "user'
  WHEN 1 THEN '{{"event_id": ' || event_id || ', "user_id": ' || user_id || ', "value": ' || {_MONEY} || '}}'
  WHEN 2 THEN '{{"event_id": ' || event_id || ', "user_id": ' || user_id || ', "event_type": "' || event_type || '", "value": "abc"}}'
  WHEN 3 THEN '   '
  ELSE '{{"event_id": ' || event_id || ', "user_id": ' || user_id || ', "event_type": "' || event_type || '", "value": ' || {_MONEY} || '}}'
END
"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def raw_lines(spark: SparkSession, sf: str, *beside: str) -> DataFrame:
    """``line_id, raw_json``: 1 in 50 cut short, 1 lacks a field, 1 has a wrong type, 1 is blank."""
    return table(spark, sf, "events").selectExpr("event_id AS line_id", f"{_RAW_LINE} AS raw_json", *beside)


def broker_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Records shaped as Spark's broker reader gives them; some keys and values are null.

    ``event_id`` serves as the offset: offsets only need to grow within a
    broker partition.
    """
    return table(spark, sf, "events").selectExpr(
        "event_type AS topic",
        "CAST(user_id % 4 AS INT) AS partition",
        "event_id AS offset",
        "CAST(ts AS TIMESTAMP) AS timestamp",
        "CASE WHEN event_id % 20 = 0 THEN NULL ELSE CAST(CAST(user_id AS STRING) AS BINARY) END AS key",
        "CASE WHEN event_id % 25 = 0 THEN NULL ELSE CAST(props AS BINARY) END AS value",
        """CASE WHEN event_id % 30 = 0 THEN NULL ELSE array(
             named_struct('key', 'type', 'value', CAST('none' AS BINARY)),
             named_struct('key', 'type', 'value', CAST(event_type AS BINARY))) END AS headers""",
    )


def changes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "event_id AS lsn",
        "user_id AS id",
        "CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op",
        "CASE WHEN event_type = 'error' THEN NULL ELSE CAST(value AS DECIMAL(18,2)) END AS amount",
    )


def change_target(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr("c_custkey AS id", "CAST(c_acctbal AS DECIMAL(18,2)) AS amount")


def change_events(spark: SparkSession, sf: str) -> DataFrame:
    """The change feed as JSON text, deletes with a before image only."""
    image = "named_struct('id', id, 'amount', amount)"
    return changes(spark, sf).selectExpr(
        f"""to_json(named_struct('op', op, 'key', id,
              'before', CASE WHEN op = 'd' THEN {image} END,
              'after', CASE WHEN op <> 'd' THEN {image} END, 'lsn', lsn)) AS body"""
    )


def api_pages(spark: SparkSession, sf: str) -> DataFrame:
    """``page, body``: 100 items per page, and in one page of ten an error object instead."""
    events = table(spark, sf, "events").selectExpr("event_id div 100 AS page", "event_id", "event_type")
    items = F.to_json(F.sort_array(F.collect_list(F.struct("event_id", "event_type"))))
    pages = events.groupBy("page").agg(items.alias("items"))
    refused = F.when(F.col("page") % 10 == 7, F.lit('{"error": "rate limit"}'))
    return pages.select("page", F.coalesce(refused, "items").alias("body"))


def drifting(spark: SparkSession, sf: str) -> DataFrame:
    """``event_id, raw_json``: of ten, one has a new field, one lacks a field, one has another type."""
    return table(spark, sf, "events").selectExpr(
        "event_id",
        """CASE event_id % 10
             WHEN 0 THEN '{"event_id": ' || event_id || ', "props": 1, "ref": "x"}'
             WHEN 1 THEN '{"event_id": ' || event_id || '}'
             WHEN 2 THEN '{"event_id": ' || event_id || ', "props": "many"}'
             ELSE '{"event_id": ' || event_id || ', "props": 1}' END AS raw_json""",
    )


DRIFT_CONTRACT = fields(False, event_id=LONG, props=LONG)


def masked_amounts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "event_id",
        "event_type",
        "CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type <> 'error' END AS is_valid_event",
        "CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 2 = 0 THEN -value ELSE value END AS amount",
    )


def run_history(spark: SparkSession, sf: str) -> DataFrame:
    """``pipeline_id, seq, status``: one job per user, one state change per event."""
    return table(spark, sf, "events").selectExpr(
        "'p' || user_id AS pipeline_id",
        "event_id AS seq",
        """CASE event_type WHEN 'signup' THEN 'starting' WHEN 'view' THEN 'running' WHEN 'click' THEN 'paused'
             WHEN 'purchase' THEN 'stopped' ELSE 'failed: sink refused' END AS status""",
    )


def delivered_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Every row once, and the rows of a repeated delivery (all but clicks) again."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return events.unionAll(events.where("event_type <> 'click'"))
