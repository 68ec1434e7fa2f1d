"""Queries on mappings, filters, masking and other row transforms."""

from __future__ import annotations

import base64
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.checks import fixtures as fx
from rowferry.checks.registry import check
from rowferry.config import FieldMapping
from rowferry.formats.custom import apply_row_function
from rowferry.formats.parse import as_text, parse_json
from rowferry.functions.casts import epoch_to_iso
from rowferry.operators import filters, mapping, protect
from rowferry.operators.mapping import ERRORS
from rowferry.schemas import LONG, fields
from rowferry.sources.lines import clean_lines

AT = datetime(2024, 2, 1)

# A key for checks only; real jobs name theirs by reference.
TEST_KEY = base64.b64encode(bytes(range(32))).decode()


@check("map_fields", "SELECT user_id AS account_id, event_type AS kind FROM events")
def map_fields(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [FieldMapping("user_id", "account_id"), FieldMapping("event_type", "kind"), FieldMapping("missing", "x")]
    return mapping.field_mapper(fx.table(spark, sf, "events"), wanted)


@check("map_cast", """
SELECT CAST(o_orderkey AS VARCHAR) AS ORDER_ID, CAST(o_custkey AS VARCHAR) AS CUST_ID, o_totalprice AS AMOUNT_USD FROM orders""")
def map_cast(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [
        FieldMapping("o_orderkey", "ORDER_ID", "string"),
        FieldMapping("o_custkey", "CUST_ID", "string"),
        FieldMapping("o_totalprice", "AMOUNT_USD", "float"),
    ]
    return mapping.field_mapper(fx.table(spark, sf, "orders"), wanted).drop(ERRORS)


@check("map_cast_errors", "SELECT event_id AS line_id, 'cast:amount' AS error FROM events WHERE event_id % 50 = 2")
def map_cast_errors(spark: SparkSession, sf: str) -> DataFrame:
    lines = clean_lines(fx.raw_lines(spark, sf))
    parsed = parse_json(lines, "raw_json", as_text(fx.RECORD), keep=["line_id"])
    mapped = mapping.field_mapper(parsed, [FieldMapping("line_id", "line_id"), FieldMapping("value", "amount", "float")])
    return mapped.where(F.size(ERRORS) > 0).select("line_id", F.array_join(ERRORS, "; ").alias("error"))


@check("cast_epoch_iso", "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS iso FROM events")
def cast_epoch_iso(spark: SparkSession, sf: str) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return fx.table(spark, sf, "events").select("event_id", epoch_to_iso(seconds).alias("iso"))


@check("cast_epoch_ms_iso", "SELECT event_id, strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS iso FROM events")
def cast_epoch_ms_iso(spark: SparkSession, sf: str) -> DataFrame:
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return fx.table(spark, sf, "events").select("event_id", epoch_to_iso(millis, "ms").alias("iso"))


@check("filter_bool", "SELECT event_id FROM events WHERE event_id % 3 <> 0 AND event_type <> 'error'")
def filter_bool(spark: SparkSession, sf: str) -> DataFrame:
    return filters.row_filter(fx.masked_amounts(spark, sf), "is_valid_event").select("event_id")


@check("filter_drop_if", """
WITH d AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 2 = 0 THEN -value ELSE value END AS amount FROM events)
SELECT event_id FROM d WHERE NOT coalesce(amount < 0, false)""")
def filter_drop_if(spark: SparkSession, sf: str) -> DataFrame:
    return filters.drop_if(fx.masked_amounts(spark, sf), "amount < 0").select("event_id")


@check("mask_sha256", "SELECT c_custkey, sha256(c_name) AS c_name FROM customer")
def mask_sha256(spark: SparkSession, sf: str) -> DataFrame:
    return protect.mask_hash(fx.table(spark, sf, "customer").select("c_custkey", "c_name"), ["c_name"])


@check("mask_redact", "SELECT c_custkey, '***' AS c_name FROM customer")
def mask_redact(spark: SparkSession, sf: str) -> DataFrame:
    return protect.mask_redact(fx.table(spark, sf, "customer").select("c_custkey", "c_name"), ["c_name"])


@check("mask_partial", """
SELECT c_custkey, repeat('*', greatest(length(c_name) - 4, 0)) || right(c_name, 4) AS c_name FROM customer""")
def mask_partial(spark: SparkSession, sf: str) -> DataFrame:
    return protect.mask_partial(fx.table(spark, sf, "customer").select("c_custkey", "c_name"), ["c_name"])


@check("mask_documents", "SELECT doc_id, sha256(text) AS text FROM documents")
def mask_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts, of any length and language."""
    return protect.mask_hash(fx.table(spark, sf, "documents").select("doc_id", "text"), ["text"])


@check("enc_roundtrip", "SELECT c_custkey, c_name, true AS hidden, '' AS errors FROM customer")
def enc_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    customer = fx.table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_name").alias("plain"))
    sealed = protect.encrypt(customer, ["c_name"], TEST_KEY, "c_name").withColumn("sealed", F.col("c_name"))
    opened = protect.decrypt(sealed, ["c_name"], TEST_KEY, "c_name")
    hidden = ~F.contains(F.col("sealed"), F.col("plain"))
    return opened.select("c_custkey", "c_name", hidden.alias("hidden"), F.array_join(ERRORS, "; ").alias("errors"))


@check("lineage", """
SELECT o_orderkey, 'p1' AS _pipeline_id, 'orders' AS _source_topic, TIMESTAMP '2024-02-01' AS _pipeline_ingest_timestamp FROM orders""")
def lineage(spark: SparkSession, sf: str) -> DataFrame:
    traced = mapping.add_lineage(fx.table(spark, sf, "orders").select("o_orderkey"), "p1", "orders", AT)
    return traced.withColumn("_pipeline_ingest_timestamp", F.col("_pipeline_ingest_timestamp").cast("timestamp_ntz"))


@check("chain_map_filter_mask", """
SELECT event_id, sha256(event_type) AS event_type, true AS is_valid_event FROM events WHERE event_id % 3 <> 0 AND event_type <> 'error'""")
def chain_map_filter_mask(spark: SparkSession, sf: str) -> DataFrame:
    kept = [FieldMapping(c, c) for c in ("event_id", "event_type", "is_valid_event")]
    return mapping.chain(fx.masked_amounts(spark, sf), [
        lambda d: mapping.field_mapper(d, kept),
        lambda d: filters.row_filter(d, "is_valid_event"),
        lambda d: protect.mask_hash(d, ["event_type"]),
    ])


def _double_and_shout(row: dict) -> dict:
    return {"event_id": row["event_id"], "event_type": row["event_type"].upper(), "value": row["value"] * 2}


@check("udf_row", "SELECT event_id, upper(event_type) AS event_type, value * 2 AS value FROM events")
def udf_row(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "events").select("event_id", "event_type", "value")
    made = apply_row_function(rows, _double_and_shout, rows.schema)
    return made.where("_error IS NULL").select("event_id", "event_type", "value")


def _refuse_errors(row: dict) -> dict:
    if row["event_type"] == "error":
        raise ValueError("refused")
    return {"event_id": row["event_id"]}


@check("udf_row_failures", """
SELECT event_type <> 'error' AS done, count(*) AS n, CASE WHEN event_type = 'error' THEN 'ValueError: refused' END AS reason
FROM events GROUP BY 1, 3""")
def udf_row_failures(spark: SparkSession, sf: str) -> DataFrame:
    """A raise concerns its own row only."""
    rows = fx.table(spark, sf, "events").select("event_id", "event_type")
    made = apply_row_function(rows, _refuse_errors, fields(event_id=LONG))
    return made.groupBy(F.col("event_id").isNotNull().alias("done"), F.col("_error").alias("reason")).agg(F.count("*").alias("n"))


@check("idempotency_key", """
WITH twice AS (SELECT event_id, user_id, event_type FROM events UNION ALL
               SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'click')
SELECT sha256(event_id || chr(31) || user_id || chr(31) || event_type) AS key, count(*) AS n FROM twice GROUP BY 1""")
def idempotency_key(spark: SparkSession, sf: str) -> DataFrame:
    keyed = mapping.with_key(fx.delivered_twice(spark, sf), ["event_id", "user_id", "event_type"])
    return keyed.groupBy("key").agg(F.count("*").alias("n"))


@check("fill_defaults", """
SELECT event_id, coalesce(CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 2 = 0 THEN -value ELSE value END, 0.0) AS amount FROM events""")
def fill_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.fill_defaults(fx.masked_amounts(spark, sf), {"amount": 0.0}).select("event_id", "amount")


@check("to_utc", "SELECT event_id, ts - INTERVAL 2 HOUR AS ts_utc FROM events")
def to_utc(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.to_utc(fx.table(spark, sf, "events"), "ts", "+02:00", "ts_utc").select("event_id", "ts_utc")
