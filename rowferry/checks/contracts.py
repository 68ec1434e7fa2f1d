"""Queries on schema contracts, drift and dead letters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.checks import fixtures as fx
from rowferry.checks.intake import RAW_LINE_SQL
from rowferry.checks.registry import check
from rowferry.formats.parse import as_text, parse_json
from rowferry.functions.records import name
from rowferry.operators import contract, deadletter
from rowferry.operators.mapping import ERRORS
from rowferry.schemas import LONG, TEXT, fields
from rowferry.session import staging_path
from rowferry.sinks import tables
from rowferry.sources.lines import clean_lines
from rowferry.sources.tables import read_table

AT = datetime(2024, 2, 1)

_CATEGORY_SQL = "CASE WHEN event_id % 50 = 0 THEN 'source_parsing_error' ELSE 'schema_validation' END"
_MESSAGE_SQL = "CASE event_id % 50 WHEN 0 THEN 'corrupt' WHEN 1 THEN 'missing:event_type' ELSE 'type:value' END"


def validated_lines(spark: SparkSession, sf: str, *beside: str) -> DataFrame:
    """The raw lines as typed records with their faults."""
    return contract.read_records(clean_lines(fx.raw_lines(spark, sf, *beside)), "raw_json", fx.RECORD)


def letters(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = deadletter.split(validated_lines(spark, sf))
    return deadletter.to_dlq(bad, "p1", AT, original=name("raw_json"))


def stored_letters(spark: SparkSession, sf: str) -> DataFrame:
    root = staging_path(spark, "dlq")
    deadletter.write_dlq(letters(spark, sf), root)
    return deadletter.read_dlq(spark, root)


@check("schema_validate", f"""
SELECT event_id AS line_id, CASE WHEN event_id % 50 IN (0, 1, 2) THEN {_MESSAGE_SQL} ELSE '' END AS errors
FROM events WHERE event_id % 50 <> 3""")
def schema_validate(spark: SparkSession, sf: str) -> DataFrame:
    """Fields that are already apart, validated value by value."""
    lines = clean_lines(fx.raw_lines(spark, sf))
    marked = contract.validate(parse_json(lines, "raw_json", as_text(fx.RECORD)), fx.RECORD)
    return marked.select("line_id", F.array_join(F.array_sort(ERRORS), ";").alias("errors"))


@check("schema_infer", "SELECT DISTINCT unnest(json_keys(props)) AS field, 'BIGINT' AS type FROM events")
def schema_infer(spark: SparkSession, sf: str) -> DataFrame:
    return contract.infer_fields(fx.table(spark, sf, "events"), "props")


@check("schema_drift_rows", """
SELECT CASE WHEN event_id % 10 = 0 THEN 'ref' ELSE 'props' END AS field,
  CASE event_id % 10 WHEN 0 THEN 'added' WHEN 1 THEN 'dropped' ELSE 'type_changed' END AS change, count(*) AS n
FROM events WHERE event_id % 10 IN (0, 1, 2) GROUP BY 1, 2""")
def schema_drift_rows(spark: SparkSession, sf: str) -> DataFrame:
    return contract.drift(fx.drifting(spark, sf), "raw_json", fx.DRIFT_CONTRACT)


@check("drift_drop_field", """
SELECT event_id, CASE WHEN event_id % 10 IN (1, 2) THEN NULL ELSE '1' END AS props FROM events""")
def drift_drop_field(spark: SparkSession, sf: str) -> DataFrame:
    kept = contract.drop_unknown(fx.drifting(spark, sf), "raw_json", fx.DRIFT_CONTRACT)
    return kept.select("event_id", F.col("props").cast("string").alias("props"))


_FAULTS_SQL = """
SELECT event_id, event_id % 10 <> 2 AS good, CASE WHEN event_id % 10 = 2 THEN 'type:props' ELSE '' END AS errors FROM events"""


def _judged(marked: DataFrame) -> DataFrame:
    good, bad = deadletter.split(marked)
    parts = [good.select("event_id", F.lit(True).alias("good"), F.lit("").alias("errors"))]
    parts.append(bad.select("event_id", F.lit(False).alias("good"), F.array_join(ERRORS, ";").alias("errors")))
    return parts[0].unionAll(parts[1])


@check("drop_field_faults", _FAULTS_SQL)
def drop_field_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Good and refused rows together are the input; a value of another type is refused."""
    return _judged(contract.drop_unknown(fx.drifting(spark, sf), "raw_json", fx.DRIFT_CONTRACT))


@check("pack_unknown_faults", _FAULTS_SQL)
def pack_unknown_faults(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(contract.pack_unknown(fx.drifting(spark, sf), "raw_json", fx.DRIFT_CONTRACT))


@check("drift_dlq", """
SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'added:ref' WHEN 1 THEN 'dropped:props' ELSE 'type_changed:props' END AS errors,
  'schema_validation' AS category
FROM events WHERE event_id % 10 IN (0, 1, 2)""")
def drift_dlq(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = deadletter.split(contract.mark_drift(fx.drifting(spark, sf), "raw_json", fx.DRIFT_CONTRACT))
    return bad.select(
        "event_id", F.array_join(ERRORS, ";").alias("errors"), deadletter.error_category(F.col(ERRORS)).alias("category")
    )


@check("drift_clean", "SELECT event_id, CAST(1 AS BIGINT) AS props FROM events WHERE event_id % 10 > 2")
def drift_clean(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = deadletter.split(contract.mark_drift(fx.drifting(spark, sf), "raw_json", fx.DRIFT_CONTRACT))
    return good.select("event_id", "props")


@check("drift_alter", "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'x' END AS ref FROM events")
def drift_alter(spark: SparkSession, sf: str) -> DataFrame:
    """A table without the new field takes a batch that has it; old rows get null."""
    table = "rowferry_widened"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    rows = fx.drifting(spark, sf)
    wider = fields(event_id=LONG, props=TEXT, ref=TEXT)
    has_ref = F.col("event_id") % 10 == 0
    old = contract.drop_unknown(rows.where(~has_ref), "raw_json", T.StructType(wider.fields[:2])).drop(ERRORS)
    tables.create_target(old, table, staging_path(spark, "widened"))
    tables.append_widening(old, table)
    tables.append_widening(contract.drop_unknown(rows.where(has_ref), "raw_json", wider).drop(ERRORS), table)
    return read_table(spark, table).select("event_id", "ref")


@check("drift_widen_union", """
SELECT event_id, 'old' AS part, NULL AS ref FROM events UNION ALL
SELECT event_id, 'new' AS part, CASE WHEN event_id % 10 = 0 THEN 'x' END AS ref FROM events""")
def drift_widen_union(spark: SparkSession, sf: str) -> DataFrame:
    old = fx.table(spark, sf, "events").select("event_id", F.lit("old").alias("part"))
    wider = fields(event_id=LONG, ref=TEXT)
    new = contract.drop_unknown(fx.drifting(spark, sf), "raw_json", wider).drop(ERRORS).withColumn("part", F.lit("new"))
    return contract.widen(old, new)


@check("drift_pack_unknown", """
SELECT event_id, CASE WHEN event_id % 10 = 0 THEN '{"ref":"x"}' END AS payload FROM events""")
def drift_pack_unknown(spark: SparkSession, sf: str) -> DataFrame:
    return contract.pack_unknown(fx.drifting(spark, sf), "raw_json", fx.DRIFT_CONTRACT).select("event_id", "payload")


@check("target_columns", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def target_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A bucketed target made from a schema, then loaded."""
    table, orders = "rowferry_target", fx.table(spark, sf, "orders")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    tables.create_target(orders, table, staging_path(spark, "target"), keys=["o_orderkey"], buckets=8)
    orders.write.insertInto(table)
    return read_table(spark, table).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@check("catalog_columns", "SELECT c_custkey, c_name, 'personal' AS tag FROM customer")
def catalog_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Published rows beside the tag that the catalogue keeps for them."""
    table = "rowferry_published"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    tables.publish(fx.table(spark, sf, "customer"), table, staging_path(spark, "published"),
                   tags={"class": "personal"}, comment="customers")
    tag = tables.published_tags(spark, table)["class"]
    return read_table(spark, table).select("c_custkey", "c_name", F.lit(tag).alias("tag"))


@check("dlq_good", "SELECT event_id AS line_id FROM events WHERE event_id % 50 > 3")
def dlq_good(spark: SparkSession, sf: str) -> DataFrame:
    return deadletter.split(validated_lines(spark, sf))[0].select("line_id")


@check("dlq_bad", f"""
SELECT {RAW_LINE_SQL} AS raw_json, {_CATEGORY_SQL} AS category FROM events WHERE event_id % 50 IN (0, 1, 2)""")
def dlq_bad(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = deadletter.split(validated_lines(spark, sf))
    return bad.select("raw_json", deadletter.error_category(F.col(ERRORS)).alias("category"))


@check("dlq_envelope", f"""
SELECT 'p1' AS pipeline_id, {_CATEGORY_SQL} AS error_category, {_MESSAGE_SQL} AS error_message,
  {RAW_LINE_SQL} AS original_data, '0' AS retry_count
FROM events WHERE event_id % 50 IN (0, 1, 2)""")
def dlq_envelope(spark: SparkSession, sf: str) -> DataFrame:
    return letters(spark, sf).select(
        "pipeline_id", "error_category", "error_message", "original_data", F.col("metadata")["retry_count"].alias("retry_count")
    )


@check("dlq_partitions", f"""
SELECT 'p1' AS pipeline_id, {_CATEGORY_SQL} AS error_category, '2024-02-01' AS date, count(*) AS n
FROM events WHERE event_id % 50 IN (0, 1, 2) GROUP BY 1, 2, 3""")
def dlq_partitions(spark: SparkSession, sf: str) -> DataFrame:
    return stored_letters(spark, sf).groupBy("pipeline_id", "error_category", F.col("date").cast("string").alias("date")).agg(
        F.count("*").alias("n")
    )


@check("dlq_replay", """
SELECT event_id, CAST(0 AS DOUBLE) AS value FROM events WHERE event_id % 50 = 2 AND event_type <> 'click'""")
def dlq_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Mend the wrong numbers and run again; letters about clicks were replayed before."""
    stored, ledger = stored_letters(spark, sf), staging_path(spark, "replayed")
    deadletter.mark_replayed(stored.where(F.get_json_object("original_data", "$.event_type") == "click"), ledger)

    def mend(df: DataFrame) -> DataFrame:
        return df.withColumn("original_data", F.replace("original_data", F.lit('"abc"'), F.lit("0.00")))

    again = deadletter.replay(
        stored, spark.read.parquet(ledger), as_text(fx.RECORD), mend, [lambda d: contract.validate(d, fx.RECORD)]
    )
    good, _ = deadletter.split(again)
    return contract.conform(good, fx.RECORD).select("event_id", "value")


@check("dlq_stats", f"""
SELECT 'p1' AS pipeline_id, {_CATEGORY_SQL} AS error_category, count(*) AS pending, true AS has_bytes
FROM events WHERE event_id % 50 IN (0, 1, 2) GROUP BY 1, 2""")
def dlq_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = deadletter.dlq_stats(letters(spark, sf))
    return stats.select("pipeline_id", "error_category", "pending", (F.col("bytes") > F.col("pending")).alias("has_bytes"))


def _refusing_store(row: dict) -> None:
    if row["event_id"] % 100 == 7:
        raise ConnectionError("store refused the row")


@check("dlq_sink_error", """
SELECT event_id, 'sink_error' AS error_category, 'ConnectionError: store refused the row' AS error_message
FROM events WHERE event_id % 100 = 7""")
def dlq_sink_error(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "events").select("event_id", "event_type")
    failed = deadletter.write_or_dlq(rows, _refusing_store, "p1", AT, retries=1)
    return failed.select(
        F.get_json_object("original_data", "$.event_id").cast("bigint").alias("event_id"), "error_category", "error_message"
    )


def _refusing_bulk(rows: list[dict]) -> None:
    for row in rows:
        _refusing_store(row)


@check("dlq_sink_batches", """
SELECT event_id, 'sink_error' AS error_category, 'ConnectionError: store refused the row' AS error_message
FROM events WHERE event_id % 100 = 7""")
def dlq_sink_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A store that takes or refuses whole lists; the good rows of a refused list arrive."""
    rows = fx.table(spark, sf, "events").select("event_id", "event_type")
    failed = deadletter.write_batches_or_dlq(rows, _refusing_bulk, "p1", AT, retries=1)
    return failed.select(
        F.get_json_object("original_data", "$.event_id").cast("bigint").alias("event_id"), "error_category", "error_message"
    )
