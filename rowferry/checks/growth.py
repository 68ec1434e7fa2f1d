"""Queries on schemas that grow, gathered loads and metered streams."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.checks import fixtures as fx
from rowferry.checks.registry import check
from rowferry.config import Job, job_from_dict
from rowferry.session import staging_path
from rowferry.sources.tables import read_table
from rowferry.streaming.run import finish, gathered_stage, publish_drift, run_identity, run_pipeline
from rowferry.streaming.schemas import SchemaRegistry, read_versions
from rowferry.streaming.usage import UsageWindows, meter

AT = datetime(2024, 2, 1)


def _lines_job(landing: str, sink: dict, schema: dict, letters: str = "") -> Job:
    return job_from_dict({
        "pipeline_id": "p1", "source": {"type": "lines", "properties": {"path": landing}}, "sink": sink, "schema": schema,
        "flags": {"enable_lineage": False, "enable_schema_validation": True}, "dlq": {"storage_uri": letters},
    })


def _deliver(spark: SparkSession, job: Job, state: str, landing: str, *deliveries: DataFrame) -> None:
    """The job after each delivery of lines, and once more after nothing new."""
    for number, lines in enumerate([*deliveries, None]):
        if lines is not None:
            lines.write.text(f"{landing}/{number}")
        finish(spark, run_pipeline(spark, job, state, at=AT), job, state)


@check("infer_then_later_batch", """
SELECT event_id, CAST(CASE WHEN event_id % 2 = 0 THEN user_id ELSE CAST(value AS DECIMAL(18,2)) END AS DOUBLE) AS v FROM events""")
def infer_then_later_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Whole numbers are inferred first; the fractions of a later delivery widen them."""
    landing, sink, state, letters = (staging_path(spark, label) for label in ("lines", "sink", "state", "letters"))
    events = fx.table(spark, sf, "events")
    line = "'{{\"event_id\": ' || event_id || ', \"v\": ' || {} || '}}' AS value"
    first = events.where("event_id % 2 = 0").selectExpr(line.format("user_id"))
    later = events.where("event_id % 2 = 1").selectExpr(line.format("CAST(CAST(value AS DECIMAL(18,2)) AS STRING)"))
    job = _lines_job(f"{landing}/*", {"type": "parquet", "properties": {"path": sink}}, {"auto_infer": True}, letters)
    _deliver(spark, job, state, landing, first, later)
    return read_versions(spark, SchemaRegistry(f"{state}/schema"), sink).select("event_id", "v")


@check("drift_history", """
SELECT CASE event_id % 10 WHEN 0 THEN 'ref' ELSE 'props' END AS field,
  CASE event_id % 10 WHEN 0 THEN 'added' WHEN 1 THEN 'missing' ELSE 'type' END AS change, count(*) AS n, 'p1' AS pipeline_id
FROM events WHERE event_id % 10 IN (0, 1, 2) GROUP BY 1, 2""")
def drift_history(spark: SparkSession, sf: str) -> DataFrame:
    """The drift of two deliveries, as the catalogue has it."""
    landing, sink, state, letters, place = (staging_path(spark, label) for label in ("lines", "sink", "state", "letters", "history"))
    drifting = fx.drifting(spark, sf)
    schema = {"ddl": fx.DRIFT_CONTRACT.toDDL(), "drift_policy": "Dlq"}
    job = _lines_job(f"{landing}/*", {"type": "parquet", "properties": {"path": sink}}, schema, letters)
    _deliver(spark, job, state, landing, *[drifting.where(f"event_id % 20 DIV 10 = {n}").select("raw_json") for n in (0, 1)])
    table = "rowferry_drift_history"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    publish_drift(spark, job, state, table, place)
    return read_table(spark, table).groupBy("field", "change", "pipeline_id").agg(F.sum("n").alias("n"))


@check("stage_gathered", "SELECT event_id, user_id, event_type FROM events")
def stage_gathered(spark: SparkSession, sf: str) -> DataFrame:
    """A job's micro-batches gathered into sealed groups, as a loader reads them."""
    landing, sink, state = (staging_path(spark, label) for label in ("rows", "sink", "state"))
    events = fx.table(spark, sf, "events").select("event_id", "user_id", "event_type")
    events.repartition(6).write.parquet(landing)
    job = job_from_dict({
        "pipeline_id": "p1", "flags": {"enable_lineage": False},
        "source": {"type": "parquet", "properties": {"path": landing, "schema": events.schema.simpleString()[7:-1].replace(":", " "), "max_files_per_trigger": 2}},
        "sink": {"type": "staged", "properties": {"path": sink}},
    })
    for _ in range(2):
        finish(spark, run_pipeline(spark, job, state, at=AT), job, state)
    return gathered_stage(job.sink, run_identity(spark, state)).rows(spark, events.schema)


@check("stream_usage", """
WITH m AS (SELECT max(ts) - INTERVAL 2 DAY AS w FROM events WHERE event_id % 2 = 0),
e AS (SELECT event_type, date_trunc('day', ts) AS d, octet_length(encode(props)) AS b,
  event_id % 2 = 1 AND date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT w FROM m) AS late FROM events)
SELECT event_type AS pipeline_id, strftime(d, '%Y-%m-%d') AS day, count(*) FILTER (WHERE NOT late) AS records,
  CAST(coalesce(sum(b) FILTER (WHERE NOT late), 0) AS BIGINT) AS bytes, count(*) FILTER (WHERE late) AS late_records,
  CAST(coalesce(sum(b) FILTER (WHERE late), 0) AS BIGINT) AS late_bytes
FROM e GROUP BY 1, 2""")
def stream_usage(spark: SparkSession, sf: str) -> DataFrame:
    """Usage by day on a stream that is started again; most rows of the second delivery come after the watermark."""
    landing, root, state = (staging_path(spark, label) for label in ("rows", "usage", "state"))
    events = fx.table(spark, sf, "events").select("event_id", "event_type", "ts", "props")
    windows = UsageWindows(root, timedelta(days=1), timedelta(days=2))
    for number in range(2):
        events.where(F.col("event_id") % 2 == number).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(events.schema).parquet(landing)
        metered = meter(stream, windows, "event_type", "ts", F.octet_length("props"))
        metered.option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    day = F.date_format("start", "yyyy-MM-dd").alias("day")
    return windows.windows(spark).select("pipeline_id", day, "records", "bytes", "late_records", "late_bytes")
