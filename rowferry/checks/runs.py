"""Queries on whole jobs, streams, counters and status."""

from __future__ import annotations

from datetime import datetime

from pyarrow.fs import FileSelector, FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.checks import fixtures as fx
from rowferry.checks.contracts import validated_lines
from rowferry.checks.intake import CHANGES_SQL, RAW_LINE_SQL, landed_lines
from rowferry.checks.registry import check
from rowferry.config import Job, job_from_dict
from rowferry.operators import cdc, deadletter, monitoring
from rowferry.plans.assemble import mark, outcome
from rowferry.session import sql_settings, staging_path
from rowferry.sources import plugin
from rowferry.sources.files import stream_files
from rowferry.sources.lines import clean_lines
from rowferry.streaming.current import STORE, STORE_SETTING, newest_on_stream
from rowferry.streaming.limits import writer_trigger
from rowferry.streaming.run import finish, open_source, run_metrics, run_pipeline

AT = datetime(2024, 2, 1)


def events_job(source: str = "", sink: str = "", letters: str = "") -> Job:
    """Raw lines to masked, typed rows; errors dropped, refused lines kept apart."""
    return job_from_dict({
        "pipeline_id": "p1",
        "source": {"type": "lines", "properties": {"path": source, "topics": "events"}},
        "sink": {"type": "parquet", "properties": {"path": sink}},
        "field_mappings": [
            {"source_field": "event_id", "sink_field": "event_id"},
            {"source_field": "user_id", "sink_field": "account_id", "cast": "string"},
            {"source_field": "event_type", "sink_field": "event_type"},
            {"source_field": "value", "sink_field": "amount", "cast": "float"},
        ],
        "transforms": [
            {"type": "drop_if", "params": {"condition": "event_type = 'error'"}},
            {"type": "pii_mask", "params": {"columns": ["account_id"], "method": "sha256"}},
        ],
        "schema": {"ddl": fx.RECORD.toDDL(), "drift_policy": "Dlq"},
        "flags": {"enable_schema_validation": True},
        "dlq": {"storage_uri": letters},
    })


JOB_SQL = """
SELECT event_id, sha256(CAST(user_id AS VARCHAR)) AS account_id, event_type,
  CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS amount,
  'p1' AS _pipeline_id, 'events' AS _source_topic, TIMESTAMP '2024-02-01' AS _pipeline_ingest_timestamp
FROM events WHERE event_id % 50 > 3 AND event_type <> 'error'"""


def _plain_time(df: DataFrame) -> DataFrame:
    at = "_pipeline_ingest_timestamp"
    return df.withColumn(at, F.col(at).cast("timestamp_ntz"))


@check("events_end_to_end", JOB_SQL)
def events_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """The declared job on a table of lines, as one plan."""
    raw = clean_lines(fx.raw_lines(spark, sf).select("raw_json"))
    good, _ = outcome(mark(raw, events_job(), AT, fx.RECORD), events_job(), AT)
    return _plain_time(good)


def _streamed(spark: SparkSession, sf: str, runs: int = 1) -> tuple[str, str, str]:
    sink, letters, state = (staging_path(spark, label) for label in ("sink", "letters", "state"))
    job = events_job(landed_lines(spark, sf), sink, letters)
    for _ in range(runs):
        finish(spark, run_pipeline(spark, job, state, at=AT), job, state)
    return sink, letters, state


@check("stream_end_to_end", JOB_SQL)
def stream_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """The same job on a stream of files."""
    sink, _, _ = _streamed(spark, sf)
    return _plain_time(spark.read.parquet(sink).drop("run_id", "batch_id"))


@check("stream_restart", JOB_SQL)
def stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """Started again from its checkpoint, the job adds nothing twice."""
    sink, _, _ = _streamed(spark, sf, runs=2)
    return _plain_time(spark.read.parquet(sink).drop("run_id", "batch_id"))


@check("stream_dead_letters", f"""
SELECT {RAW_LINE_SQL} AS original_data,
  CASE WHEN event_id % 50 = 0 THEN 'source_parsing_error' ELSE 'schema_validation' END AS error_category
FROM events WHERE event_id % 50 IN (0, 1, 2)""")
def stream_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    _, letters, _ = _streamed(spark, sf)
    return deadletter.read_dlq(spark, f"{letters}/dlq").select("original_data", "error_category")


@check("metrics_archive", """
SELECT 'p1' AS pipeline_id, count(*) FILTER (WHERE event_id % 50 <> 3) AS records_consumed,
  count(*) FILTER (WHERE event_id % 50 > 3) AS records_validated,
  count(*) FILTER (WHERE event_id % 50 < 3) AS records_dlq,
  count(*) FILTER (WHERE event_id % 50 > 3 AND event_type <> 'error') AS records_sunk, true AS has_bytes
FROM events""")
def metrics_archive(spark: SparkSession, sf: str) -> DataFrame:
    """Counters that the streamed job archived, summed over its micro-batches."""
    _, _, state = _streamed(spark, sf)
    counted = [F.sum(c).alias(c) for c in ("records_consumed", "records_validated", "records_dlq", "records_sunk")]
    return run_metrics(spark, state).groupBy("pipeline_id").agg(*counted, (F.sum("bytes_written") > 0).alias("has_bytes"))


@check("rate_limited_batches", "SELECT event_id, user_id, event_type, 3 AS batches FROM events")
def rate_limited_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A job limited to one file per micro-batch takes as many batches as files; all rows arrive."""
    landing, sink, state = (staging_path(spark, label) for label in ("landing", "sink", "state"))
    events = fx.table(spark, sf, "events").select("event_id", "user_id", "event_type")
    events.repartition(3).write.parquet(landing)
    job = _bare_job({"type": "parquet", "properties": {"path": landing, "schema": events.schema.toDDL(), "max_files_per_trigger": 1}}, sink)
    query = open_source(spark, job).writeStream.format("parquet").option("checkpointLocation", state)
    done = query.trigger(**writer_trigger(job, once=True)).start(sink)
    done.awaitTermination()
    batches = sum(1 for progress in done.recentProgress if progress.numInputRows)
    return spark.read.schema(events.schema).parquet(sink).withColumn("batches", F.lit(batches))


@check("stream_current_state", f"""
WITH d AS ({CHANGES_SQL}),
r AS (SELECT *, lsn % 3 = 0 AS first, row_number() OVER (PARTITION BY id, lsn % 3 = 0 ORDER BY lsn DESC) AS rn FROM d),
s AS (SELECT c_custkey AS id, CAST(499 AS BIGINT) AS known FROM customer),
a AS (SELECT r.id, r.lsn, r.op FROM r LEFT JOIN s ON r.id = s.id WHERE rn = 1 AND first AND r.lsn > coalesce(known, -1)),
b AS (SELECT r.id, r.lsn, r.op FROM r LEFT JOIN s ON r.id = s.id LEFT JOIN a ON r.id = a.id
  WHERE rn = 1 AND NOT first AND r.lsn > greatest(coalesce(known, -1), coalesce(a.lsn, -1)))
SELECT id, lsn, op FROM a UNION ALL SELECT id, lsn, op FROM b""")
def stream_current_state(spark: SparkSession, sf: str) -> DataFrame:
    """Every third change, then a restart and all others, older and newer ones, after a snapshot of another table."""
    landing, sink, state = (staging_path(spark, label) for label in ("landing", "sink", "state"))
    changes = fx.changes(spark, sf).select("id", "lsn", "op")
    snapshot = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.lit(499).alias("lsn"))
    with sql_settings(spark, {STORE_SETTING: STORE}):
        for arrived in ("lsn % 3 = 0", "lsn % 3 <> 0"):
            changes.where(arrived).write.mode("append").parquet(landing)
            newest = newest_on_stream(spark.readStream.schema(changes.schema).parquet(landing), ["id"], ["lsn"], snapshot)
            query = newest.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(sink)
            query.awaitTermination()
    return spark.read.schema(changes.schema).parquet(sink)


@check("stream_dedup", "SELECT event_id, user_id, event_type FROM events")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The same files delivered twice to a stream count once within the watermark delay."""
    landing, sink, state = (staging_path(spark, label) for label in ("landing", "sink", "state"))
    events = fx.table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("at")
    )
    for _ in range(2):
        events.write.mode("append").parquet(landing)
    arriving = stream_files(spark, landing, "parquet", events.schema)
    query = (
        cdc.dedup(arriving, ["event_id"], "at", "60 days")
        .writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(sink)
    )
    query.awaitTermination()
    return spark.read.schema(events.schema).parquet(sink).drop("at")


@check("run_counters", """
SELECT count(*) FILTER (WHERE event_id % 50 <> 3) AS records_consumed,
  count(*) FILTER (WHERE event_id % 50 > 3) AS records_validated,
  count(*) FILTER (WHERE event_id % 50 > 3) AS records_transformed,
  count(*) FILTER (WHERE event_id % 50 < 3) AS records_dlq,
  count(*) FILTER (WHERE event_id % 50 > 3 AND event_type <> 'error') AS records_sunk
FROM events""")
def run_counters(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.run_counters(validated_lines(spark, sf), kept=F.col("event_type") != "error")


@check("lag_seconds", """
SELECT event_type, CAST((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts))) // 1000000 AS BIGINT) AS lag_seconds
FROM events GROUP BY 1""")
def lag_seconds(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.lag(fx.table(spark, sf, "events"), "ts", AT, ["event_type"])


@check("alert_rows", """
WITH m AS (SELECT 'u' || (user_id % 10) AS pipeline_id, count(*) AS consumed,
    count(*) FILTER (WHERE event_id % 50 < 3) AS dlq,
    (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts))) // 1000000 AS lag
  FROM events WHERE event_id % 50 <> 3 GROUP BY 1)
SELECT pipeline_id, 'critical' AS severity, 'lag' AS title FROM m WHERE lag > 300
UNION ALL SELECT pipeline_id, 'warning', 'dlq_rate' FROM m WHERE dlq / consumed > 0.05""")
def alert_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Counters and lag per job from the same rows, then the two default rules."""
    marked = validated_lines(spark, sf, "'u' || (user_id % 10) AS pipeline_id", "ts")
    lag = {"lag_seconds": monitoring.lag_seconds("ts", AT)}
    measured = monitoring.run_counters(marked, by=["pipeline_id"], more=lag)
    return monitoring.alerts(measured).select("pipeline_id", "severity", "title")


_STATUS_SQL = """
WITH h AS (SELECT 'p' || user_id AS pipeline_id, event_id AS seq,
    CASE event_type WHEN 'signup' THEN 'starting' WHEN 'view' THEN 'running' WHEN 'click' THEN 'paused'
      WHEN 'purchase' THEN 'stopped' ELSE 'failed: sink refused' END AS status,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events),
r AS (SELECT pipeline_id, status FROM h WHERE rn = 1)"""


@check("status_list", f"""
{_STATUS_SQL} SELECT pipeline_id, status FROM r WHERE split_part(status, ':', 1) = 'failed' ORDER BY pipeline_id LIMIT 3 OFFSET 1""")
def status_list(spark: SparkSession, sf: str) -> DataFrame:
    runs = monitoring.current_runs(fx.run_history(spark, sf)).select("pipeline_id", "status")
    return monitoring.list_runs(runs, "failed", limit=3, offset=1)


@check("status_counts", f"{_STATUS_SQL} SELECT split_part(status, ':', 1) AS status, count(*) AS n FROM r GROUP BY 1")
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.status_counts(monitoring.current_runs(fx.run_history(spark, sf)))


@check("usage_metering", """
SELECT event_type AS pipeline_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS records,
  CAST(sum(octet_length(encode(props))) AS BIGINT) AS bytes FROM events GROUP BY 1, 2""")
def usage_metering(spark: SparkSession, sf: str) -> DataFrame:
    metered = monitoring.usage(fx.table(spark, sf, "events"), "event_type", "ts", F.octet_length("props"))
    return metered.withColumn("day", F.col("day").cast("string"))


class LineFeed(plugin.StreamedSource):
    """A user-written source that goes on: JSON lines in files that are numbered by name."""

    @classmethod
    def name(cls) -> str:
        return "rowferry_line_feed"

    def schema(self) -> str:
        return "event_id BIGINT, event_type STRING"

    def _files(self) -> list[str]:
        system, root = FileSystem.from_uri(self.options["path"])
        return sorted(f.path for f in system.get_file_info(FileSelector(root, recursive=True)) if f.base_name.startswith("part-") and f.size)

    def start(self) -> dict:
        return {"files": 0}

    def latest(self) -> dict:
        return {"files": len(self._files())}

    def parts_between(self, start: dict, end: dict) -> list[str]:
        return self._files()[start["files"]:end["files"]]

    def poll(self, part: str):
        import pyarrow.json as reader

        system, _ = FileSystem.from_uri(self.options["path"])
        with system.open_input_file(part) as lines:
            yield from reader.read_json(lines).select(["event_id", "event_type"]).to_batches()


def _bare_job(source: dict, sink: str) -> Job:
    return job_from_dict({
        "pipeline_id": "p1", "source": source, "sink": {"type": "parquet", "properties": {"path": sink}}, "flags": {"enable_lineage": False},
    })


def _run_twice(spark: SparkSession, job: Job, arrive, state: str) -> None:
    """The job after each of two deliveries, and once more after nothing new."""
    for number in range(3):
        if number < 2:
            arrive(number)
        finish(spark, run_pipeline(spark, job, state, at=AT), job, state)


@check("src_custom_stream", "SELECT event_id, event_type FROM events")
def src_custom_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A user-written streaming source in a job that is started three times."""
    landing, sink, state = (staging_path(spark, label) for label in ("feed", "sink", "state"))
    events = fx.table(spark, sf, "events").select("event_id", "event_type")
    job = _bare_job({"type": "custom", "properties": {"format": plugin.register_source(spark, LineFeed), "options": {"path": landing}}}, sink)
    _run_twice(spark, job, lambda n: events.where(F.col("event_id") % 2 == n).repartition(2).write.json(f"{landing}/{n}"), state)
    return spark.read.schema(events.schema).parquet(f"{sink}/run_id=*/batch_id=*")


@check("job_pull_since", "SELECT event_id, user_id, event_type FROM events")
def job_pull_since(spark: SparkSession, sf: str) -> DataFrame:
    """A table pulled by its key in pages, while it grows; no row comes twice."""
    landing, sink, state = (staging_path(spark, label) for label in ("pulled", "sink", "state"))
    events = fx.table(spark, sf, "events").select("event_id", "user_id", "event_type")
    size, half = events.count(), events.approxQuantile("event_id", [0.5], 0.01)[0]
    job = _bare_job({"type": "pull", "properties": {
        "path": landing, "schema": "event_id BIGINT, user_id BIGINT, event_type STRING", "cursor_column": "event_id", "page_rows": size // 3 + 1,
    }}, sink)
    parts = ["event_id <= {}", "event_id > {}"]
    _run_twice(spark, job, lambda n: events.where(parts[n].format(half)).write.mode("append").parquet(landing), state)
    return spark.read.schema(events.schema).parquet(f"{sink}/run_id=*/batch_id=*")
