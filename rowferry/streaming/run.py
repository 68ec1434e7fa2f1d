"""Run a declared job: source, contract, transforms, split, sink, dead letters, counters."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta, timezone
from functools import partial
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rowferry.config import Connector, Job
from rowferry.errors import ConfigError, ConnectorMissing, SchemaDriftError, TransformError
from rowferry.functions.casts import instant
from rowferry.functions.records import TIME_FORMATS, name
from rowferry.operators import contract
from rowferry.operators.cdc import latest
from rowferry.operators.deadletter import error_category, write_dlq
from rowferry.operators.mapping import ERRORS, add_errors
from rowferry.operators.monitoring import DEFAULT_RULES, alerts, archive
from rowferry.operators.payloads import to_broker
from rowferry.operators.routing import Rule, route
from rowferry.plans.assemble import declared_schema, mark, outcome
from rowferry.schemas import LONG, TEXT, fields
from rowferry.session import one_row
from rowferry.sinks import files as file_sinks
from rowferry.sinks import jdbc, tables, versions
from rowferry.sinks.appends import AppendTable
from rowferry.sinks.gathering import GatheredStage
from rowferry.sinks.keyed import KeyedTable
from rowferry.sources import broker, files, lines
from rowferry.streaming import ledger, limits, pull
from rowferry.streaming.schemas import VERSION, SchemaRegistry

HISTORY = fields(pipeline_id=TEXT, seq=LONG, status=TEXT)
RUN = fields(run_id=TEXT)
_BATCH_AT = "_rowferry_batch_at"


def open_source(spark: SparkSession, job: Job, stream: bool = True, once: bool = False) -> DataFrame:
    """The declared source as a stream or a table; unknown names are refused."""
    source, bounds = job.source, limits.reader_limits(job, once) if stream else {}
    kind = source.type
    if kind in ("lines", "stdin"):
        return lines.read_lines(spark, source.require("path"), stream, **bounds)
    if kind == "kafka":
        envelope = broker.read_kafka(spark, source, stream, **bounds)
        return envelope.withColumn("raw_json", F.col("value")) if job.schema else envelope
    if kind in ("parquet", "json", "csv", "orc", "xml"):
        options = {**source.get("options", {}), **bounds}
        reader = (spark.readStream if stream else spark.read).format(kind).options(**options)
        return reader.schema(source.require("schema")).load(source.require("path"))
    if kind == "table":
        return spark.readStream.table(source.require("table_name")) if stream else spark.read.table(
            source.require("table_name"))
    if kind == "pull":
        return _pulled(spark, source)
    if kind == "custom":
        reader = (spark.readStream if stream else spark.read).format(source.require("format"))
        return reader.options(**source.get("options", {})).load()
    raise ConfigError(f"unknown source {kind!r}")


def _pulled(spark: SparkSession, source: Connector) -> DataFrame:
    """A table to pull from: relational, in files, or of the catalogue."""
    if source.get("connection_string"):
        options = {"url": source.require("connection_string"), "dbtable": source.require("table_name"), **source.get("options", {})}
        return spark.read.format("jdbc").options(**options).load()
    if source.get("path"):
        reader = spark.read.format(source.get("format", "parquet")).options(**source.get("options", {}))
        return reader.schema(source.require("schema")).load(source.require("path"))
    return spark.read.table(source.require("table_name"))


Writer = Callable[[DataFrame, Connector, Job, int], "str | None"]


def _step(job: Job, batch_id: int) -> str:
    """A name that no other run's micro-batch has."""
    return f"run_id={job.run_id}/batch_id={batch_id}"


def _files(fmt: str, df: DataFrame, sink: Connector, job: Job, batch_id: int) -> str:
    """A folder per micro-batch of a run, replaced when the batch is repeated.

    Parquet keeps its types, so where they can grow each version of the schema
    has a folder (:func:`rowferry.streaming.schemas.read_versions`).
    """
    version = f"{VERSION}={job.schema_version}/" if job.schema_version and fmt == "parquet" else ""
    path = f"{sink.require('path')}/{version}{_step(job, batch_id)}"
    keys = sink.get("partition_by", [])
    options = {**(TIME_FORMATS if fmt in ("json", "csv") else {}), **sink.get("options", {})}
    if keys:
        file_sinks.write_partitioned(df, path, list(keys), fmt, mode="overwrite", **sink.get("options", {}))
    else:
        df.write.mode("overwrite").format(fmt).options(**options).save(path)
    return path


def _table(df: DataFrame, sink: Connector, job: Job, batch_id: int) -> None:
    """Append to a catalogue table: exactly once where this sink made it, else at least once."""
    spark, table = df.sparkSession, sink.require("table_name")
    widen = job.schema is not None and job.schema.drift_policy == "alter_table"
    if sink.get("create_table_if_not_exists", False) or sink.get("path"):
        appended = AppendTable(table, sink.require("path"))
        if not spark.catalog.tableExists(table):
            appended.create(spark, df.schema)
        if appended.exists(spark):
            appended.append(df, _step(job, batch_id), widen)
            return
    if widen:
        tables.append_widening(df, table)
    else:
        df.write.insertInto(table)


def _merge(df: DataFrame, sink: Connector, job: Job, batch_id: int) -> None:
    """Changes into a keyed table; neither a repeated batch nor a late change undoes a newer one.

    A table that exists and is no keyed table is merged as a whole, without
    memory of the order.
    """
    table, path, step = sink.require("table_name"), sink.require("path"), _step(job, batch_id)
    keys, order, few = _names(sink.require("upsert_keys")), _names(sink.require("order_by")), bool(sink.get("few_changes", False))
    spark = df.sparkSession
    if spark.catalog.tableExists(table) and versions.current(spark, table) is None:
        tables.merge_into(df, table, path, keys, order, step, few)
        return
    keyed = KeyedTable(table, path, keys, order, int(sink.get("folders", 64)), sink.get("tombstone_retention"))
    columns = df.drop("op") if sink.get("keep_order", False) else df.drop("op", *[c for c in order if c not in keys])
    keyed.create(spark, columns.schema, df.schema)
    keyed.merge(df, step, few=few)


def _routed(df: DataFrame, sink: Connector, job: Job, batch_id: int) -> str:
    """One folder per target table, by the rules of the sink."""
    path = f"{sink.require('path')}/{_step(job, batch_id)}"
    rules = [Rule(**r) for r in sink.require("rules")]
    file_sinks.write_routed(route(df, rules, sink.get("default")), path, sink.get("format", "parquet"), mode="overwrite")
    return path


def gathered_stage(sink: Connector, run_id: str) -> GatheredStage:
    """The groups that a run gathers for bulk loads; by default 50 MB or 60 seconds."""
    age = timedelta(seconds=float(sink.get("max_age_seconds", 60)))
    return GatheredStage(f"{sink.require('path')}/run_id={run_id}", float(sink.get("target_mb", 50)), age)


def _staged(df: DataFrame, sink: Connector, job: Job, batch_id: int) -> str:
    return gathered_stage(sink, job.run_id).add(df, batch_id, datetime.now(timezone.utc))


def _kafka(df: DataFrame, sink: Connector, job: Job, batch_id: int) -> None:
    topic, key = sink.require("topics"), sink.require("key_field")
    shaped = to_broker(df.withColumn("_topic", F.lit(topic)), key, "_topic", df.columns)
    try:
        shaped.write.format("kafka").option("kafka.bootstrap.servers", sink.require("bootstrap_servers")).save()
    except AnalysisException as missing:
        raise ConnectorMissing("Spark's Kafka package is not on the class path") from missing


def _jdbc(df: DataFrame, sink: Connector, job: Job, batch_id: int) -> None:
    """Append, or with ``upsert_mode`` the last row per key (by ``order_by``, else by arrival)."""
    table, url = sink.require("table_name"), sink.require("connection_string")
    if sink.get("schema_name"):
        table = f"{sink.get('schema_name')}.{table}"
    size, connections, options = int(sink.get("batch_size", 1000)), limits.sink_connections(job), sink.get("options", {})
    run_statement = jdbc.statement_runner(df.sparkSession, url, options)
    create = bool(sink.get("create_table_if_not_exists", False))
    if sink.get("upsert_mode", False):
        keys, order = _names(sink.require("upsert_keys")), _names(sink.get("order_by", ""))
        if not order:
            df, order = df.withColumn("_arrival", F.monotonically_increasing_id()), ["_arrival"]
        jdbc.upsert_jdbc(df, url, table, keys, order, run_statement, batch_size=size, connections=connections,
                         create=create, properties=options)
        return
    if create:
        run_statement(jdbc.create_table_sql(df.schema, table))
    jdbc.write_jdbc(df, url, table, size, connections, options)


def _names(listed: str | list[str]) -> list[str]:
    return [n.strip() for n in listed.split(",") if n.strip()] if isinstance(listed, str) else list(listed)


def _format(df: DataFrame, sink: Connector, job: Job, batch_id: int) -> None:
    """A user-written sink; it is told the batch, so that it can tell a repeat."""
    told = {"run_id": job.run_id, "batch_id": str(batch_id)}
    df.write.format(sink.require("format")).mode("append").options(**told, **sink.get("options", {})).save()


def _console(df: DataFrame, sink: Connector, job: Job, batch_id: int) -> None:
    df.write.format("console").mode("append").save()


def _discard(df: DataFrame, sink: Connector, job: Job, batch_id: int) -> None:
    file_sinks.discard(df)


# Sinks that take rows of any type, so that inferred types can grow under them.
_ANY_TYPES = ("ndjson", "csv", "parquet", "console", "stdout", "noop")

SINKS: dict[str, Writer] = {
    "ndjson": partial(_files, "json"),
    "parquet": partial(_files, "parquet"),
    "csv": partial(_files, "csv"),
    "table": _table,
    "merge": _merge,
    "routed": _routed,
    "staged": _staged,
    "kafka": _kafka,
    "jdbc": _jdbc,
    "postgres": _jdbc,
    "custom": _format,
    "stdout": _console,
    "console": _console,
    "noop": _discard,
}


def run_pipeline(
    spark: SparkSession,
    job: Job,
    state: str,
    once: bool = True,
    at: datetime | None = None,
    extra: dict[str, Callable[..., Any]] | None = None,
    sinks: dict[str, Writer] | None = None,
) -> StreamingQuery | None:
    """Start the job; ``state`` is its own folder for checkpoint, ledger, metrics and history.

    With ``once`` the query drains what the source holds and ends. Each
    micro-batch is read once, held, split, written, counted and then entered in
    the ledger; the checkpoint moves on after that. ``at`` fixes the batch time
    (tests); otherwise it is the time in the stream's own log, which a repeat
    of the batch has again, so dead letters of a repeat replace the first ones
    even after midnight. A source of type ``pull`` is drained before this
    returns, and gives no query.
    """
    if not job.enabled:
        return None
    writers = {**SINKS, **(sinks or {})}
    if job.sink.type not in writers:
        raise ConfigError(f"unknown sink {job.sink.type!r}")
    write = writers[job.sink.type]
    schema = declared_schema(spark, job)
    run_id = run_identity(spark, state)
    job = replace(job, run_id=run_id)
    record_state(spark, state, job.pipeline_id, "starting")
    if job.source.type == "pull":
        if not once:
            raise ConfigError("a pull ends when nothing is newer; run it again for more")
        _pull(spark, job, state, run_id, at, write, schema, extra)
        return None

    def batch(df: DataFrame, batch_id: int) -> None:
        started, df = at or _logged_time(df), df.drop(_BATCH_AT)
        ledger.once(
            df, f"{state}/ledger", run_id, batch_id, started,
            lambda rows: process_batch(rows, job, batch_id, started, write, state, schema, extra),
        )

    query = (
        open_source(spark, job, once=once).withColumn(_BATCH_AT, F.current_timestamp())
        .writeStream.queryName(job.pipeline_id)
        .option("checkpointLocation", f"{state}/checkpoint")
        .trigger(**limits.writer_trigger(job, once))
        .foreachBatch(batch)
        .start()
    )
    record_state(spark, state, job.pipeline_id, "running")
    return query


def _pull(
    spark: SparkSession, job: Job, state: str, run_id: str, at: datetime | None, write: Writer,
    schema: T.StructType | None, extra: dict[str, Callable[..., Any]] | None,
) -> None:
    """Drain a pulled table, range by range."""
    record_state(spark, state, job.pipeline_id, "running")
    try:
        pull.run_ranges(
            open_source(spark, job, stream=False), job, state, run_id,
            lambda rows, batch_id, started: process_batch(rows, job, batch_id, started, write, state, schema, extra), at,
        )
    except Exception as failure:
        record_state(spark, state, job.pipeline_id, f"failed: {str(failure).splitlines()[0]}")
        raise


def _logged_time(df: DataFrame) -> datetime:
    """When the stream planned this micro-batch; now for an empty one."""
    first = df.select(F.unix_micros(_BATCH_AT)).first()
    if first is None:
        return datetime.now(timezone.utc).replace(tzinfo=None)
    return datetime.fromtimestamp(first[0] / 1_000_000, timezone.utc).replace(tzinfo=None)


def run_identity(spark: SparkSession, state: str) -> str:
    """The id of the run that ``state`` belongs to: new with the folder, kept as long as it.

    Folders of results and steps of a merge carry it, so a run with a new
    state adds to what earlier ones wrote.
    """
    try:
        found = spark.read.schema(RUN).json(f"{state}/run").agg(F.min("run_id")).first()[0]
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        found = None
    if found is None:
        found = uuid.uuid4().hex
        one_row(spark, RUN, found).write.mode("append").json(f"{state}/run")
    return found


def finish(spark: SparkSession, query: StreamingQuery | None, job: Job, state: str) -> None:
    """Wait for the end of a run and enter it in the history; a pull has ended already.

    What a ``staged`` sink still gathers is sealed, since no later batch would.
    """
    try:
        if query is not None:
            query.awaitTermination()
        if job.enabled and job.sink.type == "staged":
            gathered_stage(job.sink, run_identity(spark, state)).flush(spark, datetime.now(timezone.utc))
    except Exception as failure:
        record_state(spark, state, job.pipeline_id, f"failed: {str(failure).splitlines()[0]}")
        raise
    record_state(spark, state, job.pipeline_id, "stopped")


def process_batch(
    df: DataFrame, job: Job, batch_id: int, at: datetime, write: Writer, state: str,
    schema: T.StructType | None, extra: dict[str, Callable[..., Any]] | None = None,
) -> None:
    """One micro-batch from rows read to counters archived."""
    spark = df.sparkSession
    schema, version = agreed_schema(df, job, schema, state, batch_id, at)
    job = replace(job, schema_version=version)
    entry, exit_ = Observation(f"in-{batch_id}"), Observation(f"out-{batch_id}")
    contract_fault = error_category(F.col(ERRORS)).isin("schema_validation", "source_parsing_error")

    def count_in(rows: DataFrame) -> DataFrame:
        return rows.observe(
            entry, F.count(F.lit(1)).alias("records_consumed"),
            F.count_if((F.size(ERRORS) == 0) | ~contract_fault).alias("records_validated"),
        )

    marked = mark(df, job, at, schema, extra, count_in)
    if job.sink.type == "merge":
        # A change without key or order cannot be placed, and would be added again by every repeat.
        needed = [*_names(job.sink.require("upsert_keys")), *_names(job.sink.require("order_by"))]
        marked = add_errors(marked, [F.when((F.size(ERRORS) == 0) & name(c).isNull(), F.lit(f"missing:{c}")) for c in needed if c in marked.columns])
    held = marked.persist()
    try:
        clean, event_time = F.size(ERRORS) == 0, job.source.get("event_time")
        newest = F.max(F.unix_micros(name(event_time).cast("timestamp"))) if event_time else F.max(F.lit(None).cast("bigint"))
        counted = held.observe(
            exit_, F.count_if(~clean).alias("records_dlq"), F.count_if(clean).alias("records_sunk"), newest.alias("newest")
        )
        # One pass fills the cache and both counts; the writes below read the cache.
        file_sinks.discard(counted.select(ERRORS, *([name(event_time)] if event_time else [])))
        seen = {**entry.get, **exit_.get}
        if not seen["records_consumed"]:
            return
        if seen["records_dlq"]:
            record_drift(held, job, state, batch_id, at)
            if not (job.flags.enable_dlq and job.dlq.storage_uri):
                raise TransformError(f"{seen['records_dlq']} records refused, and no dead-letter store is declared")
        good, bad = outcome(held, job, at)
        path = write(good, job.sink, job, batch_id)
        if seen["records_dlq"]:
            write_dlq(bad, f"{job.dlq.storage_uri}/{job.dlq.prefix}", job.dlq, batch_id, job.run_id)
    finally:
        held.unpersist()
    size = files.list_files(spark, path, "part-*").agg(F.sum("length")).first()[0] if path else 0
    row = (job.pipeline_id, batch_id, seen["records_consumed"], seen["records_validated"],
           seen["records_validated"] - (seen["records_dlq"] - (seen["records_consumed"] - seen["records_validated"])),
           seen["records_dlq"], seen["records_sunk"], int(size or 0), _lag(at, seen["newest"]))
    counters = one_row(spark, COUNTERS, *row)
    archive(counters, f"{state}/metrics", at)
    raised = alerts(counters, DEFAULT_RULES, at)
    if not raised.isEmpty():
        _write_state(raised, state, "alerts", job, batch_id)


ALERT = T.StructType([
    *fields(pipeline_id=TEXT, severity=TEXT, title=TEXT, description=TEXT).fields,
    T.StructField("timestamp", T.TimestampType()),
])

COUNTERS = fields(
    pipeline_id=TEXT, batch_id=LONG, records_consumed=LONG, records_validated=LONG,
    records_transformed=LONG, records_dlq=LONG, records_sunk=LONG, bytes_written=LONG, lag_seconds=LONG,
)


def _lag(at: datetime, newest_micros: int | None) -> int | None:
    """Seconds from the newest record of the batch to the batch time (both UTC)."""
    if newest_micros is None:
        return None
    return int(at.replace(tzinfo=timezone.utc).timestamp() - newest_micros / 1_000_000)


def _write_state(df: DataFrame, state: str, kind: str, job: Job, batch_id: int) -> None:
    """Rows about one micro-batch; a repeat replaces them."""
    df.write.mode("overwrite").parquet(f"{state}/{kind}/{_step(job, batch_id)}")


def record_drift(held: DataFrame, job: Job, state: str, batch_id: int, at: datetime) -> None:
    """Add the drift of this batch to the history; under the halt policy, alert and stop."""
    spark = held.sparkSession
    found = contract.drift_of_errors(held)
    dated = found.select(F.lit(job.pipeline_id).alias("pipeline_id"), instant(at).alias("at"), "*")
    _write_state(dated, state, "drift", job, batch_id)
    if job.schema is None or job.schema.drift_policy != "halt":
        return
    first = found.orderBy("change", "field").first()
    if first is not None:
        message = f"{first.change}:{first.field} in {first.n} records"
        _write_state(one_row(spark, ALERT, job.pipeline_id, "critical", "schema_drift", message, at), state, "alerts", job, batch_id)
        raise SchemaDriftError(message)


def agreed_schema(
    df: DataFrame, job: Job, declared: T.StructType | None, state: str, batch_id: int, at: datetime,
) -> tuple[T.StructType | None, int]:
    """The contract of a micro-batch, and its version where types may grow (else 0).

    An inferred contract grows in types as far as later values join with what
    is known (whole numbers beside fractions), where the sink takes that; a
    declared one keeps its types. Under ``alter_table`` either takes new
    fields. Versions are kept in the state folder.
    """
    inferring = declared is None and job.schema is not None and job.schema.auto_infer
    adding = job.schema is not None and job.schema.drift_policy == "alter_table" and "raw_json" in df.columns
    if not inferring and (declared is None or not adding):
        return declared, 0
    registry, growing = SchemaRegistry(f"{state}/schema"), inferring and job.sink.type in _ANY_TYPES
    spark = df.sparkSession
    found = registry.newest(spark)
    if found is None and inferring:
        known = contract.infer_schema(df, "raw_json")
    else:
        known = contract.grown(df, "raw_json", found[1] if found else declared, adding, growing)
    if found is None and declared is not None and known != declared:
        registry.add(spark, declared, batch_id, at)
    version = registry.add(spark, known, batch_id, at) if known.fields else 0
    return known, version if growing else 0


def drift_history(spark: SparkSession, state: str) -> DataFrame:
    """``pipeline_id, run_id, batch_id, at, field, change, n``: the drift of every batch; a repeat counts once."""
    kinds = T.StructType([
        T.StructField("pipeline_id", T.StringType()), T.StructField("at", T.TimestampType()),
        *fields(field=TEXT, change=TEXT, n=LONG, run_id=TEXT, batch_id=LONG).fields,
    ])
    try:
        found = spark.read.schema(kinds).parquet(f"{state}/drift")
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], kinds)
    return found.select("pipeline_id", "run_id", "batch_id", "at", "field", "change", "n")


def publish_drift(spark: SparkSession, job: Job, state: str, table: str, path: str) -> None:
    """The drift of a job's records and the versions of its contract, as one catalogue table.

    A record's drift has ``n`` and no version; a change between versions has
    its version and both types, and no ``n``.
    """
    recorded = drift_history(spark, state).drop("run_id")
    versions_ = SchemaRegistry(f"{state}/schema").history(spark).withColumnRenamed("first_batch", "batch_id")
    both = recorded.unionByName(versions_.withColumn("pipeline_id", F.lit(job.pipeline_id)), allowMissingColumns=True)
    tables.publish(both, table, path, tags={"pipeline": job.pipeline_id}, comment="schema drift and contract versions")


def record_state(spark: SparkSession, state: str, pipeline_id: str, status: str) -> None:
    """Append a state change to the run history."""
    seq = int(datetime.now(timezone.utc).timestamp() * 1_000_000)
    one_row(spark, HISTORY, pipeline_id, seq, status).write.mode("append").parquet(f"{state}/history")


def run_history(spark: SparkSession, state: str) -> DataFrame:
    return spark.read.schema(HISTORY).parquet(f"{state}/history")


def run_metrics(spark: SparkSession, state: str) -> DataFrame:
    """Archived counters; a batch that was repeated counts once."""
    return latest(spark.read.parquet(f"{state}/metrics"), ["pipeline_id", "batch_id"], ["at"])
