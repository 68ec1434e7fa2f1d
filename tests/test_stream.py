import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rowferry.config import job_from_dict
from rowferry.errors import ConfigError
from rowferry.operators import deadletter, monitoring
from rowferry.schemas import LONG, fields
from rowferry.sinks import tables, versions
from rowferry.sinks.appends import AppendTable
from rowferry.sinks.keyed import KeyedTable
from rowferry.streaming import ledger, limits, run
from rowferry.streaming.run import finish, open_source, run_history, run_metrics, run_pipeline

AT = datetime(2024, 2, 1)


class Place:
    """Folders of one job, and lines dropped into its source."""

    def __init__(self, root):
        self.root, self.count = root, 0
        for part in ("in", "out", "state", "dlq"):
            (root / part).mkdir()

    def path(self, part):
        return str(self.root / part)

    def drop(self, *records):
        self.count += 1
        text = "\n".join(r if isinstance(r, str) else json.dumps(r) for r in records)
        target = self.root / "in" / f"{self.count:03}.txt"
        target.write_text(text + "\n")
        os.utime(target, (self.count * 100, self.count * 100))

    def job(self, **more):
        raw = {
            "pipeline_id": "t",
            "source": {"type": "lines", "properties": {"path": self.path("in"), "max_files_per_trigger": 1}},
            "sink": {"type": "ndjson", "properties": {"path": self.path("out")}},
            "schema": {"ddl": "id BIGINT NOT NULL, v STRING"},
            "flags": {"enable_lineage": False, "enable_schema_validation": True},
            "dlq": {"storage_uri": self.path("dlq")},
        }
        return job_from_dict({**raw, **more})

    def run(self, spark, job, **more):
        query = run_pipeline(spark, job, self.path("state"), at=AT, **more)
        finish(spark, query, job, self.path("state"))
        return query

    def out(self, spark, ddl="id BIGINT, v STRING"):
        return sorted((tuple(r) for r in spark.read.schema(ddl).json(self.path("out") + "/run_id=*/batch_id=*").collect()), key=repr)


@pytest.fixture
def place(tmp_path):
    return Place(tmp_path)


def test_resume_adds_only_what_is_new(spark, place):
    place.drop({"id": 1, "v": "a"}, "  ", "{broken")
    place.run(spark, place.job())
    place.drop({"id": 2, "v": "b"})
    place.run(spark, place.job())
    assert place.out(spark) == [(1, "a"), (2, "b")]
    assert [r.original_data for r in deadletter.read_dlq(spark, place.path("dlq") + "/dlq").collect()] == ["{broken"]
    counters = run_metrics(spark, place.path("state")).orderBy("batch_id").collect()
    assert [(r.records_consumed, r.records_validated, r.records_dlq, r.records_sunk) for r in counters] == [(2, 1, 1, 1), (1, 1, 0, 1)]
    assert all(r.bytes_written > 0 for r in counters)
    history = run_history(spark, place.path("state")).orderBy("seq").collect()
    assert [r.status for r in history] == ["starting", "running", "stopped"] * 2
    assert monitoring.current_runs(run_history(spark, place.path("state"))).first().status == "stopped"


def test_one_batch_per_file(spark, place):
    for i in range(3):
        place.drop({"id": i, "v": "x"})
    place.run(spark, place.job())
    assert run_metrics(spark, place.path("state")).count() == 3


def test_a_failed_batch_is_repeated_and_replaces_its_rows(spark, place):
    place.drop({"id": 1, "v": "a"}, {"id": 2, "v": "b"})
    calls = []

    def flaky(df, sink, job, batch_id):
        df.write.mode("overwrite").json(f"{sink.require('path')}/run_id={job.run_id}/batch_id={batch_id}")
        calls.append(batch_id)
        if len(calls) == 1:
            raise OSError("store went away")

    job = place.job(sink={"type": "flaky", "properties": {"path": place.path("out")}})
    with pytest.raises(StreamingQueryException):
        place.run(spark, job, sinks={"flaky": flaky})
    place.run(spark, job, sinks={"flaky": flaky})
    assert calls == [0, 0] and place.out(spark) == [(1, "a"), (2, "b")]
    states = [r.status for r in run_history(spark, place.path("state")).orderBy("seq").collect()]
    assert states[2].startswith("failed: ") and states[-1] == "stopped"


def test_a_finished_batch_is_not_written_again(spark, rows, tmp_path):
    written, path = [], str(tmp_path / "ledger")
    df = rows("a INT", (1,))
    assert not ledger.is_finished(spark, path, "r", 0)
    for batch in (0, 0, 1):
        ledger.once(df, path, "r", batch, AT, lambda d: written.append(d.count()))
    assert written == [1, 1] and ledger.is_finished(spark, path, "r", 1) and not ledger.is_finished(spark, path, "other", 1)


def test_drift_to_the_dead_letters(spark, place):
    place.drop({"id": 1, "v": "a"}, {"id": 2, "v": "b", "extra": 1})
    place.run(spark, place.job())
    assert place.out(spark) == [(1, "a")]


def test_drift_dropped(spark, place):
    place.drop({"id": 1, "v": "a"}, {"id": 2, "v": "b", "extra": 1})
    place.run(spark, place.job(schema={"ddl": "id BIGINT NOT NULL, v STRING", "drift_policy": "DropField"}))
    assert place.out(spark) == [(1, "a"), (2, "b")]


def test_drift_halts_before_the_write(spark, place):
    place.drop({"id": 1, "v": "a", "extra": 1})
    with pytest.raises(StreamingQueryException, match="added:extra"):
        place.run(spark, place.job(schema={"ddl": "id BIGINT NOT NULL, v STRING", "drift_policy": "Halt"}))
    assert not os.listdir(place.path("out"))
    raised = spark.read.parquet(place.path("state") + "/alerts").first()
    assert (raised.severity, raised.title, raised.description) == ("critical", "schema_drift", "added:extra in 1 records")


def test_lenient_contract_still_loses_no_value(spark, place):
    place.drop({"v": "a"}, {"id": "x", "v": "b"}, {"id": 3, "v": "c"})
    place.run(spark, place.job(flags={"enable_lineage": False}))
    assert place.out(spark) == [(3, "c"), (None, "a")]
    kept = deadletter.read_dlq(spark, place.path("dlq") + "/dlq").collect()
    assert [(r.error_message, r.original_data) for r in kept] == [("type:id", '{"id": "x", "v": "b"}')]
    drift = spark.read.parquet(place.path("state") + "/drift").collect()
    assert [(r.field, r.change, r.n) for r in drift] == [("id", "type", 1)]


def test_drift_widens_the_table(spark, place):
    spark.sql("DROP TABLE IF EXISTS stream_widen")
    job = place.job(
        sink={"type": "table", "properties": {"table": "stream_widen", "path": place.path("out"), "create_table_if_not_exists": True}},
        schema={"ddl": "id BIGINT NOT NULL, v STRING", "drift_policy": "AlterTable"},
    )
    place.drop({"id": 1, "v": "a"})
    place.drop({"id": 2, "v": "b", "extra": 7})
    place.drop({"id": 3, "v": "c"})
    place.run(spark, job)
    assert sorted(tuple(r) for r in spark.table("stream_widen").select("id", "v", "extra").collect()) == [(1, "a", None), (2, "b", 7), (3, "c", None)]


def crash_once(monkeypatch, module, label, before=False):
    """Let a function of the run fail on its first call, after its work or before it."""
    real, calls = getattr(module, label), []

    def flaky(*args, **more):
        calls.append(1)
        if len(calls) == 1 and before:
            raise OSError("lost")
        result = real(*args, **more)
        if len(calls) == 1:
            raise OSError("lost")
        return result

    monkeypatch.setattr(module, label, flaky)


@pytest.mark.parametrize("where", ["published", "written"])
def test_an_append_table_takes_a_batch_once(spark, place, monkeypatch, where):
    """The first attempt ends after the table shows its rows, or before it does."""
    table = f"stream_once_{where}"
    job = place.job(sink={"type": "table", "properties": {"table": table, "path": place.path("out"), "create_table_if_not_exists": True}})
    place.drop({"id": 1, "v": "a"}, {"id": 2, "v": "b"})
    if where == "published":
        crash_once(monkeypatch, run, "archive")
    else:
        crash_once(monkeypatch, AppendTable, "has", before=True)
    with pytest.raises(StreamingQueryException):
        place.run(spark, job)
    place.run(spark, job)
    place.drop({"id": 3, "v": "c"})
    place.run(spark, job)
    assert sorted(tuple(r) for r in spark.table(table).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_a_plain_table_is_appended_to(spark, place):
    spark.createDataFrame([(1, "a")], "id BIGINT, v STRING").write.option("path", place.path("plain")).saveAsTable("stream_plain_append")
    place.drop({"id": 2, "v": "b"})
    place.run(spark, place.job(sink={"type": "table", "properties": {"table": "stream_plain_append", "path": place.path("out")}}))
    assert sorted(tuple(r) for r in spark.table("stream_plain_append").collect()) == [(1, "a"), (2, "b")]


def test_append_tables_refuse_lost_columns_and_cast(spark, rows, tmp_path):
    table = AppendTable("append_casts", str(tmp_path / "t"))
    table.create(spark, rows("a BIGINT, b STRING").schema)
    assert table.append(rows("b STRING, a INT", ("x", 1)), "one") and not table.append(rows("a INT", (9,)), "one")
    assert table.append(rows("a INT", (2,)), "two")
    with pytest.raises(ConfigError):
        table.append(rows("a INT, c INT", (3, 3)), "three")
    assert table.append(rows("a INT, c INT", (3, 3)), "three", widen=True)
    assert sorted(map(tuple, spark.table("append_casts").collect())) == [(1, "x", None), (2, None, None), (3, None, 3)]
    with pytest.raises(ConfigError):
        AppendTable("append_clash", str(tmp_path / "c")).create(spark, rows("_batch INT").schema)


def test_a_repeat_has_the_time_of_the_first_attempt(spark, place, monkeypatch):
    """Dead letters are dated by the stream's log, so a repeat after midnight replaces the first ones."""
    place.drop({"id": 1, "v": "a"}, "{")
    crash_once(monkeypatch, run, "archive")
    times, job = [], place.job()
    for failing in (True, False):
        query = run_pipeline(spark, job, place.path("state"))
        if failing:
            with pytest.raises(StreamingQueryException):
                finish(spark, query, job, place.path("state"))
        else:
            finish(spark, query, job, place.path("state"))
        letters = deadletter.read_dlq(spark, place.path("dlq") + "/dlq").collect()
        times.append([r.timestamp for r in letters])
    assert len(times[0]) == 1 and times[0] == times[1]


def test_looking_up_a_batch_reads_one_entry(spark, rows, tmp_path):
    path, df = str(tmp_path / "ledger"), rows("a INT", (1,))
    for batch in range(4):
        ledger.once(df, path, "r", batch, AT, lambda d: None)
    assert sorted(r.batch_id for r in ledger.finished_batches(spark, path, "r").collect()) == [0, 1, 2, 3]
    (tmp_path / "ledger" / "r" / "0").rename(tmp_path / "gone")
    assert not ledger.is_finished(spark, path, "r", 0) and ledger.is_finished(spark, path, "r", 3)


def test_inferred_schema_is_kept(spark, place):
    place.drop({"id": 1, "v": "a"})
    place.drop({"id": "x", "v": "b"}, {"id": 3, "v": "c"})
    place.run(spark, place.job(schema={"auto_infer": True}))
    assert place.out(spark) == [(1, "a"), (3, "c")]


def test_without_a_schema_lines_pass(spark, place):
    place.drop({"id": 1})
    place.run(spark, place.job(schema=None))
    assert place.out(spark, "raw_json STRING") == [('{"id": 1}',)]


def test_mapping_filter_mask_encrypt(spark, place, monkeypatch):
    import base64

    monkeypatch.setenv("JOB_KEY", base64.b64encode(bytes(32)).decode())
    place.drop({"id": 1, "v": "a"}, {"id": 2, "v": None}, {"id": 3, "v": "skip"})
    job = place.job(
        field_mappings=[{"source_field": "id", "sink_field": "key", "cast": "string"}, {"source_field": "v", "sink_field": "text"}],
        transforms=[
            {"type": "fill_defaults", "params": {"defaults": {"text": "none"}}},
            {"type": "drop_if", "params": {"condition": "text = 'skip'"}},
            {"type": "encrypt", "params": {"columns": ["text"], "key_ref": "env:JOB_KEY"}},
            {"type": "decrypt", "params": {"columns": ["text"], "key_ref": "env:JOB_KEY"}},
            {"type": "pii_mask", "params": {"columns": ["key"], "method": "redact"}},
        ],
    )
    place.run(spark, job)
    assert place.out(spark, "key STRING, text STRING") == [("***", "a"), ("***", "none")]


def test_own_steps_and_partitioned_sink(spark, place):
    place.drop({"id": 1, "v": "a"}, {"id": 2, "v": "b"})
    job = place.job(transforms=[{"type": "shout", "params": {"column": "v"}}],
                    sink={"type": "parquet", "properties": {"path": place.path("out"), "partition_by": ["v"]}})
    place.run(spark, job, extra={"shout": lambda column: lambda df: df.withColumn(column, F.upper(column))})
    assert sorted(p.name for p in place.root.glob("out/run_id=*/batch_id=0/v=*")) == ["v=A", "v=B"]


def test_changes_merge_into_a_table(spark, place):
    spark.sql("DROP TABLE IF EXISTS stream_merge")
    job = place.job(
        schema={"ddl": "id BIGINT NOT NULL, op STRING NOT NULL, amount INT, lsn BIGINT NOT NULL"},
        sink={"type": "merge", "properties": {"table": "stream_merge", "path": place.path("out"), "upsert_keys": "id", "order_by": "lsn"}},
    )
    place.drop({"id": 1, "op": "c", "amount": 5, "lsn": 1}, {"id": 2, "op": "c", "amount": 6, "lsn": 2}, {"id": 1, "op": "u", "amount": 7, "lsn": 3})
    place.drop({"id": 2, "op": "d", "lsn": 4}, {"id": 3, "op": "c", "amount": 8, "lsn": 5})
    place.run(spark, job)
    assert sorted(tuple(r) for r in spark.table("stream_merge").collect()) == [(1, 7), (3, 8)]
    version = versions.current(spark, "stream_merge")
    keyed = KeyedTable("stream_merge", place.path("out"), ["id"], ["lsn"])
    feed = spark.createDataFrame([(1, "d", None, 9)], "id BIGINT, op STRING, amount INT, lsn BIGINT")
    keyed.merge(feed, version.step)
    assert versions.current(spark, "stream_merge") == version and spark.table("stream_merge").count() == 2


def test_late_changes_of_another_batch_do_not_win(spark, place):
    job = place.job(
        schema={"ddl": "id BIGINT NOT NULL, op STRING NOT NULL, amount INT, lsn BIGINT NOT NULL"},
        sink={"type": "merge", "properties": {"table": "stream_late", "path": place.path("out"), "upsert_keys": "id", "order_by": "lsn", "folders": 4}},
    )
    place.drop({"id": 1, "op": "u", "amount": 7, "lsn": 10}, {"id": 2, "op": "d", "lsn": 10}, {"id": 3, "op": "c", "amount": 1, "lsn": 1})
    place.run(spark, job)
    place.drop({"id": 1, "op": "u", "amount": 5, "lsn": 5}, {"id": 2, "op": "u", "amount": 5, "lsn": 5}, {"id": 3, "op": "u", "amount": 2, "lsn": 2})
    place.run(spark, job)
    assert sorted(tuple(r) for r in spark.table("stream_late").collect()) == [(1, 7), (3, 2)]


def test_a_plain_table_is_still_merged(spark, place):
    spark.createDataFrame([(1, 1), (2, 2)], "id BIGINT, amount INT").write.option("path", place.path("plain")).saveAsTable("stream_plain")
    job = place.job(
        schema={"ddl": "id BIGINT NOT NULL, op STRING NOT NULL, amount INT, lsn BIGINT NOT NULL"},
        sink={"type": "merge", "properties": {"table": "stream_plain", "path": place.path("out"), "upsert_keys": "id", "order_by": "lsn"}},
    )
    place.drop({"id": 1, "op": "u", "amount": 7, "lsn": 10}, {"id": 2, "op": "d", "lsn": 10})
    place.run(spark, job)
    assert [tuple(r) for r in spark.table("stream_plain").collect()] == [(1, 7)]


def other_state(place, spark, job):
    """A run that has lost its state, or another job on the same sink."""
    path = place.path("other")
    finish(spark, run_pipeline(spark, job, path, at=AT), job, path)


def test_a_run_with_another_state_adds_to_the_sink(spark, place):
    place.drop({"id": 1, "v": "a"}, "{")
    place.run(spark, place.job())
    for old in (place.root / "in").iterdir():
        old.write_text('{"id": 2, "v": "b"}\n[')
    other_state(place, spark, place.job())
    assert place.out(spark) == [(1, "a"), (2, "b")]
    assert deadletter.read_dlq(spark, place.path("dlq") + "/dlq").count() == 2


def test_a_merge_with_another_state_applies_its_changes(spark, place):
    spark.sql("DROP TABLE IF EXISTS stream_merge_again")
    job = place.job(
        schema={"ddl": "id BIGINT, op STRING NOT NULL, amount INT, lsn BIGINT"},
        sink={"type": "merge", "properties": {"table": "stream_merge_again", "path": place.path("out"), "upsert_keys": "id", "order_by": "lsn"}},
    )
    place.drop({"id": 1, "op": "c", "amount": 5, "lsn": 1}, {"op": "c", "amount": 5, "lsn": 1}, {"id": 7, "op": "c", "amount": 5})
    place.run(spark, job)
    for old in (place.root / "in").iterdir():
        old.write_text('{"id": 2, "op": "c", "amount": 6, "lsn": 2}')
    other_state(place, spark, job)
    assert sorted(tuple(r) for r in spark.table("stream_merge_again").collect()) == [(1, 5), (2, 6)]
    refused = deadletter.read_dlq(spark, place.path("dlq") + "/dlq").collect()
    assert sorted(r.error_message for r in refused) == ["missing:id", "missing:lsn"]


def test_an_undeclared_rate_is_no_limit(spark, place):
    for number in range(5):
        place.drop({"id": number, "v": "x"})
    job = place.job(source={"type": "lines", "properties": {"path": place.path("in")}})
    place.run(spark, job)
    assert run_metrics(spark, place.path("state")).count() == 1
    assert limits.reader_limits(job) == {} and len(place.out(spark)) == 5


def test_routed_sink(spark, place):
    rules = [{"field": "v", "operator": "=", "value": "a", "target_table": "first"}]
    place.drop({"id": 1, "v": "a"}, {"id": 2, "v": "b"})
    place.run(spark, place.job(sink={"type": "routed", "properties": {"path": place.path("out"), "rules": rules, "default": "rest"}}))
    found = spark.read.parquet(place.path("out")).select("id", "target_table").collect()
    assert sorted(tuple(r) for r in found) == [(1, "first"), (2, "rest")]


def test_kafka_sink_without_its_package(spark, place):
    place.drop({"id": 1, "v": "a"})
    sink = {"type": "kafka", "properties": {"topics": "t", "key_field": "id", "bootstrap_servers": "h:1"}}
    with pytest.raises(StreamingQueryException, match="Kafka package"):
        place.run(spark, place.job(sink=sink))


def test_refused_rows_without_a_store_stop_the_run(spark, place):
    place.drop({"id": 1, "v": "a"}, "{")
    with pytest.raises(StreamingQueryException, match="1 records refused"):
        place.run(spark, place.job(flags={"enable_dlq": False}))
    assert not os.listdir(place.path("out"))


def test_lag_of_a_batch_raises_an_alert(spark, place):
    place.drop({"id": 1, "at": "2024-01-31T23:50:00Z"}, {"id": 2, "at": "2024-01-31T23:54:00Z"})
    job = place.job(schema={"ddl": "id BIGINT, at TIMESTAMP"},
                    source={"type": "lines", "properties": {"path": place.path("in"), "event_time": "at"}})
    place.run(spark, job)
    assert run_metrics(spark, place.path("state")).first().lag_seconds == 360
    assert [r.title for r in spark.read.parquet(place.path("state") + "/alerts").collect()] == ["lag"]


def test_lineage_names_the_topic_of_each_record(spark, rows):
    from rowferry.plans.assemble import mark

    job = job_with({"type": "kafka", "properties": {"topics": "a,b"}}, schema={"ddl": "id BIGINT"})
    df = rows("topic STRING, raw_json STRING", ("a", '{"id":1}'), ("b", '{"id":2}'))
    assert [(r.id, r["_source_topic"]) for r in mark(df, job, AT, fields(id=LONG)).collect()] == [(1, "a"), (2, "b")]


def test_refused_rows_raise_an_alert(spark, place):
    place.drop({"id": 1, "v": "a"}, "{")
    place.run(spark, place.job())
    raised = spark.read.parquet(place.path("state") + "/alerts").first()
    assert (raised.title, raised.severity, raised.labels["records_dlq"]) == ("dlq_rate", "warning", "1")


def test_disabled_and_unknown(spark, place):
    assert run_pipeline(spark, place.job(enabled=False), place.path("state")) is None
    for change in ({"source": {"type": "nope"}}, {"sink": {"type": "nope"}}, {"transforms": [{"type": "nope"}]}):
        place.drop({"id": 1, "v": "a"})
        with pytest.raises((ConfigError, StreamingQueryException)):
            place.run(spark, place.job(**change))


def test_batch_read_of_the_same_source(spark, place):
    place.drop({"id": 1}, {"id": 2})
    assert open_source(spark, place.job(), stream=False).count() == 2


def job_with(source, **more):
    return job_from_dict({"pipeline_id": "p", "source": source, "sink": {"type": "noop"}, **more})


def test_limits_count_records():
    kafka = job_with({"type": "kafka"}, rate_limits={"max_source_tps": 10}, flags={"batch_flush_interval_ms": 2000})
    assert limits.reader_limits(kafka) == {"maxOffsetsPerTrigger": "20"}
    slow_sink = job_with({"type": "kafka"}, rate_limits={"max_sink_tps": 3}, flags={"batch_flush_interval_ms": 2000})
    assert limits.records_per_trigger(slow_sink) == 6
    zero = job_with({"type": "kafka"}, rate_limits={"max_source_tps": 0, "max_concurrent_connections": 0})
    assert limits.records_per_trigger(zero) == 25_000 and limits.sink_connections(zero) == 10
    files = job_with({"type": "lines", "properties": {"record_bytes": 100}}, rate_limits={"max_source_tps": 10})
    assert limits.reader_limits(files) == {"maxBytesPerTrigger": "5000"}
    assert limits.reader_limits(job_with({"type": "json"}, rate_limits={"max_concurrent_connections": 4})) == {}
    for source in ({"type": "json"}, {"type": "custom", "properties": {"record_bytes": 100}}):
        with pytest.raises(ConfigError):
            limits.reader_limits(job_with(source, rate_limits={"max_source_tps": 10}))
        assert limits.reader_limits(job_with(source, rate_limits={"max_source_tps": 10}), once=True) == {}


def test_flush_interval_is_the_trigger():
    assert limits.writer_trigger(job_with({"type": "lines"}), once=False) == {"processingTime": "5000 milliseconds"}
    assert limits.writer_trigger(job_with({"type": "lines"}), once=True) == {"availableNow": True}


def test_alert_rules(rows):
    metrics = rows("pipeline_id STRING, lag_seconds BIGINT, records_consumed BIGINT, records_dlq BIGINT",
                   ("a", 301, 100, 5), ("b", 300, 100, 6), ("c", 1, 0, 0))
    found = monitoring.alerts(metrics.where("records_consumed > 0"), at=AT).collect()
    assert [(r.pipeline_id, r.title, r.severity) for r in found] == [("a", "lag", "critical"), ("b", "dlq_rate", "warning")]
    assert found[0].labels["lag_seconds"] == "301" and found[0].timestamp == AT
    with pytest.raises(ConfigError):
        monitoring.AlertRule("x", "true", "loud")


def test_status_listing(rows):
    runs = rows("pipeline_id STRING, status STRING", ("b", "failed: x"), ("a", "running"), ("c", "failed"))
    assert [r.pipeline_id for r in monitoring.list_runs(runs, "failed").collect()] == ["b", "c"]
    assert [r.pipeline_id for r in monitoring.list_runs(runs, limit=1, offset=1).collect()] == ["b"]
    assert {tuple(r) for r in monitoring.status_counts(runs).collect()} == {("failed", 2), ("running", 1)}


def test_lag_and_usage(rows):
    df = rows("p STRING, at TIMESTAMP, body STRING", ("a", AT - timedelta(seconds=90), "xy"), ("a", AT - timedelta(days=1), "é"))
    assert monitoring.lag(df, "at", AT, ["p"]).first() == ("a", 90)
    assert sorted((str(r.day), r.records, r.bytes) for r in monitoring.usage(df, "p", "at", F.octet_length("body")).collect()) == [
        ("2024-01-31", 2, 4)]
