import json

import pytest

from rowferry.config import Connector, job_from_dict, job_from_json, jobs_from_yaml, resolve_secret
from rowferry.errors import ConfigError

SMALL = {"pipeline_id": "p", "source": {"type": "lines"}, "sink": {"type": "noop"}}


def test_defaults():
    job = job_from_json(json.dumps(SMALL))
    assert job.enabled and job.field_mappings == () and job.schema is None
    limits, flags = job.rate_limits, job.flags
    assert (limits.max_source_tps, limits.max_sink_tps, limits.max_concurrent_connections) == (10_000, 5_000, 10)
    assert flags.enable_dlq and not flags.enable_schema_validation and flags.enable_lineage
    assert flags.batch_flush_interval_ms == 5_000
    assert job.dlq.max_records_per_file == 10_000 and job.dlq.max_file_size_bytes == 104_857_600


def test_both_spellings():
    raw = {**SMALL, "source": {"type": "kafka", "properties": {"topic": "a"}},
           "sink": {"type": "postgres", "properties": {"table": "t", "database_url": "u"}}}
    job = job_from_dict(raw)
    assert job.source.require("topics") == "a"
    assert job.sink.require("table_name") == "t" and job.sink.require("connection_string") == "u"


@pytest.mark.parametrize("text,policy", [("Halt", "halt"), ("DropField", "drop_field"), ("Dlq", "dlq"), ("AlterTable", "alter_table")])
def test_drift_policy_names(text, policy):
    assert job_from_dict({**SMALL, "schema": {"drift_policy": text}}).schema.drift_policy == policy


@pytest.mark.parametrize("change", [
    {"schema": {"drift_policy": "Ignore"}}, {"rate_limits": {"tps": 1}}, {"source": {"properties": {}}}, {"pipeline_id": None, "sink": None},
])
def test_wrong_jobs_are_refused(change):
    raw = {k: v for k, v in {**SMALL, **change}.items() if v is not None}
    with pytest.raises(ConfigError):
        job_from_dict(raw)


def test_broken_json_is_refused():
    with pytest.raises(ConfigError):
        job_from_json("{")


def test_yaml_list():
    pytest.importorskip("yaml")
    jobs = jobs_from_yaml("- pipeline_id: a\n  source: {type: lines}\n  sink: {type: noop}\n")
    assert [j.pipeline_id for j in jobs] == ["a"]


def test_secrets(monkeypatch):
    monkeypatch.setenv("STORE_KEY", "s3cret")
    assert resolve_secret("env:STORE_KEY") == "s3cret" and resolve_secret("plain") == "plain"
    both = Connector("postgres", {"connection_string": "property"}, {"connection_string": "env:STORE_KEY"})
    assert both.get("connection_string") == "s3cret"
    with pytest.raises(ConfigError):
        resolve_secret("env:NOT_SET_ANYWHERE")
