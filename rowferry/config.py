"""The declared job: dataclasses, defaults, accepted spellings, JSON and YAML."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from typing import Any

from rowferry.errors import ConfigError

# What to do with records outside the declared schema.
DRIFT_POLICIES = ("halt", "drop_field", "dlq", "alter_table")

# A second accepted spelling for each connector property.
PROPERTY_ALIASES = {
    "topic": "topics",
    "table": "table_name",
    "database_url": "connection_string",
}


@dataclass(frozen=True)
class Connector:
    type: str
    properties: dict[str, Any] = field(default_factory=dict)
    secrets: dict[str, str] = field(default_factory=dict)

    def get(self, name: str, default: Any = None) -> Any:
        """A secret of that name if there is one, else the property, else the default."""
        if name in self.secrets:
            return resolve_secret(self.secrets[name])
        return self.properties.get(name, default)

    def require(self, name: str) -> Any:
        value = self.get(name)
        if value in (None, ""):
            raise ConfigError(f"connector {self.type!r} needs the property {name!r}")
        return value


@dataclass(frozen=True)
class FieldMapping:
    source_field: str
    sink_field: str
    cast: str | None = None


@dataclass(frozen=True)
class Transform:
    type: str
    params: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class SchemaRules:
    schema_path: str | None = None
    ddl: str | None = None
    drift_policy: str = "dlq"
    auto_infer: bool = False


@dataclass(frozen=True)
class RateLimits:
    max_source_tps: int = 10_000
    max_sink_tps: int = 5_000
    max_concurrent_connections: int = 10
    declared: bool = False


@dataclass(frozen=True)
class Flags:
    enable_dlq: bool = True
    enable_schema_validation: bool = False
    require_tls: bool = True
    max_memory_buffer_mb: int = 512
    batch_flush_interval_ms: int = 5_000
    enable_lineage: bool = True
    concurrency_limit: int = 64


@dataclass(frozen=True)
class DeadLetters:
    storage_uri: str | None = None
    prefix: str = "dlq"
    max_file_size_bytes: int = 100 * 1024 * 1024
    max_records_per_file: int = 10_000
    compression: str = "none"


@dataclass(frozen=True)
class Job:
    pipeline_id: str
    source: Connector
    sink: Connector
    enabled: bool = True
    field_mappings: tuple[FieldMapping, ...] = ()
    transforms: tuple[Transform, ...] = ()
    schema: SchemaRules | None = None
    rate_limits: RateLimits = RateLimits()
    flags: Flags = Flags()
    dlq: DeadLetters = DeadLetters()
    run_id: str = ""
    schema_version: int = 0


def resolve_secret(reference: str) -> str:
    """``env:NAME`` reads the driver's environment; other text is the value itself."""
    if not reference.startswith("env:"):
        return reference
    name = reference[len("env:"):]
    if name not in os.environ:
        raise ConfigError(f"environment variable {name!r} is not set")
    return os.environ[name]


def job_from_dict(raw: dict[str, Any]) -> Job:
    for needed in ("pipeline_id", "source", "sink"):
        if needed not in raw:
            raise ConfigError(f"the job lacks {needed!r}")
    schema = _block(SchemaRules, raw["schema"]) if raw.get("schema") else None
    if schema is not None:
        policy = _snake(schema.drift_policy)
        if policy not in DRIFT_POLICIES:
            raise ConfigError(f"unknown drift policy {schema.drift_policy!r}")
        schema = SchemaRules(schema.schema_path, schema.ddl, policy, schema.auto_infer)
    limits = raw.get("rate_limits") or {}
    return Job(
        pipeline_id=raw["pipeline_id"],
        source=_connector(raw["source"]),
        sink=_connector(raw["sink"]),
        enabled=raw.get("enabled", True),
        field_mappings=tuple(_block(FieldMapping, m) for m in raw.get("field_mappings", ())),
        transforms=tuple(_block(Transform, t) for t in raw.get("transforms", ())),
        schema=schema,
        rate_limits=_block(RateLimits, {**limits, "declared": any(key.endswith("_tps") for key in limits)}),
        flags=_block(Flags, raw.get("flags", {})),
        dlq=_block(DeadLetters, raw.get("dlq", {})),
    )


def job_from_json(text: str) -> Job:
    try:
        return job_from_dict(json.loads(text))
    except json.JSONDecodeError as broken:
        raise ConfigError(f"the job is not valid JSON: {broken}") from broken


def jobs_from_yaml(text: str) -> list[Job]:
    """One job, or a list of jobs, in YAML."""
    try:
        import yaml
    except ImportError:
        raise ConfigError("YAML jobs need the 'yaml' module; use JSON") from None
    raw = yaml.safe_load(text)
    return [job_from_dict(r) for r in (raw if isinstance(raw, list) else [raw])]


def _connector(raw: dict[str, Any]) -> Connector:
    if "type" not in raw:
        raise ConfigError("a connector needs a 'type'")
    properties = {PROPERTY_ALIASES.get(k, k): v for k, v in raw.get("properties", {}).items()}
    secrets = {PROPERTY_ALIASES.get(k, k): v for k, v in raw.get("secrets", {}).items()}
    return Connector(raw["type"], properties, secrets)


def _block(cls: type, raw: dict[str, Any]) -> Any:
    try:
        return cls(**raw)
    except TypeError as wrong:
        raise ConfigError(f"{cls.__name__}: {wrong}") from None


def _snake(text: str) -> str:
    return "".join("_" + c.lower() if c.isupper() and i else c.lower() for i, c in enumerate(text))
