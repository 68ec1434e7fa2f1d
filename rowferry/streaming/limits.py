"""Declared rate limits as Spark trigger and reader options."""

from __future__ import annotations

from typing import Any

from rowferry.config import Job, RateLimits
from rowferry.errors import ConfigError

_FILE_SOURCES = ("lines", "stdin", "parquet", "json", "csv", "orc", "xml")


def _rate(value: int, default: int) -> int:
    return value if value > 0 else default


def records_per_trigger(job: Job) -> int:
    """Records one micro-batch may hold; both limits count records, not batches.

    A batch writes no more rows than it reads, so the lower of the source and
    the sink limit holds for both.
    """
    source = _rate(job.rate_limits.max_source_tps, RateLimits.max_source_tps)
    sink = _rate(job.rate_limits.max_sink_tps, RateLimits.max_sink_tps)
    return max(1, min(source, sink) * job.flags.batch_flush_interval_ms // 1000)


def reader_limits(job: Job, once: bool = False) -> dict[str, str]:
    """Reader options that hold a micro-batch to the declared source limit.

    A rate needs a clock: without declared limits, and in a run that drains
    the source and ends, micro-batches are as large as Spark makes them. A
    file source counts whole files or bytes; it is held to a rate by the
    property ``record_bytes``, which says how large records are. A declared
    rate that a source cannot be held to is refused.
    """
    if job.source.get("max_files_per_trigger"):
        return {"maxFilesPerTrigger": str(job.source.get("max_files_per_trigger"))}
    if once or not job.rate_limits.declared:
        return {}
    if job.source.type == "kafka":
        return {"maxOffsetsPerTrigger": str(records_per_trigger(job))}
    if job.source.type not in _FILE_SOURCES:
        raise ConfigError(f"a source of type {job.source.type!r} cannot be held to a declared rate")
    return {"maxBytesPerTrigger": str(records_per_trigger(job) * int(job.source.require("record_bytes")))}


def writer_trigger(job: Job, once: bool) -> dict[str, Any]:
    """Drain what is there and stop, or go on with the declared flush interval."""
    if once:
        return {"availableNow": True}
    return {"processingTime": f"{job.flags.batch_flush_interval_ms} milliseconds"}


def sink_connections(job: Job) -> int:
    return _rate(job.rate_limits.max_concurrent_connections, RateLimits.max_concurrent_connections)
