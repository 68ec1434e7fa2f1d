"""Turn a declared job into one DataFrame of marked rows.

Every row keeps ``_errors`` (what is wrong with it) and ``_raw`` (what came
in), so a single split at the end separates the sink from the dead letters and
Catalyst sees the job as one plan.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.config import Job
from rowferry.errors import ConfigError
from rowferry.functions.records import name, record_json
from rowferry.operators import contract, filters, mapping, protect
from rowferry.operators.deadletter import split, to_dlq
from rowferry.operators.mapping import ERRORS

RAW = "_raw"
TOPIC = "_topic"
CARRY = (ERRORS, RAW, TOPIC)

Step = Callable[[DataFrame], DataFrame]


def declared_schema(spark: SparkSession, job: Job) -> T.StructType | None:
    """The contract of the job: DDL text in the job, or a file with DDL or JSON text."""
    if job.schema is None:
        return None
    text = job.schema.ddl
    if text is None and job.schema.schema_path:
        text = spark.read.text(job.schema.schema_path, wholetext=True).first()[0]
    if text is None:
        return None
    if text.lstrip().startswith("{"):
        return T.StructType.fromJson(json.loads(text))
    return T.StructType.fromDDL(text)


def parse_records(df: DataFrame, job: Job, schema: T.StructType | None, column: str = "raw_json") -> DataFrame:
    """Raw records to typed columns plus ``_errors`` and ``_raw``, by the drift policy."""
    if column not in df.columns:
        marked = df.withColumn(RAW, record_json(df.columns))
        if schema is not None and job.flags.enable_schema_validation:
            return contract.conform(contract.validate(marked, schema), schema, CARRY)
        return mapping.add_errors(marked, [F.lit(None).cast("string")])
    topic = [name("topic").alias(TOPIC)] if "topic" in df.columns else []
    raw = df.select(name(column).alias(RAW), *topic)
    if schema is None:
        return mapping.add_errors(raw.withColumn(column, name(RAW)), [F.lit(None).cast("string")])
    # Unknown fields are faults, or go; under alter_table the caller passes the widened schema.
    # Unless validation is on, an absent field is no fault; a value that would be lost always is.
    expected = schema if job.flags.enable_schema_validation else contract.nullable(schema)
    records = contract.read_records(raw, RAW, expected, unknown=job.schema.drift_policy in ("dlq", "halt"))
    return records.select(*[name(c) for c in schema.names], *[c for c in CARRY if c in records.columns])


def steps_of(job: Job, extra: dict[str, Callable[..., Step]] | None = None) -> list[Step]:
    """The declared transforms in order; mappings come first unless placed by ``field_mapper``."""
    known = {**_STEPS, **(extra or {})}
    mapper = partial(mapping.field_mapper, mappings=job.field_mappings, carry=CARRY)
    steps: list[Step] = []
    if not any(t.type == "field_mapper" for t in job.transforms):
        steps.append(mapper)
    for t in job.transforms:
        if t.type == "field_mapper":
            steps.append(mapper)
        elif t.type in known:
            steps.append(known[t.type](**t.params))
        else:
            raise ConfigError(f"unknown transform {t.type!r}")
    return steps


def mark(df: DataFrame, job: Job, at: datetime, schema: T.StructType | None = None,
         extra: dict[str, Callable[..., Step]] | None = None, observe: Step = lambda d: d) -> DataFrame:
    """The whole job up to the sink. ``observe`` may count rows before filters drop any."""
    marked = observe(parse_records(df, job, schema))
    out = mapping.chain(marked, steps_of(job, extra))
    if job.flags.enable_lineage:
        declared = str(job.source.get("topics", job.source.type))
        origin = F.coalesce(name(TOPIC), F.lit(declared)) if TOPIC in out.columns else declared
        out = mapping.add_lineage(out, job.pipeline_id, origin, at)
    # The raw text is needed for refused rows only; without it a held batch is half as large.
    return out.drop(TOPIC).withColumn(RAW, F.when(F.size(ERRORS) > 0, name(RAW)))


def outcome(marked: DataFrame, job: Job, at: datetime) -> tuple[DataFrame, DataFrame]:
    """Rows for the sink, and dead letters."""
    good, bad = split(marked)
    return good.drop(RAW), to_dlq(bad, job.pipeline_id, at, original=name(RAW))


def _filter_step(filter_column: str | None = None, column: str | None = None) -> Step:
    return partial(filters.row_filter, column=filter_column or column, spare_errors=True)


def _drop_step(condition: str) -> Step:
    return partial(filters.drop_if, condition=condition, spare_errors=True)


def _mask_step(columns: Iterable[str], method: str = "sha256", salt: str | None = None, keep: int = 4) -> Step:
    if method == "sha256":
        return partial(protect.mask_hash, columns=columns, salt=salt)
    if method == "redact":
        return partial(protect.mask_redact, columns=columns)
    if method == "partial":
        return partial(protect.mask_partial, columns=columns, keep=keep)
    raise ConfigError(f"unknown mask {method!r}")


_STEPS: dict[str, Callable[..., Step]] = {
    "filter": _filter_step,
    "row_filter": _filter_step,
    "drop_if": _drop_step,
    "pii_mask": _mask_step,
    "encrypt": lambda **p: partial(protect.encrypt, **p),
    "decrypt": lambda **p: partial(protect.decrypt, **p),
    "fill_defaults": lambda **p: partial(mapping.fill_defaults, **p),
    "to_utc": lambda **p: partial(mapping.to_utc, **p),
    "epoch_to_iso": lambda **p: partial(mapping.epoch_columns_to_iso, **p),
    "record_key": lambda **p: partial(mapping.with_key, **p),
}
