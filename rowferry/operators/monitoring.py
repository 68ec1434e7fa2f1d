"""Counters, lag, alerts, run history and usage as tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.errors import ConfigError
from rowferry.functions.casts import instant
from rowferry.functions.records import name
from rowferry.operators.cdc import latest
from rowferry.operators.deadletter import error_category
from rowferry.operators.mapping import ERRORS

# Run states, alert severities.
STATES = ("starting", "running", "paused", "stopped", "failed")
SEVERITIES = ("info", "warning", "critical")


def run_counters(df: DataFrame, kept: Column | None = None, by: list[str] | None = None,
                 more: dict[str, Column] | None = None) -> DataFrame:
    """Five counters from marked rows in one pass.

    ``df`` has ``_errors`` after validation and transforms; ``kept`` is false
    for rows a filter dropped; ``more`` adds aggregates to the same pass.
    """
    clean = F.size(ERRORS) == 0
    contract = error_category(F.col(ERRORS)).isin("schema_validation", "source_parsing_error")
    sunk = clean if kept is None else clean & F.coalesce(kept, F.lit(False))
    return df.groupBy(*[name(c) for c in (by or [])]).agg(
        F.count("*").alias("records_consumed"),
        F.count_if(clean | ~contract).alias("records_validated"),
        F.count_if(clean).alias("records_transformed"),
        F.count_if(~clean).alias("records_dlq"),
        F.count_if(sunk).alias("records_sunk"),
        *[value.alias(label) for label, value in (more or {}).items()],
    )


def lag_seconds(ts: str, now: datetime) -> Column:
    """Whole seconds from the newest record of a group to ``now``."""
    newest = F.max(name(ts)).cast("timestamp")
    micros = F.unix_micros(instant(now)) - F.unix_micros(newest)
    return F.floor(micros / F.lit(1_000_000)).cast("bigint")


def lag(df: DataFrame, ts: str, now: datetime, by: list[str]) -> DataFrame:
    return df.groupBy(*[name(c) for c in by]).agg(lag_seconds(ts, now).alias("lag_seconds"))


@dataclass(frozen=True)
class AlertRule:
    title: str
    condition: str
    severity: str = "warning"
    description: str = ""

    def __post_init__(self) -> None:
        if self.severity not in SEVERITIES:
            raise ConfigError(f"unknown severity {self.severity!r}")


# Alert when a job lags by over five minutes or refuses over 5 % of its records.
DEFAULT_RULES = (
    AlertRule("lag", "lag_seconds > 300", "critical", "newest record is older than 300 seconds"),
    AlertRule("dlq_rate", "records_dlq / records_consumed > 0.05", "warning", "over 5 % of records refused"),
)


def alerts(metrics: DataFrame, rules: tuple[AlertRule, ...] = DEFAULT_RULES, at: datetime | None = None) -> DataFrame:
    """One row per rule that holds, in one pass over the metrics."""
    def raised(rule: AlertRule) -> Column:
        row = F.struct(
            F.lit(rule.severity).alias("severity"),
            F.lit(rule.title).alias("title"),
            F.lit(rule.description).alias("description"),
        )
        return F.when(F.expr(rule.condition), row)

    numbers = [c for c, kind in metrics.dtypes if c != "pipeline_id" and kind in ("bigint", "int", "double")]
    labels = F.create_map(*[part for c in numbers for part in (F.lit(c), name(c).cast("string"))])
    holding = F.filter(F.array(*[raised(r) for r in rules]), lambda a: a.isNotNull())
    rows = metrics.select("pipeline_id", F.explode(holding).alias("a"), labels.alias("labels"))
    return rows.select("pipeline_id", "a.*", instant(at).alias("timestamp"), "labels")


def current_runs(history: DataFrame) -> DataFrame:
    """The newest state per job from the append-only run history (``pipeline_id, seq, status``)."""
    return latest(history, ["pipeline_id"], ["seq"])


def list_runs(runs: DataFrame, status: str | None = None, limit: int = 100, offset: int = 0) -> DataFrame:
    """Jobs in a state (``failed`` also finds ``failed: <reason>``), one page in id order."""
    if status is not None:
        runs = runs.where(F.substring_index("status", ":", 1) == status)
    return runs.orderBy("pipeline_id").offset(offset).limit(limit)


def status_counts(runs: DataFrame) -> DataFrame:
    return runs.groupBy(F.substring_index("status", ":", 1).alias("status")).agg(F.count("*").alias("n"))


def usage(df: DataFrame, pipeline: str, ts: str, size: Column) -> DataFrame:
    """Records and bytes per job and day."""
    return df.groupBy(name(pipeline).alias("pipeline_id"), F.to_date(name(ts)).alias("day")).agg(
        F.count("*").alias("records"), F.sum(size.cast("bigint")).alias("bytes")
    )


def archive(metrics: DataFrame, root: str, at: datetime) -> None:
    """Append counters as Parquet, by job and day."""
    dated = metrics.withColumns({"at": instant(at), "date": F.to_date(instant(at))})
    dated.write.mode("append").partitionBy("pipeline_id", "date").parquet(root)
