"""Content routing: which target table a row belongs to."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.errors import ConfigError
from rowferry.functions.records import name

TARGET = "target_table"


@dataclass(frozen=True)
class Rule:
    field: str
    operator: str
    value: str
    target_table: str

    def matches(self) -> Column:
        value = name(self.field)
        if self.operator in ("=", "==", "equals"):
            return value == F.lit(self.value)
        if self.operator in ("regex", "matches"):
            return value.cast("string").rlike(self.value)
        raise ConfigError(f"unknown routing operator {self.operator!r}")


def route(df: DataFrame, rules: list[Rule], default: str | None = None) -> DataFrame:
    """Add ``target_table``: the first matching rule wins, then the default."""
    target = F.lit(default).cast("string")
    for rule in reversed(rules):
        target = F.when(rule.matches(), F.lit(rule.target_table)).otherwise(target)
    return df.withColumn(TARGET, target)
