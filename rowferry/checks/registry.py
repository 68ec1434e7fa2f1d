"""The list of registered queries and the plain SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from rowferry.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` only its rows are checked."""
    def add(query: Query) -> Query:
        @wraps(query)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return query(configure(spark), sf.rstrip("/"))

        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)


def _load() -> None:
    from rowferry.checks import contracts, delivery, growth, intake, runs, shaping  # noqa: F401
