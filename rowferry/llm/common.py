"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import wraps
from typing import Any, Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.session import configure, discard, scratch, stage, together  # noqa: F401

# Rows and bytes that one Arrow batch holds in a Python worker, so that a run
# of long texts does not fill it.
BATCH_ROWS = 1_000
BATCH_BYTES = 32 << 20
# About 130 MB where they are sent to, as bigint.
BROADCAST_IDS = 4_000_000

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` only tests check it."""
    def add(run: Query) -> Query:
        @wraps(run)
        def prepared(spark: SparkSession, sf: str) -> DataFrame:
            return run(prepare(spark), sf.rstrip("/"))

        QUERIES[name] = prepared
        if sql is not None:
            ORACLES[name] = sql
        return prepared

    return add


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of this package, bounded Arrow batches, and shuffle files that go when their query ends."""
    configure(spark)
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage through the shared folder; see ``rowferry.session.stage``."""
    return stage(df, label)


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns; other columns and their names do not matter."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, lengthened until no column of ``df`` has that name."""
    taken = {column.lower() for column in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def without(docs: DataFrame, ids: DataFrame, keep: bool = False) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is not in the single column of ``ids``; or is, with ``keep``.

    Up to ``BROADCAST_IDS`` ids are sent to the tasks, so that the texts are not shuffled.
    """
    name = free_name(docs, "_id")
    named = staged(ids.toDF(name), "ids")
    if named.count() <= BROADCAST_IDS:
        named = F.broadcast(named)
    return docs.join(named, docs["doc_id"] == named[name], "left_semi" if keep else "left_anti")


def map_arrow(
    df: DataFrame, work: Callable[[pa.RecordBatch], dict[str, Any] | Iterable[dict[str, Any]]], schema: str,
) -> DataFrame:
    """Apply ``work`` to each Arrow batch; it gives the columns of the result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work(batch)
            for columns in [made] if isinstance(made, dict) else made:
                yield pa.RecordBatch.from_pydict(columns)

    return df.mapInArrow(run, schema)


def strings(column: pa.Array) -> list[str]:
    """Values as Python text, null as empty text."""
    return ["" if value is None else value for value in column.to_pylist()]
