"""User-written sinks on Spark's Python data source API."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage


@dataclass
class PartReceipt(WriterCommitMessage):
    rows: int
    note: Any = None


class BatchSink(DataSource):
    """A sink the user fills in with how to write one part and how to confirm all.

    ``write_part`` runs on executors and may run again for the same rows when
    a task is lost; only notes given to ``confirm`` count.
    """

    def write_part(self, batches: Iterator[pa.RecordBatch]) -> Any:
        raise NotImplementedError

    def confirm(self, notes: list[Any], rows: int) -> None:
        raise NotImplementedError

    def cancel(self, notes: list[Any]) -> None:
        return None

    def writer(self, schema: Any, overwrite: bool) -> DataSourceArrowWriter:
        return _PartWriter(self)


class _PartWriter(DataSourceArrowWriter):
    def __init__(self, sink: BatchSink) -> None:
        self.sink = sink

    def write(self, iterator: Iterator[pa.RecordBatch]) -> PartReceipt:
        counted = [0]

        def counting() -> Iterator[pa.RecordBatch]:
            for batch in iterator:
                counted[0] += batch.num_rows
                yield batch

        note = self.sink.write_part(counting())
        return PartReceipt(counted[0], note)

    def commit(self, messages: list[PartReceipt | None]) -> None:
        done = [m for m in messages if m is not None]
        self.sink.confirm([m.note for m in done], sum(m.rows for m in done))

    def abort(self, messages: list[PartReceipt | None]) -> None:
        self.sink.cancel([m.note for m in messages if m is not None])


def register_sink(spark: SparkSession, sink: type[DataSource]) -> str:
    """Make the class known as ``df.write.format(name)``."""
    spark.dataSource.register(sink)
    return sink.name()
