"""User-written sources on Spark's Python data source API."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition


class PolledSource(DataSource):
    """A source the user fills in with what to read and how to read one part.

    ``parts`` runs on the driver and names independent pieces of work; ``poll``
    runs on executors and gives the rows (tuples or Arrow batches) of one piece.
    A job reads such a source once; its checkpoint remembers that it did.
    """

    def parts(self) -> Iterable[Any]:
        raise NotImplementedError

    def poll(self, part: Any) -> Iterator[Any]:
        raise NotImplementedError

    def reader(self, schema: Any) -> DataSourceReader:
        return _PartReader(self)

    def streamReader(self, schema: Any) -> DataSourceStreamReader:
        return _OnceReader(self)


class StreamedSource(PolledSource):
    """A source that goes on, in pieces between two positions.

    Positions are dictionaries of plain values. ``start`` is the first,
    ``latest`` the last there is now; ``parts_between`` names the pieces of
    work from one to the other and must name the same ones each time, since a
    failed batch is read again. ``acknowledge`` tells that everything before a
    position was written and will not be asked for again.

    Spark drains such a source in one micro-batch per run; the run after a
    failed one repeats that batch, and the run after that goes on.
    """

    def start(self) -> dict[str, Any]:
        raise NotImplementedError

    def latest(self) -> dict[str, Any]:
        raise NotImplementedError

    def parts_between(self, start: dict[str, Any], end: dict[str, Any]) -> Iterable[Any]:
        raise NotImplementedError

    def acknowledge(self, end: dict[str, Any]) -> None:
        pass

    def parts(self) -> Iterable[Any]:
        return self.parts_between(self.start(), self.latest())

    def streamReader(self, schema: Any) -> DataSourceStreamReader:
        return _StreamedReader(self)


class _PartReader(DataSourceReader):
    def __init__(self, source: PolledSource) -> None:
        self.source = source

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.source.parts()]

    def read(self, partition: InputPartition) -> Iterator[Any]:
        return self.source.poll(partition.value)


class _StreamedReader(DataSourceStreamReader):
    def __init__(self, source: StreamedSource) -> None:
        self.source = source

    def initialOffset(self) -> dict[str, Any]:
        return self.source.start()

    def latestOffset(self) -> dict[str, Any]:
        return self.source.latest()

    def partitions(self, start: dict[str, Any], end: dict[str, Any]) -> list[InputPartition]:
        return [InputPartition(p) for p in self.source.parts_between(start, end)]

    def read(self, partition: InputPartition) -> Iterator[Any]:
        return self.source.poll(partition.value)

    def commit(self, end: dict[str, Any]) -> None:
        self.source.acknowledge(end)


class _OnceReader(DataSourceStreamReader):
    """All parts of a batch source as the only micro-batch with rows."""

    def __init__(self, source: PolledSource) -> None:
        self.source = source

    def initialOffset(self) -> dict[str, int]:
        return {"read": 0}

    def latestOffset(self) -> dict[str, int]:
        return {"read": 1}

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[InputPartition]:
        return [InputPartition(p) for p in self.source.parts()] if end["read"] > start["read"] else []

    def read(self, partition: InputPartition) -> Iterator[Any]:
        return self.source.poll(partition.value)


def register_source(spark: SparkSession, source: type[DataSource]) -> str:
    """Make the class known as ``spark.read.format(name)`` and ``spark.readStream.format(name)``."""
    spark.dataSource.register(source)
    return source.name()
