"""The newest change of each key on a stream, by keyed state.

State holds the order of the newest change seen per key, nothing else of the
row. A change that is not newer than it is dropped, however late it comes, so
what leaves the stream of a key ascends in the order. The order of a deleted
key is a tombstone, which can have a time to live.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rowferry.errors import ConfigError
from rowferry.functions.records import name
from rowferry.operators.cdc import placed
from rowferry.sources.changes import DELETE

STORE_SETTING = "spark.sql.streaming.stateStore.providerClass"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Rows and bytes that a task holds before the shuffle.
HELD_ROWS = 50_000
HELD_BYTES = 32 << 20


def newest_on_stream(
    changes: DataFrame, keys: list[str], order: list[str], snapshot: DataFrame | None = None,
    tombstone_ttl: timedelta | None = None, op: str = "op",
) -> DataFrame:
    """Of a stream of changes those that are newer than all seen of their key; one per key and micro-batch.

    ``snapshot`` is a batch table with the keys and order columns of rows known
    downstream; a new stream starts from it, a restarted one from its
    checkpoint. With ``tombstone_ttl`` the order of a deleted key is forgotten
    that long after the delete came; a change older than that delete can then
    pass. State with a time to live asks for batches without new data, so a
    query that only drains its source never ends unless
    ``spark.sql.streaming.noDataMicroBatches.enabled`` is ``false``. Changes without a key or an order are left out (see
    :func:`cdc.unplaced`), and of changes equal in the order the one that came
    first counts.

    Each task reduces its changes to the newest per key before the shuffle, as
    many as it can hold at a time, so a hot key sends few rows. The snapshot is
    reduced to one row per key before it becomes state. Query and sink take output mode ``append``.
    """
    if changes.sparkSession.conf.get(STORE_SETTING, "") != STORE:
        raise ConfigError(f"keyed state needs {STORE_SETTING} set to {STORE}")
    schema = changes.schema
    orders = T.StructType([T.StructField(c, schema[c].dataType) for c in order])
    reduced = placed(changes, keys, order).mapInArrow(_newest_of_batches(keys, order), schema)
    known = None
    if snapshot is not None:
        known = placed(snapshot, keys, order).select(*[name(c).cast(schema[c].dataType).alias(c) for c in dict.fromkeys([*keys, *order])])
        newest = F.max(F.struct(*[name(c) for c in order])).alias("_newest")
        known = known.groupBy(*[name(c) for c in keys]).agg(newest)
        known = known.select(*[name(c) for c in keys], *[F.col("_newest").getField(c).alias(c) for c in order if c not in keys])
        known = known.groupBy(*[name(c) for c in keys])
    found = reduced.groupBy(*[name(c) for c in keys]).transformWithState(
        _Newest(order, orders, op if op in schema.names else None, tombstone_ttl), schema, "Append",
        "ProcessingTime" if tombstone_ttl else "None", known,
    )
    return found


def _newest_of_batches(keys: list[str], order: list[str]):
    """The newest row per key of the Arrow batches held at a time; of equal ones the first."""
    def reduced(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [batch.column(c).to_pylist() for c in order]
        identities = zip(*[batch.column(c).to_pylist() for c in keys])
        best: dict[tuple, tuple[tuple, int]] = {}
        for at, (key, place) in enumerate(zip(identities, zip(*columns))):
            if key not in best or place > best[key][0]:
                best[key] = (place, at)
        return batch.take(pa.array(sorted(at for _, at in best.values()), pa.int64()))

    def size(held: list[pa.RecordBatch]) -> float:
        return max(sum(b.num_rows for b in held) / HELD_ROWS, sum(b.nbytes for b in held) / HELD_BYTES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(reduced(batch))
            if size(held) > 1:
                held = [reduced(pa.concat_batches(held))]
                if size(held) > 0.5:
                    yield held.pop()
        if held:
            yield reduced(pa.concat_batches(held))

    return work


class _Newest(StatefulProcessor):
    """The order of the newest change of a key, in one of two states: its row lives, or it is deleted."""

    def __init__(self, order: list[str], orders: T.StructType, op: str | None, ttl: timedelta | None):
        self.order, self.orders, self.op = order, orders, op
        self.ttl = None if ttl is None else int(ttl.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.live = handle.getValueState("live", self.orders)
        self.gone = handle.getValueState("gone", self.orders, self.ttl)

    def _place(self, row: Row) -> tuple:
        return tuple(row[c] for c in self.order)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        # Each call of a state is a message to the store, so there are as few as can be: one of the two holds the key.
        held, known = self.live, self.live.get()
        if known is None:
            held, known = self.gone, self.gone.get()
        newest, place = None, None if known is None else tuple(known)
        for row in rows:
            if place is None or self._place(row) > place:
                newest, place = row, self._place(row)
        if newest is not None:
            kept = self.gone if self.op is not None and newest[self.op] == DELETE else self.live
            kept.update(place)
            if known is not None and kept is not held:
                held.clear()
            yield newest

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        self.live.update(self._place(initialState))

    def close(self) -> None:
        pass
