"""The newest change per key on a stream, across batches and restarts."""

import time
from datetime import timedelta

import pyarrow as pa
import pytest
from pyspark.sql import Row

from rowferry.errors import ConfigError
from rowferry.session import sql_settings
from rowferry.streaming import current
from rowferry.streaming.current import STORE, STORE_SETTING, newest_on_stream

DDL = "id STRING, part INT, lsn BIGINT, sub INT, op STRING, v STRING"


@pytest.fixture
def arrive(spark, rows, tmp_path):
    """Land changes, run the stream until it has read them, and give what it let pass so far."""
    landing, sink, state = (str(tmp_path / name) for name in ("landing", "sink", "state"))

    def run(*changes, **options):
        table = rows(DDL, *changes)
        table.coalesce(1).write.mode("append").parquet(landing)
        with sql_settings(spark, {STORE_SETTING: STORE, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}):
            stream = newest_on_stream(spark.readStream.schema(table.schema).parquet(landing), ["id", "part"], ["lsn", "sub"], **options)
            query = stream.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(sink)
            query.awaitTermination()
        return sorted(r.v for r in spark.read.schema(table.schema).parquet(sink).collect())

    return run


def test_late_changes_never_pass(arrive):
    first = arrive(
        ("a", 1, 5, 0, "u", "a5"), ("a", 1, 3, 9, "u", "a3"), ("a", 2, 1, 0, "u", "other part"), ("b", 1, 7, 0, "d", "b gone"),
        ("t", 1, 1, 1, "u", "tie"), ("t", 1, 1, 1, "u", "tie again"), (None, 1, 9, 0, "u", "no key"), ("n", 1, None, 0, "u", "no order"),
    )
    assert first == ["a5", "b gone", "other part", "tie"]
    second = arrive(
        ("a", 1, 4, 0, "u", "late"), ("a", 1, 5, 0, "u", "same"), ("b", 1, 6, 0, "u", "before the delete"),
        ("a", 2, 1, 1, "u", "by the second column"), ("c", 1, 0, 0, "c", "new"),
    )
    assert second == sorted([*first, "by the second column", "new"])
    assert arrive(("b", 1, 8, 0, "c", "b again"), ("a", 1, 6, 0, "d", "a gone")) == sorted([*second, "b again", "a gone"])
    assert "a5b" not in arrive(("a", 1, 5, 5, "u", "a5b"))


def test_snapshot_counts_once_and_is_not_emitted(rows, arrive):
    known = rows("more STRING, lsn INT, sub INT, id STRING, part INT", ("x", 4, 0, "a", 1), ("x", 6, 0, "a", 1), ("x", None, 0, "b", 1))
    assert arrive(("a", 1, 5, 0, "u", "old"), ("b", 1, 1, 0, "u", "b1"), snapshot=known) == ["b1"]
    assert arrive(("a", 1, 7, 0, "u", "a7"), ("b", 1, 1, 0, "u", "b1 twice"), snapshot=known) == ["a7", "b1"]


def test_tombstones_end(arrive):
    ttl = timedelta(seconds=2)
    assert arrive(("a", 1, 5, 0, "d", "gone"), ("b", 1, 5, 0, "u", "lives"), tombstone_ttl=ttl) == ["gone", "lives"]
    time.sleep(3)
    found = arrive(("a", 1, 4, 0, "u", "older, after the tombstone"), ("b", 1, 4, 0, "u", "late"), tombstone_ttl=ttl)
    assert found == ["gone", "lives", "older, after the tombstone"]


def test_hot_key_is_reduced_before_the_shuffle(arrive):
    assert arrive(*[("hot", 1, i, 0, "u", str(i)) for i in range(5000)], ("cold", 1, 1, 0, "u", "cold")) == ["4999", "cold"]


def test_a_task_reduces_across_its_batches(monkeypatch):
    batches = [pa.RecordBatch.from_pydict({"id": ["hot", "hot", f"cold {i}"], "lsn": [i, 99 - i, i], "v": [f"{i}a", f"{i}b", "c"]}) for i in range(20)]
    work = current._newest_of_batches(["id"], ["lsn"])
    found = [row for batch in work(iter(batches)) for row in batch.to_pylist()]
    assert [row for row in found if row["id"] == "hot"] == [{"id": "hot", "lsn": 99, "v": "0b"}]
    assert len(found) == 21
    monkeypatch.setattr(current, "HELD_ROWS", 4)
    found = [row for batch in work(iter(batches)) for row in batch.to_pylist()]
    assert {row["id"]: max(r["lsn"] for r in found if r["id"] == row["id"]) for row in found} == {"hot": 99} | {f"cold {i}": i for i in range(20)}
    assert list(work(iter([]))) == []


class Counted:
    """A state in memory that counts the messages it would take."""

    def __init__(self, value=None):
        self.value, self.messages = value, 0

    def get(self):
        self.messages += 1
        return self.value

    def exists(self):
        self.messages += 1
        return self.value is not None

    def update(self, value):
        self.messages, self.value = self.messages + 1, value

    def clear(self):
        self.messages, self.value = self.messages + 1, None


@pytest.mark.parametrize("live, gone, op, expected, most", [
    ((5,), None, "u", ((7,), None), 2), ((5,), None, "d", (None, (7,)), 3), (None, (5,), "u", ((7,), None), 4),
    (None, (5,), "d", (None, (7,)), 3), (None, None, "u", ((7,), None), 3), ((8,), None, "u", ((8,), None), 1),
])
def test_messages_to_the_store_are_few(live, gone, op, expected, most):
    newest = current._Newest(["lsn"], None, "op", None)
    newest.live, newest.gone = Counted(live), Counted(gone)
    list(newest.handleInputRows(("a",), iter([Row(lsn=3, op="u"), Row(lsn=7, op=op)]), None))
    assert (newest.live.value, newest.gone.value) == expected
    assert newest.live.messages + newest.gone.messages <= most


def test_store_is_asked_for(spark, rows):
    with pytest.raises(ConfigError):
        newest_on_stream(rows(DDL, ("a", 1, 1, 1, "u", "v")), ["id"], ["lsn"])
