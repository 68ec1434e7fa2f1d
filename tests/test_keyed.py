"""Keyed tables: late and repeated changes, tombstones, and which folders a merge touches."""

import uuid
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from plans import plan

from rowferry.errors import ConfigError
from rowferry.operators import cdc
from rowferry.sinks import versions
from rowferry.sinks.keyed import KeyedTable

CHANGE = "id BIGINT, lsn BIGINT, op STRING, amount INT"


@pytest.fixture
def keyed(spark, tmp_path):
    def make(rows=(), **more):
        table = KeyedTable(f"keyed_{uuid.uuid4().hex}", str(tmp_path / uuid.uuid4().hex), ["id"], ["lsn"], **{"folders": 4, **more})
        changes = spark.createDataFrame([], CHANGE)
        table.create(spark, changes.select("id", "amount").schema, changes.schema)
        if rows:
            table.load(spark.createDataFrame(list(rows), "id BIGINT, amount INT"), "load")
        return table

    return make


def live(spark, table):
    return {r.id: r.amount for r in table.rows(spark).collect()}


feeds = st.lists(st.tuples(st.integers(0, 5), st.sampled_from("cud"), st.integers(0, 9)), min_size=1, max_size=20)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(feeds, st.dictionaries(st.integers(0, 8), st.integers(0, 9), max_size=5), st.booleans(), st.randoms())
def test_batches_in_any_order_give_the_newest_rows(spark, keyed, feed, start, few, order):
    changes = [(k, i, op, a) for i, (k, op, a) in enumerate(feed)]
    wanted = dict(start)
    for k, _, op, a in changes:
        wanted.pop(k, None)
        if op != "d":
            wanted[k] = a
    order.shuffle(changes)
    table = keyed(start.items())
    cut = len(changes) // 2
    for step, batch in enumerate([changes[:cut], changes[cut:], changes[:cut]]):
        table.merge(spark.createDataFrame(batch, CHANGE), f"s{step}", few=few)
    assert live(spark, table) == wanted


def test_a_late_change_after_a_delete_stays_out(spark, keyed, rows):
    table = keyed([(1, 1), (2, 2)])
    table.merge(rows(CHANGE, (1, 10, "d", None), (3, 10, "u", 3)), "a")
    table.merge(rows(CHANGE, (1, 5, "u", 9), (3, 5, "d", None), (2, 1, "u", 7)), "b")
    assert live(spark, table) == {2: 7, 3: 3}
    table.merge(rows(CHANGE, (1, 11, "c", 4)), "c")
    assert live(spark, table) == {1: 4, 2: 7, 3: 3}


def test_tombstones_end_with_their_retention(spark, keyed, rows):
    table = keyed([(1, 1)], folders=1, retention="2 days")
    table.merge(rows(CHANGE, (1, 10, "d", None)), "a", datetime(2026, 1, 1))
    table.merge(rows(CHANGE, (2, 1, "c", 2)), "b", datetime(2026, 1, 2))
    assert table.state(spark).where("_gone").count() == 1
    table.merge(rows(CHANGE, (2, 2, "u", 3)), "c", datetime(2026, 1, 4))
    assert table.state(spark).where("_gone").count() == 0 and live(spark, table) == {2: 3}


def test_only_touched_folders_are_read_and_written(spark, keyed, rows, tmp_path):
    table = keyed([(i, i) for i in range(40)], folders=8)
    before = versions.current(spark, table.table).places(spark)
    assert len(before) == 8
    table.merge(rows(CHANGE, (7, 1, "u", 70)), "one")
    after = versions.current(spark, table.table).places(spark)
    changed = {folder for folder in before if before[folder] != after[folder]}
    assert len(changed) == 1 and set(after) == set(before)
    touched = table.state(spark).where(f"_folder IN ({changed.pop()})")
    assert "PartitionFilters" in plan(touched) and len({f.rsplit("/", 1)[0] for f in touched.inputFiles()}) == 1
    assert live(spark, table) == {i: 70 if i == 7 else i for i in range(40)}
    assert table.rows(spark).groupBy("id").count().where("count > 1").isEmpty()


def test_repeats_and_unfinished_steps(spark, keyed, rows, monkeypatch):
    table, change = keyed([(1, 1)]), rows(CHANGE, (1, 3, "u", 3), (2, 3, "c", 2))

    def lost(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "publish", lost)
        with pytest.raises(RuntimeError):
            table.merge(change, "a")
    assert live(spark, table) == {1: 1}
    table.merge(change, "a")
    version = versions.current(spark, table.table)
    table.merge(rows(CHANGE, (1, 9, "d", None)), "a")
    assert versions.current(spark, table.table) == version and live(spark, table) == {1: 3, 2: 2}


def test_changes_that_cannot_be_placed_are_named(spark, keyed, rows):
    table = keyed([(1, 1)])
    batch = rows(CHANGE, (None, 1, "u", 1), (1, None, "u", 5), (2, 2, "c", 2), (3, 1, None, 3))
    table.merge(batch, "a")
    assert live(spark, table) == {1: 1, 2: 2, 3: 3}
    assert cdc.unplaced(batch, ["id"], ["lsn"]).count() == 2
    table.merge(rows(CHANGE), "b")
    assert live(spark, table) == {1: 1, 2: 2, 3: 3}


def test_versions_share_the_catalogue_and_forget_old_ones(spark, keyed, rows):
    table = keyed()
    names = []
    for step in range(3):
        table.merge(rows(CHANGE, (step, step, "c", step)), f"s{step}")
        names.append(versions.current(spark, table.table).table)
    assert [spark.catalog.tableExists(n) for n in names] == [False, True, True]


def test_clashing_names_and_tables_of_another_kind(spark, keyed, rows, tmp_path):
    clash = KeyedTable("keyed_clash", str(tmp_path / "c"), ["id"], ["lsn"])
    with pytest.raises(ConfigError):
        clash.create(spark, rows("id BIGINT, _gone BOOLEAN").schema, rows(CHANGE).schema)
    with pytest.raises(ConfigError):
        clash.merge(rows(CHANGE), "a")


def test_several_keys_and_orders_with_odd_names(spark, rows, tmp_path):
    ddl = "`a.b` STRING, `k 2` INT, `day` DATE, n INT, op STRING, v DOUBLE"
    day = datetime(2026, 1, 1).date()
    table = KeyedTable(f"keyed_{uuid.uuid4().hex}", str(tmp_path / "k"), ["a.b", "k 2"], ["day", "n"], 3)
    first = rows(ddl, ("x", 1, day, 1, "c", 1.0), ("x", 1, day, 2, "u", 2.0), ("y", 1, day, 1, "c", 3.0))
    table.create(spark, first.drop("op", "day", "n").schema, first.schema)
    table.merge(first, "a")
    table.merge(rows(ddl, ("x", 1, day, 1, "d", None), ("y", 1, day, 2, "d", None)), "b", few=True)
    assert [tuple(r) for r in table.rows(spark).collect()] == [("x", 1, 2.0)]
