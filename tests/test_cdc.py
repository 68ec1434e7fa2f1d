import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from plans import exchanges, plan

from rowferry.operators import cdc, payloads
from rowferry.operators.numbering import broadcast_if_small, number_rows
from rowferry.sinks import tables
from rowferry.sources.changes import snapshot_plus_changes
from rowferry.sources.pulls import pull_page
from rowferry.sources import pulls

CHANGE = "id INT, lsn BIGINT, op STRING, amount INT"


def applied(target, changes):
    """What the changes do to the target, one after the other."""
    state = dict(target)
    for key, _, op, amount in sorted(changes, key=lambda c: c[1]):
        if op == "d":
            state.pop(key, None)
        else:
            state[key] = amount
    return state


feeds = st.lists(st.tuples(st.integers(0, 6), st.sampled_from("cud"), st.one_of(st.none(), st.integers(0, 9))), max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(feeds, st.dictionaries(st.integers(0, 9), st.integers(0, 9), max_size=6))
def test_merges_do_what_the_changes_say(spark, feed, start):
    changes = [(k, i, op, a) for i, (k, op, a) in enumerate(feed)]
    random.shuffle(changes)
    target = spark.createDataFrame(list(start.items()), "id INT, amount INT")
    df = spark.createDataFrame(changes, CHANGE)
    wanted = applied(start, changes)
    for merge in (cdc.merge, cdc.merge_few):
        once = merge(target, df, ["id"], ["lsn"])
        assert {r.id: r.amount for r in once.collect()} == wanted
        assert {r.id: r.amount for r in merge(once, df, ["id"], ["lsn"]).collect()} == wanted


def test_latest_is_one_row_of_the_input(rows):
    data = [(1, 5, "u", None), (1, 9, "d", 3), (1, 7, "u", 8), (2, 1, "c", None)]
    found = {tuple(r) for r in cdc.latest(rows(CHANGE, *data), ["id"], ["lsn"]).collect()}
    assert found == {(1, 9, "d", 3), (2, 1, "c", None)}
    numbers = rows("id INT, lsn BIGINT, amount INT", (1, 5, 1), (1, 9, None))
    assert cdc.latest(numbers, ["id"], ["lsn"]).collect() == [(1, 9, None)]


def test_ties_go_to_the_second_column(rows):
    df = rows("id INT, lsn BIGINT, n INT, v STRING", (1, 5, 1, "a"), (1, 5, 2, "b"), (1, 4, 9, "c"))
    assert cdc.latest(df, ["id"], ["lsn", "n"]).first().v == "b"


def test_fixed_width_rows_aggregate_by_hashing(rows):
    df = rows("id INT, lsn BIGINT, amount INT", (1, 5, 1))
    text = plan(cdc.latest(df, ["id"], ["lsn"]))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_hot_key_combines_before_the_shuffle(rows):
    text = plan(cdc.latest(rows(CHANGE, (1, 5, "u", 1)), ["id"], ["lsn"]))
    assert text.index("partial_max_by") and "Window" not in text


def test_a_key_with_a_third_of_the_rows(spark):
    n = 30_000
    df = spark.range(n).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS id", "id AS lsn", "'u' AS op", "CAST(id AS INT) AS amount")
    newest = cdc.latest(df, ["id"], ["lsn"])
    assert newest.count() == n - n // 3 + 1 and newest.where("id = 0").first().lsn == n - 3
    assert cdc.dedup(df, ["id"]).count() == n - n // 3 + 1
    numbered = number_rows(df.repartition(6), ["id"], "at")
    assert numbered.selectExpr("count(DISTINCT at)", "min(at)", "max(at)").first() == (n, 0, n - 1)
    ranges = numbered.where("id = 0").selectExpr("min(at)", "max(at)").first()
    assert tuple(ranges) == (0, n // 3 - 1)


def test_bucketed_target_is_not_shuffled(spark, rows, tmp_path):
    spark.sql("DROP TABLE IF EXISTS bucket_test")
    target = rows("id INT, amount INT", *[(i, i) for i in range(50)])
    tables.create_target(target, "bucket_test", str(tmp_path / "b"), keys=["id"], buckets=4)
    target.write.insertInto("bucket_test")
    merged = cdc.merge(spark.table("bucket_test"), rows(CHANGE, (1, 1, "d", None)), ["id"], ["lsn"])
    assert merged.count() == 49 and exchanges(merged) == 1


def test_few_changes_leave_the_target_unshuffled(spark, rows, tmp_path):
    rows("id INT, amount INT", *[(i, i) for i in range(50)]).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    merged = cdc.merge_few(target, rows(CHANGE, (1, 1, "d", None), (99, 2, "c", 5)), ["id"], ["lsn"])
    assert merged.count() == 50 and "BroadcastHashJoin" in plan(merged) and exchanges(merged) == 0


def test_snapshot_handover_has_no_duplicates(rows):
    snapshot = rows("id INT, amount INT", (1, 10), (2, 20))
    changes = rows(CHANGE, (1, 4, "u", 99), (2, 6, "d", None), (3, 7, "c", 30))
    feed = snapshot_plus_changes(snapshot, changes, 5)
    assert {tuple(r) for r in cdc.current_state(feed, ["id"], ["lsn"]).collect()} == {(1, 10), (3, 30)}


def test_dedup_by_key_and_by_row(rows):
    df = rows("id INT, v STRING", (1, "a"), (1, "a"), (2, "b"))
    assert cdc.dedup(df, ["id"]).count() == cdc.dedup(df).count() == 2


@pytest.mark.parametrize("values", [list(range(100)), [7] * 60 + list(range(40)), [1], []])
def test_numbers_are_dense_and_in_order(spark, values):
    random.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v INT").repartition(5)
    numbered = sorted((r.at, r.v) for r in number_rows(df, ["v"], "at").collect())
    assert [n for n, _ in numbered] == list(range(len(values))) and [v for _, v in numbered] == sorted(values)


def test_near_and_far_pages_agree(spark, monkeypatch):
    df = spark.range(1000).toDF("id").repartition(4)
    near = [r.id for r in pull_page(df, ["id"], 7, 30).orderBy("id").collect()]
    monkeypatch.setattr(pulls, "TOP_K_ROWS", 0)
    assert near == [r.id for r in pull_page(df, ["id"], 7, 30).orderBy("id").collect()] == list(range(210, 240))


def test_broadcast_is_bounded(rows):
    df = rows("a INT", (1,), (2,))
    assert broadcast_if_small(df, 1) is df and broadcast_if_small(df, 2) is not df


def test_chunks_hold_every_row_once(spark):
    df = spark.range(103).toDF("id").repartition(3)
    ordered = payloads.chunk_in_order(df, ["id"], 10).orderBy("chunk_id").collect()
    assert [r.n for r in ordered] == [10] * 10 + [3] and ordered[0].payload.startswith('[{"id":0},{"id":1}')
    assert exchanges(payloads.chunk(spark.range(9).toDF("id"), 4)) == 0
    free = payloads.chunk(df, 10).collect()
    assert sum(r.n for r in free) == 103 and max(r.n for r in free) == 10 and len({r.chunk_id for r in free}) == len(free)


def test_vector_of_another_size_is_refused(rows):
    df = rows("id INT, v ARRAY<FLOAT>, m STRING", (1, [1.0, 2.0], "x"), (2, [1.0], "y"), (3, None, "z"))
    made = payloads.vector_payload(df, "id", "v", ["m"], 2).collect()
    assert [list(r["_errors"]) for r in made] == [[], ["type:v"], ["type:v"]]
    assert made[0].payload == '{"id":"1","values":[1.0,2.0],"metadata":{"m":"x"}}'
