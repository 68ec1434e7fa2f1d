"""Types that grow, versions of a contract, gathered loads, and metered streams."""

import glob
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.operators import contract
from rowferry.operators.widening import changes, grow, join_types, resolve, union_versions
from rowferry.schemas import LONG, TEXT, fields
from rowferry.sinks.gathering import GatheredStage
from rowferry.streaming.schemas import SchemaRegistry
from rowferry.streaming.slots import Slots
from rowferry.streaming.usage import UsageWindows

AT = datetime(2024, 2, 1)


def kind(ddl):
    return T.StructType.fromDDL(f"v {ddl}")["v"].dataType


@pytest.mark.parametrize("a, b, joined", [
    ("INT", "BIGINT", "BIGINT"), ("BIGINT", "DOUBLE", "DOUBLE"), ("FLOAT", "INT", "DOUBLE"), ("VOID", "DATE", "DATE"),
    ("DECIMAL(5,2)", "DECIMAL(4,3)", "DECIMAL(6,3)"), ("BIGINT", "DECIMAL(4,2)", "DECIMAL(21,2)"), ("DECIMAL(38,0)", "DECIMAL(4,2)", "DOUBLE"),
    ("DATE", "TIMESTAMP", "TIMESTAMP"), ("ARRAY<INT>", "ARRAY<DOUBLE>", "ARRAY<DOUBLE>"), ("MAP<STRING,INT>", "MAP<STRING,BIGINT>", "MAP<STRING,BIGINT>"),
    ("STRUCT<a:INT>", "STRUCT<b:STRING,a:DOUBLE>", "STRUCT<a:DOUBLE,b:STRING>"),
    ("STRING", "BIGINT", None), ("BOOLEAN", "INT", None), ("STRUCT<a:INT>", "STRUCT<a:STRING>", None), ("ARRAY<INT>", "INT", None),
])
def test_lattice(spark, a, b, joined):
    assert join_types(kind(a), kind(b)) == (joined and kind(joined))
    back = join_types(kind(b), kind(a))
    assert (back and sorted(back.simpleString())) == (joined and sorted(kind(joined).simpleString()))


def test_growth_keeps_what_does_not_join():
    known = fields(a=LONG, b=TEXT)
    seen = [T.StructField("a", TEXT), T.StructField("a", T.DoubleType()), T.StructField("z", LONG), T.StructField("z", TEXT), T.StructField("c", T.NullType())]
    assert grow(known, seen, add=False, types=True).simpleString() == "struct<a:double,b:string>"
    assert grow(known, seen, add=True, types=False).simpleString() == "struct<a:bigint,b:string,c:string,z:string>"
    assert changes(known, fields(a=T.DoubleType(), c=TEXT)) == [
        ("b", "dropped", "string", None), ("a", "type_changed", "bigint", "double"), ("c", "added", None, "string")]


def test_one_word_does_not_keep_fractions_out(rows):
    lines = rows("j STRING", ('{"a":1.5}',), ('{"a":"x"}',), ('{"a":null,"new":[1]}',), ("{broken",), (None,), ("",), ('{"a":7}',))
    assert contract.grown(lines, "j", fields(a=LONG), add=False, types=True).simpleString() == "struct<a:double>"
    assert contract.grown(lines, "j", fields(a=LONG), add=True, types=False).simpleString() == "struct<a:bigint,new:array<bigint>>"
    assert contract.grown(lines.limit(0), "j", fields(a=LONG), add=True, types=True) == fields(a=LONG)


def test_old_rows_under_a_newer_schema(rows):
    old = rows("id INT, s STRUCT<a:INT>, l ARRAY<STRUCT<x:INT>>, m MAP<STRING,INT>", (1, (2,), [(3,), None], {"k": 4}), (None, None, None, None))
    new = rows("id BIGINT, s STRUCT<b:STRING,a:DOUBLE>, l ARRAY<STRUCT<x:DOUBLE,y:INT>>, m MAP<STRING,DOUBLE>, t DATE", (9, ("w", 0.5), [], {}, None))
    both = union_versions([old, new]).orderBy(F.col("id").asc_nulls_last()).collect()
    assert both[0].id == 1 and both[0].s.a == 2.0 and both[0].s.b is None and both[0].l[0].x == 3.0 and both[0].l[1] is None and both[0].m == {"k": 4.0}
    assert both[1].s.b == "w" and tuple(both[2]) == (None, None, None, None, None)
    assert resolve(old, new.schema).schema.simpleString() == new.schema.simpleString()
    with pytest.raises(ValueError):
        union_versions([old.select("id"), rows("id STRING", ("x",))])


def test_registry(spark, tmp_path):
    registry = SchemaRegistry(str(tmp_path / "schema"))
    assert registry.newest(spark) is None and registry.history(spark).count() == 0
    assert [registry.add(spark, s, n, AT) for n, s in enumerate([fields(a=LONG), fields(a=LONG), fields(a=T.DoubleType(), b=TEXT)])] == [1, 1, 2]
    assert registry.newest(spark) == (2, fields(a=T.DoubleType(), b=TEXT))
    told = sorted((r.version, r.first_batch, r.field, r.change, r.after) for r in registry.history(spark).collect())
    assert told == [(1, 0, "a", "added", "bigint"), (2, 2, "a", "type_changed", "double"), (2, 2, "b", "added", "string")]


def test_slots_survive_a_repeat_and_a_lost_folder(spark, tmp_path):
    slots = Slots(str(tmp_path / "state"), fields(v=LONG))
    assert slots.before(spark) is None
    for batch in (0, 1, 4):
        slots.save(spark, batch, batch * 10)
    assert slots.before(spark).v == 40 and slots.before(spark, 4).v == 10
    slots.save(spark, 4, 41)
    assert slots.before(spark).v == 41 and slots.before(spark, 4).v == 10
    (lost,) = [p for p in glob.glob(str(tmp_path / "state" / "*" / "part-*")) if '"batch_id":4' in open(p).read()]
    os.remove(lost)
    assert slots.before(spark).v == 10


def test_groups_are_sealed_by_size_or_age_and_repeats_add_nothing(spark, rows, tmp_path):
    stage = GatheredStage(str(tmp_path / "load"), target_mb=50, max_age=timedelta(seconds=60))

    def batch(n):
        return rows("id BIGINT, `group` STRING", (n, "g"), (n, None))

    def seen(after=-1):
        return sorted(r.id for r in stage.rows(spark, schema, after).collect())

    schema = batch(0).schema
    assert seen() == [] and not stage.flush(spark, AT)
    for n, seconds in ((0, 0), (1, 30), (1, 30)):
        stage.add(batch(n), n, AT + timedelta(seconds=seconds))
    assert seen() == []
    stage.add(batch(3), 3, AT + timedelta(seconds=61))
    assert seen() == [0, 0, 1, 1, 3, 3]
    stage.add(batch(3), 3, AT + timedelta(seconds=70))  # a crash after the seal, before the ledger
    assert seen() == [0, 0, 1, 1, 3, 3] and stage.seals(spark).first().parts == 3
    stage.add(batch(4), 4, AT + timedelta(seconds=71))
    assert seen(after=0) == [] and stage.flush(spark, AT) and not stage.flush(spark, AT)
    assert seen(after=0) == [4, 4] and len(seen()) == 8
    tiny = GatheredStage(str(tmp_path / "tiny"), target_mb=0.0001)
    for n in range(3):
        tiny.add(batch(n), n, AT)
    assert sorted((r.group, r.place, r.parts) for r in tiny.seals(spark).collect()) == [(n, "open", 1) for n in range(3)]
    assert tiny.rows(spark, schema).count() == 6
    tiny.add(batch(5).limit(0), 5, AT)
    assert tiny.rows(spark, schema).count() == 6


def test_gathered_files_are_few(spark, tmp_path):
    stage = GatheredStage(str(tmp_path / "load"))
    for n in range(4):
        stage.add(spark.range(n * 100, n * 100 + 100, numPartitions=8), n, AT)
    stage.flush(spark, AT)
    assert len(glob.glob(str(tmp_path / "load" / "staged" / "*" / "part-*.parquet"))) == 1
    assert stage.rows(spark, spark.range(1).schema).distinct().count() == 400


def test_late_rows_are_counted_apart(spark, rows, tmp_path):
    usage = UsageWindows(str(tmp_path / "usage"), timedelta(hours=1), timedelta(minutes=30))

    def at(hour, minute=0):
        return datetime(2024, 1, 1, hour, minute)

    ddl = "p STRING, ts TIMESTAMP_NTZ, n INT"
    usage.add(rows(ddl, ("a", at(1), 5), ("a", at(1, 59), None), ("b", at(3), 7), (None, at(3), 1), ("a", None, 2)), 0, "p", "ts", F.col("n"))
    second = rows(ddl, ("a", at(1, 30), 11), ("a", at(2, 10), 13), ("b", at(5), 1))
    for _ in range(2):  # a repeat finds the watermark it had
        usage.add(second, 1, "p", "ts", F.col("n"))
    usage.add(second.limit(0), 2, "p", "ts", F.col("n"))
    found = {(r.pipeline_id, r.start and r.start.hour): r for r in usage.windows(spark, at(6)).collect()}
    # The newest time of batch 0 is 3:00, so the watermark is 2:30: the hour from 1:00 is over, that from 2:00 is not.
    told = {key: (r.records, r.bytes, r.late_records, r.late_bytes, r.closed) for key, r in found.items()}
    assert told == {
        ("a", 1): (2, 5, 1, 11, True), ("a", 2): (1, 13, 0, 0, True), ("b", 3): (1, 7, 0, 0, True), (None, 3): (1, 1, 0, 0, True),
        ("a", None): (1, 2, 0, 0, False), ("b", 5): (1, 1, 0, 0, False),
    }
    assert found[("b", 5)].lag_seconds == 3600 and found[("a", None)].lag_seconds is None
    with pytest.raises(ValueError):
        UsageWindows("x", timedelta(0))
