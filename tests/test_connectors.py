import glob
from datetime import datetime

import pytest
from plans import exchanges, plan
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.config import Connector
from rowferry.errors import ConfigError, ConnectorMissing
from rowferry.operators import cdc, payloads, routing
from rowferry.operators.routing import Rule
from rowferry.schemas import LONG, TEXT, fields
from rowferry.sinks import files as sinks
from rowferry.sinks import jdbc
from rowferry.sinks import tables as catalogue
from rowferry.sources import broker, files, lines, pulls, tables
from rowferry.sources.changes import parse_changes
from rowferry.sources.lines import clean_lines


def test_lines_from_compressed_files(spark, rows, tmp_path):
    rows("v STRING", ("  a ",), ("",), ("   ",), ("b",)).write.option("compression", "gzip").text(str(tmp_path / "z"))
    assert sorted(r.raw_json for r in lines.read_lines(spark, str(tmp_path / "z")).collect()) == ["a", "b"]


RAW = ("topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, key BINARY, value BINARY, "
       "headers ARRAY<STRUCT<key: STRING, value: BINARY>>")


def test_envelope_keeps_nulls_and_last_header(rows):
    at = datetime(2024, 1, 1, 0, 0, 0, 1999)
    df = rows(RAW, ("t", 1, 5, at, None, None, None), ("t", 1, 6, at, b"k", b"a\xffb", [("h", b"1"), ("g", b"2"), ("h", b"3")]))
    first, second = broker.broker_envelope(df).collect()
    assert first[3:] == (1704067200001, None, None, "{}")
    assert second.value == "a�b" and second.headers == '{"g":"2","h":"3"}'


def test_kafka_options_and_missing_package(spark):
    source = Connector("kafka", {"bootstrap_servers": "h:1", "topics": "a, b", "group_id": "g", "sasl_username": "u"}, {"sasl_password": "p"})
    options = broker.kafka_options(source)
    assert options["subscribe"] == "a,b" and options["startingOffsets"] == "latest" and options["kafka.group.id"] == "g"
    assert 'username="u" password="p"' in options["kafka.sasl.jaas.config"]
    with pytest.raises(ConnectorMissing):
        broker.read_kafka(spark, source)
    with pytest.raises(ConfigError):
        broker.kafka_options(Connector("kafka", {"topics": "a"}))
    with pytest.raises(ConfigError):
        broker.kafka_options(Connector("kafka", {"topics": "a", "bootstrap_servers": "h", "auto_offset_reset": "middle"}))


def test_cursor_text_and_back(rows):
    df = rows("topic STRING, partition BIGINT, offset BIGINT", ("a", 1, 7), ("a", 0, 10), ("a", 0, 3), ("b", 0, 1))
    found = {r.topic: (r.cursor, r.records_since_last) for r in broker.offset_cursor(df).collect()}
    assert found == {"a": ("0:10,1:7", 3), "b": ("0:1", 1)}
    parsed = broker.parse_cursor(rows("topic STRING, cursor STRING", ("a", "0:10, 1:7,x:1,2,3:y,4:5:6")))
    assert sorted(tuple(r) for r in parsed.collect()) == [("a", 0, 10), ("a", 1, 7)]


def test_resume_does_not_shuffle_the_records(spark, rows, tmp_path):
    rows("topic STRING, partition BIGINT, offset BIGINT", ("a", 0, 1), ("a", 0, 2), ("b", 0, 1)).write.parquet(str(tmp_path / "r"))
    records = spark.read.parquet(str(tmp_path / "r"))
    resumed = broker.resume_after(records, rows("topic STRING, cursor STRING", ("a", "0:1")))
    assert "BroadcastHashJoin" in plan(resumed)
    assert sorted(tuple(r) for r in resumed.collect()) == [("a", 0, 2), ("b", 0, 1)]


def test_each_file_is_read_once(spark, rows, tmp_path):
    root, ledger = str(tmp_path / "in"), str(tmp_path / "ledger")
    schema, empty = fields(id=LONG), spark.createDataFrame([], files.LEDGER_SCHEMA)
    rows("id BIGINT", (1,)).write.parquet(root)
    first, read = files.read_new_files(spark, root, "parquet", empty, schema, "*.parquet")
    assert [r.id for r in first.collect()] == [1]
    files.mark_read(read, ledger)
    rows("id BIGINT", (2,)).write.mode("append").parquet(root)
    again, read = files.read_new_files(spark, root, "parquet", spark.read.parquet(ledger), schema, "*.parquet")
    assert [r.id for r in again.collect()] == [2]
    files.mark_read(read, ledger)
    none, _ = files.read_new_files(spark, root, "parquet", spark.read.parquet(ledger), schema, "*.parquet")
    assert none.count() == 0


def test_a_bound_on_files_leaves_the_rest_to_later_calls(spark, tmp_path):
    root, ledger = str(tmp_path / "in"), str(tmp_path / "ledger")
    spark.range(50).toDF("id").repartition(5).write.parquet(root)
    spark.createDataFrame([], files.LEDGER_SCHEMA).write.parquet(ledger)
    seen, calls = [], 0
    while True:
        rows, read = files.read_new_files(
            spark, root, "parquet", spark.read.parquet(ledger), fields(id=LONG), "*.parquet", max_files=2)
        if read.isEmpty():
            break
        assert read.count() <= 2
        seen += [r.id for r in rows.collect()]
        files.mark_read(read, ledger)
        calls += 1
    assert calls == 3 and sorted(seen) == list(range(50))


def test_pull_reaches_the_scan(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    text = plan(pulls.pull_since(events, "ts", datetime(2024, 1, 15)).select("event_id"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts" in text and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text
    top = pulls.pull_after(events.select("event_id"), "event_id", 5, 3)
    assert "TakeOrderedAndProject" in plan(top) and exchanges(top) == 0


def test_times_without_a_zone_are_utc(spark, rows, monkeypatch):
    import time

    from rowferry.functions.casts import constant

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        at = datetime(2024, 1, 15, 6, 30, 0, 5)
        for kind in (T.TimestampType(), T.TimestampNTZType()):
            found = spark.range(1).select(constant(at, kind).cast("string").alias("t")).first().t
            assert found == "2024-01-15 06:30:00.000005"
    finally:
        monkeypatch.undo()
        time.tzset()


def test_cursors(spark, rows, tmp_path):
    df = rows("ts BIGINT", (5,), (9,))
    assert pulls.next_cursor(pulls.pull_since(df, "ts", 6), "ts", 6).first().cursor == 9
    assert pulls.next_cursor(pulls.pull_since(df, "ts", 9), "ts", 9).first().cursor == 9
    path = str(tmp_path / "cursor")
    assert pulls.load_cursor(spark, path, "p") is None
    pulls.save_cursor(spark, path, "p", "1", datetime(2024, 1, 1), 3)
    pulls.save_cursor(spark, path, "p", "2", datetime(2024, 1, 2), 3)
    assert pulls.load_cursor(spark, path, "p") == "2" and pulls.load_cursor(spark, path, "q") is None


def test_lines_lose_white_space_of_any_kind(rows):
    df = rows("raw_json STRING", ("\t \r",), ("\u3000{}\u00a0",), ("\x0b",))
    assert [r.raw_json for r in clean_lines(df).collect()] == ["{}"]


def test_partitioned_text_keeps_microseconds(spark, rows, tmp_path):
    df = rows("k STRING, at STRING", ("a", "2024-01-15 06:30:00.123456")).withColumn("at", F.col("at").cast("timestamp"))
    for fmt in ("json", "csv"):
        sinks.write_partitioned(df, str(tmp_path / fmt), ["k"], fmt)
        assert ".123456" in spark.read.text(str(tmp_path / fmt)).first()[0]


def test_pages_that_are_no_array(rows):
    df = rows("page INT, body STRING", (1, '[{"id":1},{"id":2}]'), (2, '{"id":3}'), (3, "oops"), (4, "[]"), (5, None))
    items, refused = pulls.explode_pages(df, "body", fields(id=LONG))
    assert sorted(tuple(r) for r in items.collect()) == [(1, 0, 1), (1, 1, 2)]
    assert sorted(r.page for r in refused.collect()) == [2, 3, 5]


def test_change_images(rows):
    df = rows("j STRING", ('{"op":"u","before":{"id":1,"v":"a"},"after":{"id":1,"v":"b"},"lsn":3,"ts":"t"}',),
              ('{"op":"d","before":{"id":2,"v":"c"},"lsn":4}',))
    assert [tuple(r) for r in parse_changes(df, "j", fields(id=LONG, v=TEXT)).collect()] == [(3, "t", "u", 1, "b", []), (4, None, "d", 2, "c", [])]


def test_faults_of_changes(rows):
    df = rows("j STRING", ('{"op":"d","key":{"id":7,"b":"x"},"lsn":1}',), ('{"op":"d","key":"8","lsn":2}',), ('{"op":"d","key":"q","lsn":3}',),
              ('{"op":"u","lsn":4}',), ('{"op":"z","after":{"id":1},"lsn":5}',), ('{"op":"u","after":{"id":1}}',), ("{",), (None,),
              ('{"op":"c","after":{"v":"x"},"lsn":6}',))
    found = [(r.id, r["_errors"]) for r in parse_changes(df, "j", fields(id=LONG, v=TEXT)).collect()]
    assert found[:2] == [(7, []), (8, [])]
    assert [e for _, e in found[2:]] == [["missing:id"], ["missing:after"], ["type:op"], ["missing:lsn"], ["corrupt"], ["corrupt"], ["missing:id"]]
    two = parse_changes(df.limit(1), "j", fields(v=TEXT, id=LONG, b=TEXT), keys=["id", "b"]).first()
    assert (two.id, two.b, two.v, two["_errors"]) == (7, "x", None, [])


def test_faults_of_page_items(rows):
    df = rows("page INT, body STRING, pos INT", (1, '{"data":[{"id":1},{"id":"x"},3,null]}', 9), (2, '{"data":{}}', 9), (3, None, 9), (4, '{"data":[]}', 9))
    found = pulls.page_items(df, "body", fields(id=LONG), "data").orderBy("page", "pos").collect()
    assert [(r.page, r.pos, r.id, list(r["_errors"]), r["_raw"]) for r in found] == [
        (1, 0, 1, [], '{"id":1}'), (1, 1, None, ["type:id"], '{"id":"x"}'), (1, 2, None, ["corrupt"], "3"), (1, 3, None, ["corrupt"], None),
        (2, None, None, ["corrupt"], '{"data":{}}'), (3, None, None, ["corrupt"], None)]


def test_trims_are_only_for_lines_that_need_them(rows):
    found = clean_lines(rows("raw_json STRING", ("{}",), (" x",), ("x\u2003",), ("\u00a0é\t",), ("é",), ("\u3000",), ("",), (None,)))
    assert [r.raw_json for r in found.collect()] == ["{}", "x", "x", "é", "é"]


def test_first_rule_wins(rows):
    rules = [Rule("k", "=", "a", "one"), Rule("k", "regex", "^[ab]", "two")]
    df = rows("k STRING", ("a",), ("b",), ("c",), (None,))
    assert [r.target_table for r in routing.route(df, rules).collect()] == ["one", "two", None, None]
    assert [r.target_table for r in routing.route(df, rules, "rest").collect()] == ["one", "two", "rest", "rest"]
    with pytest.raises(ConfigError):
        routing.route(df, [Rule("k", "~", "a", "x")])


def test_compaction_makes_few_files(spark, tmp_path):
    small, large = str(tmp_path / "s"), str(tmp_path / "l")
    spark.range(1000).toDF("id").repartition(20).write.parquet(small)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    sinks.compact(spark, small, large)
    assert len(glob.glob(f"{large}/*.parquet")) == 1 and spark.read.parquet(large).count() == 1000
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_compaction_keeps_folders(spark, tmp_path):
    small, large = str(tmp_path / "s"), str(tmp_path / "l")
    df = spark.range(1000).selectExpr("id", "id % 3 AS k")
    df.repartition(8).write.partitionBy("k").parquet(small)
    sinks.compact(spark, small, large, partition_keys=["k"])
    assert sorted(len(glob.glob(f"{large}/k={k}/*.parquet")) for k in range(3)) == [1, 1, 1]
    spark.sql("DROP TABLE IF EXISTS swap_test")
    spark.sql(f"CREATE TABLE swap_test (id BIGINT) USING parquet LOCATION '{small}/k=0'")
    catalogue.swap_location(spark, "swap_test", f"{large}/k=0")
    assert spark.table("swap_test").count() == 334


def test_partitions_are_replaced_one_by_one(spark, rows, tmp_path):
    root = str(tmp_path)
    sinks.write_partitioned(rows("id INT, k STRING", (1, "a"), (2, "b")), root, ["k"])
    sinks.write_partitioned(rows("id INT, k STRING", (9, "b")), root, ["k"], replace_partitions=True)
    assert sorted(tuple(r) for r in spark.read.parquet(root).collect()) == [(1, "a"), (9, "b")]


def test_a_hot_folder_is_written_by_several_tasks(spark, tmp_path):
    from rowferry.session import ADVISORY_SIZE, sql_settings

    df = spark.range(200_000).selectExpr("id", "sha2(CAST(id AS STRING), 256) AS body", "CASE WHEN id % 10 < 7 THEN 'hot' ELSE CAST(id % 10 AS STRING) END AS k")
    with sql_settings(spark, {ADVISORY_SIZE: 1024 * 1024}):
        sinks.write_partitioned(df.repartition(8), str(tmp_path), ["k"])
    assert len(glob.glob(f"{tmp_path}/k=hot/*.parquet")) > 2 and spark.read.parquet(str(tmp_path)).count() == 200_000


def test_json_keeps_microseconds(spark, rows, tmp_path):
    df = rows("a TIMESTAMP, b TIMESTAMP_NTZ", (datetime(2024, 1, 1, 1, 2, 3, 456789), datetime(2024, 1, 1, 1, 2, 3, 456789)))
    sinks.write_ndjson(df, str(tmp_path / "j"))
    assert spark.read.schema(df.schema).json(str(tmp_path / "j")).collect() == df.collect()
    assert '"b":"2024-01-01T01:02:03.456789"' in payloads.kv_payload(df, "a", ["b"], 1).first().value


def test_relational_statements():
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField('od"d', T.StringType()), T.StructField("d", T.DecimalType(10, 2)),
        T.StructField("t", T.TimestampType()), T.StructField("day", T.DateType()), T.StructField("ok", T.BooleanType()),
        T.StructField("x", T.DoubleType()), T.StructField("n", fields(k=LONG)),
    ])
    assert jdbc.create_table_sql(schema, "s.t", ["id"]) == (
        'CREATE TABLE IF NOT EXISTS s.t ("id" BIGINT, "od""d" TEXT, "d" NUMERIC(10,2), "t" TIMESTAMP WITH TIME ZONE, '
        '"day" DATE, "ok" BOOLEAN, "x" DOUBLE PRECISION, "n" TEXT, PRIMARY KEY ("id"))')
    assert jdbc.upsert_sql(["id", "v"], "t", "s", ["id"]).endswith('ON CONFLICT ("id") DO UPDATE SET "v" = EXCLUDED."v"')
    assert jdbc.upsert_sql(["id"], "t", "s", ["id"]).endswith('ON CONFLICT ("id") DO NOTHING')


def test_relational_shape(rows):
    df = rows("id INT, n STRUCT<k: INT>", (1, (2,)))
    assert jdbc.relational_shape(df).first() == (1, '{"k":2}')


def test_relational_read_options():
    options = tables.jdbc_read_options("jdbc:x", "t", "id", (0, 100), 4)
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("id", "0", "100", "4")
    with pytest.raises(ConfigError):
        tables.jdbc_read_options("jdbc:x", "t", "id", (0, 1), 0)


def test_broker_headers(rows):
    made = payloads.to_broker(rows("k INT, t STRING", (1, "x")), "k", "t", ["k"], {"origin": F.lit("here")}).first()
    assert (made.topic, made.key, made.value) == ("x", "1", '{"k":1}') and made.headers[0]["value"] == b"here"


def test_tombstone_is_a_delete(rows):
    df = rows("topic STRING, key STRING, value STRING, offset BIGINT", ("t", "a", "1", 1), ("t", "a", None, 2), ("t", None, "x", 3))
    assert [r.op for r in cdc.latest(cdc.broker_changes(df), ["topic", "key"], ["lsn"]).collect()] == ["d"]


def test_staged_load_splits_by_rows(spark, tmp_path):
    sinks.stage_parquet(spark.range(100).toDF("id"), str(tmp_path / "p"), rows_per_file=30)
    assert spark.read.parquet(str(tmp_path / "p")).count() == 100 and len(glob.glob(f"{tmp_path}/p/*.parquet")) >= 4
