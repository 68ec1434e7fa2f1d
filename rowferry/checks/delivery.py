"""Queries on sinks, routing, payloads and change apply."""

from __future__ import annotations

import uuid

from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.checks import fixtures as fx
from rowferry.checks.intake import CHANGES_SQL
from rowferry.checks.registry import check
from rowferry.formats.serialise import receipt
from rowferry.operators import cdc, payloads, routing
from rowferry.operators.routing import TARGET, Rule
from rowferry.session import staging_path
from rowferry.sinks import files, plugin, tables
from rowferry.sinks.appends import AppendTable
from rowferry.sinks.keyed import KeyedTable
from rowferry.sources import broker
from rowferry.sources.changes import snapshot_plus_changes
from rowferry.sources.tables import read_table

_EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"

RULES = [
    Rule("event_type", "=", "signup", "users_table"),
    Rule("event_type", "=", "purchase", "sales_table"),
    Rule("event_type", "regex", "^(click|view)$", "web_table"),
]

_TARGET_SQL = """CASE WHEN event_type = 'signup' THEN 'users_table' WHEN event_type = 'purchase' THEN 'sales_table'
  WHEN event_type IN ('click', 'view') THEN 'web_table' ELSE 'other_table' END"""


@check("sink_ndjson_roundtrip", _EVENTS_SQL)
def sink_ndjson_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    events, path = fx.table(spark, sf, "events"), staging_path(spark, "ndjson")
    files.write_ndjson(events, path)
    return spark.read.schema(events.schema).json(path)


@check("sink_csv_roundtrip", _EVENTS_SQL)
def sink_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    events, path = fx.table(spark, sf, "events"), staging_path(spark, "csv")
    files.write_csv(events, path, escape='"')
    return spark.read.schema(events.schema).options(header=True, escape='"').csv(path)


@check("sink_stage_parquet", _EVENTS_SQL)
def sink_stage_parquet(spark: SparkSession, sf: str) -> DataFrame:
    events, path = fx.table(spark, sf, "events"), staging_path(spark, "load")
    files.stage_parquet(events, path)
    return spark.read.schema(events.schema).parquet(path)


@check("compact_rows", _EVENTS_SQL)
def compact_rows(spark: SparkSession, sf: str) -> DataFrame:
    events, small, large = fx.table(spark, sf, "events"), staging_path(spark, "small"), staging_path(spark, "large")
    events.repartition(16).write.parquet(small)
    files.compact(spark, small, large)
    return spark.read.schema(events.schema).parquet(large)


@check("sink_hive_partitions", """
SELECT event_type, CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month, CAST(day(ts) AS BIGINT) AS day,
  count(*) AS n FROM events GROUP BY ALL""")
def sink_hive_partitions(spark: SparkSession, sf: str) -> DataFrame:
    path, keys = staging_path(spark, "hive"), ["event_type", "year", "month", "day"]
    files.write_partitioned(files.date_parts(fx.table(spark, sf, "events"), "ts"), path, keys)
    whole = [F.col(k).cast("bigint").alias(k) for k in keys[1:]]
    return spark.read.parquet(path).groupBy("event_type", *whole).agg(F.count("*").alias("n"))


@check("route_events", f"SELECT event_id, {_TARGET_SQL} AS target_table FROM events")
def route_events(spark: SparkSession, sf: str) -> DataFrame:
    return routing.route(fx.table(spark, sf, "events"), RULES, "other_table").select("event_id", TARGET)


@check("fanout_counts", f"SELECT {_TARGET_SQL} AS target_table, count(*) AS n FROM events GROUP BY 1")
def fanout_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = staging_path(spark, "routed")
    files.write_routed(routing.route(fx.table(spark, sf, "events"), RULES, "other_table"), path)
    return spark.read.parquet(path).groupBy(TARGET).agg(F.count("*").alias("n"))


@check("fanout_systems", f"SELECT event_id, {_TARGET_SQL} AS target_table FROM events WHERE event_type <> 'error'")
def fanout_systems(spark: SparkSession, sf: str) -> DataFrame:
    """One write per declared target, the input read once; rows without a target go nowhere."""
    root, targets = staging_path(spark, "systems"), [r.target_table for r in RULES]
    routed = routing.route(fx.table(spark, sf, "events").select("event_id", "event_type"), RULES)
    files.fanout(routed, targets, lambda target, rows: rows.write.parquet(f"{root}/{TARGET}={target}"))
    return spark.read.parquet(root).select("event_id", TARGET)


@check("sink_broker_shape", """
SELECT event_type AS topic, CAST(user_id AS VARCHAR) AS key,
  CAST(to_json({'event_id': event_id, 'event_type': event_type, 'value': value}) AS VARCHAR) AS value FROM events""")
def sink_broker_shape(spark: SparkSession, sf: str) -> DataFrame:
    return payloads.to_broker(fx.table(spark, sf, "events"), "user_id", "event_type", ["event_id", "event_type", "value"])


@check("bulk_chunks", """
WITH r AS (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 25 AS chunk_id FROM events)
SELECT chunk_id, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM r GROUP BY chunk_id""")
def bulk_chunks(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "events").select("event_id", "event_type")
    chunks = payloads.chunk_in_order(rows, ["event_id"], payloads.REQUEST_SIZES["dynamodb"])
    return chunks.select("chunk_id", "n", F.col("first").alias("first_id"), F.col("last").alias("last_id"))


@check("bulk_payload_items", "SELECT event_id, event_type, true AS within_size FROM events")
def bulk_payload_items(spark: SparkSession, sf: str) -> DataFrame:
    """Requests in no given order, opened again: nothing lost, nothing twice, none too large."""
    rows = fx.table(spark, sf, "events").select("event_id", "event_type")
    size = payloads.REQUEST_SIZES["kinesis"]
    items = F.from_json("payload", "array<struct<event_id: bigint, event_type: string>>")
    opened = payloads.chunk(rows, size).select((F.col("n") <= size).alias("within_size"), F.explode(items).alias("i"))
    return opened.select("i.event_id", "i.event_type", "within_size")


@check("bulk_index_lines", """
SELECT c_custkey AS id, CAST(0 AS BIGINT) AS line_no, '{"index":{"_index":"customer","_id":"' || c_custkey || '"}}' AS line FROM customer
UNION ALL
SELECT c_custkey, 1, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}' FROM customer""")
def bulk_index_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return payloads.bulk_lines(rows, "customer", "c_custkey").withColumn("line_no", F.col("line_no").cast("bigint"))


@check("vector_payload", """
SELECT vec_id, CAST(len(embedding) AS BIGINT) AS dim, label, true AS values_kept, len(embedding) <> 64 AS refused FROM embeddings""")
def vector_payload(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "embeddings")
    shaped = payloads.vector_payload(rows, "vec_id", "embedding", ["label"], dimension=64)
    body = F.from_json("payload", "id string, values array<float>, metadata struct<label: int>")
    opened = shaped.select("id", "dim", "_errors", body.alias("b"))
    return opened.select(
        F.col("id").alias("vec_id"), F.col("dim").cast("bigint").alias("dim"), F.col("b.metadata.label").alias("label"),
        (F.size("b.values") == F.col("dim")).alias("values_kept"), (F.size("_errors") > 0).alias("refused"),
    )


@check("kv_payload", """
SELECT CAST(c_custkey AS VARCHAR) AS key, '{"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}' AS value,
  CAST(3600 AS BIGINT) AS ttl FROM customer""")
def kv_payload(spark: SparkSession, sf: str) -> DataFrame:
    made = payloads.kv_payload(fx.table(spark, sf, "customer"), "c_custkey", ["c_name", "c_mktsegment"], 3600)
    return made.withColumn("ttl", F.col("ttl").cast("bigint"))


@check("write_receipt", """
SELECT count(*) AS rows_written, CAST(sum(octet_length(encode('{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}')) + 1) AS BIGINT) AS bytes_written
FROM customer""")
def write_receipt(spark: SparkSession, sf: str) -> DataFrame:
    return receipt(fx.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"))


@check("pre_aggregate", """
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty, count(*) AS n
FROM lineitem GROUP BY 1, 2""")
def pre_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    quantity = F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double")
    return payloads.pre_aggregate(
        fx.table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], {"sum_qty": quantity, "n": F.count("*")}
    )


class PartFolder(plugin.BatchSink):
    """A user-written sink: one Parquet file per task, listed only when all tasks are done."""

    @classmethod
    def name(cls) -> str:
        return "rowferry_part_folder"

    def write_part(self, batches):
        import pyarrow.parquet as pq

        system, root = FileSystem.from_uri(self.options["path"])
        system.create_dir(root)
        part, writer = f"{uuid.uuid4().hex}.parquet", None
        for batch in batches:
            writer = writer or pq.ParquetWriter(f"{root}/{part}", batch.schema, filesystem=system)
            writer.write_batch(batch)
        if writer is None:
            return None
        writer.close()
        return part

    def confirm(self, notes, rows) -> None:
        system, root = FileSystem.from_uri(self.options["path"])
        with system.open_output_stream(f"{root}/parts.list") as listing:
            listing.write("\n".join(n for n in notes if n).encode())


@check("sink_custom", "SELECT event_id, event_type FROM events")
def sink_custom(spark: SparkSession, sf: str) -> DataFrame:
    path = staging_path(spark, "custom-sink")
    rows = fx.table(spark, sf, "events").select("event_id", "event_type")
    rows.write.format(plugin.register_sink(spark, PartFolder)).mode("append").save(path)
    confirmed = [f"{path}/{r.value}" for r in spark.read.text(f"{path}/parts.list").collect()]
    return spark.read.schema(rows.schema).parquet(*confirmed)


_LATEST_SQL = f"""
WITH d AS ({CHANGES_SQL}), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY lsn DESC) AS rn FROM d)"""


@check("cdc_latest", f"{_LATEST_SQL} SELECT id, lsn, op FROM r WHERE rn = 1")
def cdc_latest(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.latest(fx.changes(spark, sf), ["id"], ["lsn"]).select("id", "lsn", "op")


_MERGED_SQL = f"""{_LATEST_SQL}, n AS (SELECT * FROM r WHERE rn = 1),
t AS (SELECT c_custkey AS id, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM customer)
SELECT coalesce(n.id, t.id) AS id, CASE WHEN n.id IS NOT NULL THEN n.amount ELSE t.amount END AS amount
FROM t FULL OUTER JOIN n ON t.id = n.id WHERE n.op IS NULL OR n.op <> 'd'"""


def _readable(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", F.col("amount").cast("double"))


@check("cdc_apply", _MERGED_SQL)
def cdc_apply(spark: SparkSession, sf: str) -> DataFrame:
    return _readable(cdc.apply_changes(fx.change_target(spark, sf), fx.changes(spark, sf), ["id"], ["lsn"]))


@check("merge_upsert", _MERGED_SQL)
def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Merged twice with the same changes: the replay changes nothing."""
    changes = fx.changes(spark, sf)
    once = cdc.merge(fx.change_target(spark, sf), changes, ["id"], ["lsn"])
    return _readable(cdc.merge(once, changes, ["id"], ["lsn"]))


@check("merge_few_changes", _MERGED_SQL)
def merge_few_changes(spark: SparkSession, sf: str) -> DataFrame:
    return _readable(cdc.merge_few(fx.change_target(spark, sf), fx.changes(spark, sf), ["id"], ["lsn"]))


@check("merge_bucketed", _MERGED_SQL)
def merge_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """A target bucketed by its key: only the changes are shuffled."""
    table, target = "rowferry_bucketed", fx.change_target(spark, sf)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    tables.create_target(target, table, staging_path(spark, "bucketed"), keys=["id"], buckets=8)
    target.write.insertInto(table)
    return _readable(cdc.merge(read_table(spark, table), fx.changes(spark, sf), ["id"], ["lsn"]))


@check("table_sink_repeat", "SELECT event_id, user_id, event_type, value FROM events")
def table_sink_repeat(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches into an append table, each delivered twice, the second with a column more."""
    events = fx.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    table = AppendTable(f"rowferry_append_{uuid.uuid4().hex}", staging_path(spark, "append"))
    table.create(spark, events.drop("value").schema)
    for number in range(3):
        part = events.where(F.col("event_id") % 3 == number)
        for _ in range(2):
            table.append(part, f"batch-{number}", widen=True)
    return spark.table(table.table)


def _keyed(spark: SparkSession, sf: str, folders: int = 16) -> KeyedTable:
    """A keyed table that holds the customers, in no known order."""
    target = fx.change_target(spark, sf)
    keyed = KeyedTable(f"rowferry_keyed_{uuid.uuid4().hex}", staging_path(spark, "keyed"), ["id"], ["lsn"], folders)
    keyed.create(spark, target.schema, fx.changes(spark, sf).schema)
    keyed.load(target, "load")
    return keyed


@check("merge_late_changes", _MERGED_SQL)
def merge_late_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The newer half of the changes first, then the older half, then the newer half again."""
    keyed, changes = _keyed(spark, sf), fx.changes(spark, sf)
    middle = changes.approxQuantile("lsn", [0.5], 0.1)[0]
    for step, half in enumerate(["lsn >= {}", "lsn < {}", "lsn >= {}"]):
        keyed.merge(changes.where(half.format(middle)), f"step-{step}")
    return _readable(keyed.rows(spark))


@check("merge_late_delete", f"""
{_LATEST_SQL}, n AS (SELECT id, op = 'd' AS gone, lsn FROM r WHERE rn = 1)
SELECT coalesce(n.id, c_custkey) AS id, coalesce(gone, false) AS gone, lsn FROM customer FULL OUTER JOIN n ON n.id = c_custkey""")
def merge_late_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Deletes first, then everything older: a deleted key stays a tombstone until a newer change comes."""
    keyed, changes = _keyed(spark, sf), fx.changes(spark, sf)
    keyed.merge(changes.where("op = 'd'"), "deletes")
    keyed.merge(changes.where("op <> 'd'"), "others", few=True)
    return keyed.state(spark).select("id", F.col("_gone").alias("gone"), "_order.lsn")


@check("merge_touched_folders", f"""
WITH d AS ({CHANGES_SQL}), r AS (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY lsn DESC) AS rn FROM d WHERE id = (SELECT min(id) FROM d)),
n AS (SELECT * FROM r WHERE rn = 1),
t AS (SELECT c_custkey AS id, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM customer)
SELECT coalesce(n.id, t.id) AS id, CASE WHEN n.id IS NOT NULL THEN n.amount ELSE t.amount END AS amount
FROM t FULL OUTER JOIN n ON t.id = n.id WHERE n.op IS NULL OR n.op <> 'd'""")
def merge_touched_folders(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of one key write one folder; the others stay as they were loaded."""
    keyed, changes = _keyed(spark, sf), fx.changes(spark, sf)
    one = changes.join(changes.agg(F.min("id").alias("id")), "id", "left_semi")
    keyed.merge(one, "one-key")
    return _readable(keyed.rows(spark))


@check("upsert_result", f"""
WITH d AS ({CHANGES_SQL}), u AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY lsn DESC) AS rn FROM d WHERE op <> 'd'),
n AS (SELECT * FROM u WHERE rn = 1),
t AS (SELECT c_custkey AS id, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM customer)
SELECT coalesce(n.id, t.id) AS id, CASE WHEN n.id IS NOT NULL THEN n.amount ELSE t.amount END AS amount
FROM t FULL OUTER JOIN n ON t.id = n.id""")
def upsert_result(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.changes(spark, sf).where("op <> 'd'").drop("op")
    return _readable(cdc.merge(fx.change_target(spark, sf), rows, ["id"], ["lsn"]))


@check("cdc_deletes", f"""
{_LATEST_SQL} SELECT c_custkey AS id FROM customer WHERE c_custkey IN (SELECT id FROM r WHERE rn = 1 AND op = 'd')""")
def cdc_deletes(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.removed_keys(fx.change_target(spark, sf), fx.changes(spark, sf), ["id"], ["lsn"])


@check("cdc_tombstones", """
WITH k AS (SELECT event_type AS topic, user_id AS k, event_id,
    row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id DESC) AS rn
  FROM events WHERE event_id % 20 <> 0)
SELECT topic, CAST(k AS VARCHAR) AS key, event_id AS lsn, CASE WHEN event_id % 25 = 0 THEN 'd' ELSE 'u' END AS op FROM k WHERE rn = 1""")
def cdc_tombstones(spark: SparkSession, sf: str) -> DataFrame:
    """A keyed record without a value is a delete."""
    changes = cdc.broker_changes(broker.broker_envelope(fx.broker_raw(spark, sf)))
    return cdc.latest(changes, ["topic", "key"], ["lsn"]).select("topic", "key", "lsn", "op")


@check("cdc_snapshot_handover", f"""
WITH d AS ({CHANGES_SQL}), f AS (
  SELECT c_custkey AS id, CAST(499 AS BIGINT) AS lsn, 'r' AS op, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM customer
  UNION ALL SELECT id, lsn, op, amount FROM d WHERE lsn > 499),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY lsn DESC) AS rn FROM f)
SELECT id, amount FROM r WHERE rn = 1 AND op <> 'd'""")
def cdc_snapshot_handover(spark: SparkSession, sf: str) -> DataFrame:
    feed = snapshot_plus_changes(fx.change_target(spark, sf), fx.changes(spark, sf), 499)
    return _readable(cdc.current_state(feed, ["id"], ["lsn"]))


@check("dedup_replay", "SELECT event_id, user_id, event_type FROM events")
def dedup_replay(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.dedup(fx.delivered_twice(spark, sf), ["event_id"])
