"""Queries on sources and parsers."""

from __future__ import annotations

from datetime import datetime

from pyarrow.fs import FileSelector, FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.checks import fixtures as fx
from rowferry.checks.registry import check
from rowferry.config import job_from_dict
from rowferry.formats import parse, serialise
from rowferry.formats.custom import parse_custom, serialise_custom
from rowferry.operators.numbering import number_rows
from rowferry.schemas import DOUBLE, LONG, TEXT, fields
from rowferry.session import staging_path
from rowferry.sources import broker, changes, files, generate, lines, paged, plugin, pulls, tables
from rowferry.streaming.run import open_source

# The text of each raw line, as the fixture makes it.
RAW_LINE_SQL = """
  CASE event_id % 50
    WHEN 0 THEN '{"event_id": ' || event_id || ', "user'
    WHEN 1 THEN '{"event_id": ' || event_id || ', "user_id": ' || user_id || ', "value": ' || CAST(value AS DECIMAL(18,2)) || '}'
    WHEN 2 THEN '{"event_id": ' || event_id || ', "user_id": ' || user_id || ', "event_type": "' || event_type || '", "value": "abc"}'
    ELSE '{"event_id": ' || event_id || ', "user_id": ' || user_id || ', "event_type": "' || event_type || '", "value": ' || CAST(value AS DECIMAL(18,2)) || '}'
  END"""


def landed_lines(spark: SparkSession, sf: str) -> str:
    """The raw lines as text files in the staging folder."""
    path = staging_path(spark, "lines")
    fx.raw_lines(spark, sf).select("raw_json").write.text(path)
    return path


@check("src_ndjson_lines", f"SELECT {RAW_LINE_SQL} AS raw_json FROM events WHERE event_id % 50 <> 3")
def src_ndjson_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines.read_lines(spark, landed_lines(spark, sf))


@check("src_kafka_envelope", """
SELECT event_type AS topic, user_id % 4 AS "partition", event_id AS "offset", epoch_us(ts) // 1000 AS "timestamp",
  CASE WHEN event_id % 20 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS "key",
  CASE WHEN event_id % 25 = 0 THEN NULL ELSE props END AS "value",
  CASE WHEN event_id % 30 = 0 THEN '{}' ELSE '{"type":"' || event_type || '"}' END AS headers
FROM events""")
def src_kafka_envelope(spark: SparkSession, sf: str) -> DataFrame:
    return broker.broker_envelope(fx.broker_raw(spark, sf))


@check("src_new_files", "SELECT event_id, user_id FROM events WHERE event_id % 4 IN (2, 3)")
def src_new_files(spark: SparkSession, sf: str) -> DataFrame:
    root, ledger = staging_path(spark, "landing"), staging_path(spark, "ledger")
    events = fx.table(spark, sf, "events")
    events.withColumn("part", F.col("event_id") % 4).write.partitionBy("part").parquet(root)
    first = files.list_files(spark, root, "*.parquet").where(F.col("path").rlike("part=[01]/"))
    files.mark_read(first, ledger)
    rows, _ = files.read_new_files(
        spark, root, "parquet", spark.read.schema(files.LEDGER_SCHEMA).parquet(ledger), events.schema, "*.parquet"
    )
    return rows.select("event_id", "user_id")


@check("new_files_odd_names", "SELECT event_id, user_id FROM events WHERE event_id % 2 = 1")
def new_files_odd_names(spark: SparkSession, sf: str) -> DataFrame:
    """A folder whose name, taken as a pattern, is that of one already read."""
    root, ledger = staging_path(spark, "landing"), staging_path(spark, "ledger")
    events = fx.table(spark, sf, "events")
    for odd, day in enumerate(["day1", "day[1]"]):
        events.where(F.col("event_id") % 2 == odd).write.parquet(f"{root}/{day}")
    files.mark_read(files.list_files(spark, root, "*.parquet").where(F.contains("path", F.lit("/day1/"))), ledger)
    rows, _ = files.read_new_files(
        spark, root, "parquet", spark.read.schema(files.LEDGER_SCHEMA).parquet(ledger), events.schema, "*.parquet"
    )
    return rows.select("event_id", "user_id")


@check("src_table_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def src_table_scan(spark: SparkSession, sf: str) -> DataFrame:
    table, path = "rowferry_scan", staging_path(spark, "table")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    fx.table(spark, sf, "orders").write.option("path", path).saveAsTable(table)
    return tables.read_table(spark, table).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


@check("pull_since_ts", "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-15'")
def pull_since_ts(spark: SparkSession, sf: str) -> DataFrame:
    return pulls.pull_since(fx.table(spark, sf, "events"), "ts", datetime(2024, 1, 15)).select("event_id", "ts")


@check("pull_next_cursor", "SELECT max(ts) AS cursor FROM events WHERE ts > TIMESTAMP '2024-01-15'")
def pull_next_cursor(spark: SparkSession, sf: str) -> DataFrame:
    start = datetime(2024, 1, 15)
    return pulls.next_cursor(pulls.pull_since(fx.table(spark, sf, "events"), "ts", start), "ts", start)


@check("pull_keyset", "SELECT event_id, user_id FROM events WHERE event_id > 500 ORDER BY event_id LIMIT 100")
def pull_keyset(spark: SparkSession, sf: str) -> DataFrame:
    return pulls.pull_after(fx.table(spark, sf, "events").select("event_id", "user_id"), "event_id", 500, 100)


@check("pull_offset_page", "SELECT event_id, user_id FROM events ORDER BY event_id LIMIT 50 OFFSET 150")
def pull_offset_page(spark: SparkSession, sf: str) -> DataFrame:
    return pulls.pull_page(fx.table(spark, sf, "events").select("event_id", "user_id"), ["event_id"], 3, 50)


@check("pull_page_numbers", """
SELECT l_orderkey, l_linenumber, CAST((row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1) // 5000 AS BIGINT) AS page
FROM lineitem""")
def pull_page_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Which far page each row is on: the numbering behind deep pages."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    numbered = number_rows(fx.table(spark, sf, "lineitem").select(*order), order, "at")
    return numbered.select("l_orderkey", "l_linenumber", F.floor(F.col("at") / 5000).alias("page"))


_ITEM = fields(event_id=LONG, event_type=TEXT)


@check("pull_far_page", "SELECT event_id, user_id, event_type FROM events ORDER BY user_id, event_id LIMIT 60 OFFSET 600")
def pull_far_page(spark: SparkSession, sf: str) -> DataFrame:
    """The eleventh page of a kept order; only the folders it falls into are read."""
    events, path = fx.table(spark, sf, "events").select("event_id", "user_id", "event_type"), staging_path(spark, "paged")
    paged.write_pages(events, ["user_id", "event_id"], path)
    return paged.read_page(spark, path, events.schema, 10, 60)


@check("pages_explode", """
SELECT event_id // 100 AS page, CAST(event_id % 100 AS BIGINT) AS pos, event_id, event_type
FROM events WHERE (event_id // 100) % 10 <> 7""")
def pages_explode(spark: SparkSession, sf: str) -> DataFrame:
    items, _ = pulls.explode_pages(fx.api_pages(spark, sf), "body", _ITEM)
    return items.withColumn("pos", F.col("pos").cast("bigint"))


@check("pages_refused", """
SELECT DISTINCT event_id // 100 AS page, '{"error": "rate limit"}' AS body
FROM events WHERE (event_id // 100) % 10 = 7""")
def pages_refused(spark: SparkSession, sf: str) -> DataFrame:
    return pulls.explode_pages(fx.api_pages(spark, sf), "body", _ITEM)[1]


@check("pages_item_faults", """
SELECT event_id // 50 AS page, CAST(event_id % 50 AS BIGINT) AS pos, CASE WHEN event_id % 9 = 4 THEN NULL ELSE event_id END AS event_id,
  CASE WHEN event_id % 9 = 4 THEN 'type:event_id' ELSE '' END AS errors
FROM events WHERE (event_id // 50) % 10 <> 7
UNION ALL SELECT DISTINCT event_id // 50, NULL, NULL, 'corrupt' FROM events WHERE (event_id // 50) % 10 = 7""")
def pages_item_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Items below a path of the body; one in nine has an id of another type, one page in ten no items."""
    events = fx.table(spark, sf, "events").selectExpr(
        "event_id div 50 AS page", "event_id % 50 AS pos",
        "CASE WHEN event_id % 9 = 4 THEN '{\"event_id\": \"x' || event_id || '\"}' ELSE '{\"event_id\": ' || event_id || '}' END AS item",
    )
    pages = events.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "item"))), lambda i: i["item"]), ",").alias("items"))
    bodies = pages.selectExpr("page", "CASE WHEN page % 10 = 7 THEN '{\"error\": 429}' ELSE '{\"data\": {\"items\": [' || items || ']}}' END AS body")
    found = pulls.page_items(bodies, "body", fields(event_id=LONG), "data.items")
    return found.select("page", F.col("pos").cast("bigint").alias("pos"), "event_id", F.array_join("_errors", ";").alias("errors"))


CHANGES_SQL = """
SELECT event_id AS lsn, user_id AS id,
  CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS amount
FROM events"""


@check("cdc_parse", CHANGES_SQL)
def cdc_parse(spark: SparkSession, sf: str) -> DataFrame:
    row = fields(id=LONG, amount=DOUBLE)
    return changes.parse_changes(fx.change_events(spark, sf), "body", row).select("lsn", "id", "op", "amount")


@check("cdc_parse_faults", """
SELECT event_id AS lsn, user_id AS id, event_type = 'error' AS gone, '' AS errors FROM events WHERE event_id % 8 > 2
UNION ALL SELECT event_id, user_id, true, '' FROM events WHERE event_id % 8 = 0
UNION ALL SELECT event_id, NULL, false, 'type:after' FROM events WHERE event_id % 8 = 1
UNION ALL SELECT event_id, NULL, true, 'missing:id' FROM events WHERE event_id % 8 = 2""")
def cdc_parse_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Of eight changes one is a delete by key only, one has an id of another type, one a delete without key."""
    whole = fx.table(spark, sf, "events").selectExpr("""CASE event_id % 8
        WHEN 0 THEN to_json(named_struct('op', 'd', 'key', user_id, 'lsn', event_id))
        WHEN 1 THEN to_json(named_struct('op', 'u', 'after', named_struct('id', 'x'), 'lsn', event_id))
        WHEN 2 THEN to_json(named_struct('op', 'd', 'lsn', event_id))
        ELSE CASE WHEN event_type = 'error'
          THEN to_json(named_struct('op', 'd', 'before', named_struct('id', user_id), 'lsn', event_id))
          ELSE to_json(named_struct('op', 'u', 'after', named_struct('id', user_id), 'lsn', event_id)) END END AS body""")
    found = changes.parse_changes(whole, "body", fields(id=LONG, amount=DOUBLE))
    return found.select("lsn", "id", (F.col("op") == "d").alias("gone"), F.array_join("_errors", ";").alias("errors"))


_MADE = (("account", "integer", 1000), ("score", "float", 100), ("label", "text", 12))


@check("src_generate", """
SELECT event_id AS id,
  CAST('0x' || substr(md5('7:account:' || event_id), 1, 8) AS BIGINT) % 1000 AS account,
  CAST('0x' || substr(md5('7:score:' || event_id), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE * 100.0::DOUBLE AS score,
  substr(md5('7:label:' || event_id), 1, 12) AS label
FROM events""")
def src_generate(spark: SparkSession, sf: str) -> DataFrame:
    """Made-up columns for the ids of the table, as ``generate`` makes them for a range of ids."""
    ids = fx.table(spark, sf, "events").select(F.col("event_id").alias("id"))
    return generate.synthetic_columns(ids, "id", _MADE, seed=7)


class LineFolder(plugin.PolledSource):
    """A user-written source: JSON lines in a folder, one part per file."""

    @classmethod
    def name(cls) -> str:
        return "rowferry_line_folder"

    def schema(self) -> str:
        return "event_id BIGINT, event_type STRING"

    def parts(self) -> list[str]:
        system, root = FileSystem.from_uri(self.options["path"])
        found = system.get_file_info(FileSelector(root))
        return [f.path for f in found if f.base_name.startswith("part-") and f.size]

    def poll(self, part: str):
        import pyarrow.json as reader

        system, _ = FileSystem.from_uri(self.options["path"])
        with system.open_input_file(part) as lines:
            yield from reader.read_json(lines).select(["event_id", "event_type"]).to_batches()


@check("src_custom", "SELECT event_id, event_type FROM events")
def src_custom(spark: SparkSession, sf: str) -> DataFrame:
    path = staging_path(spark, "custom-source")
    fx.table(spark, sf, "events").select("event_id", "event_type").repartition(3).write.json(path)
    return spark.read.format(plugin.register_source(spark, LineFolder)).load(path)


@check("fmt_json_parse", """
SELECT event_id AS line_id,
  CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
  CASE WHEN event_id % 50 IN (0, 1) THEN NULL ELSE event_type END AS event_type,
  CASE WHEN event_id % 50 IN (0, 2) THEN NULL ELSE CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS value,
  event_id % 50 IN (0, 2) AS is_corrupt
FROM events WHERE event_id % 50 <> 3""")
def fmt_json_parse(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse.parse_json(lines.clean_lines(fx.raw_lines(spark, sf)), "raw_json", fx.RECORD, keep=["line_id"])
    return parsed.select(
        "line_id", F.col("user_id").cast("string").alias("user_id"), "event_type", "value",
        F.col(parse.CORRUPT).isNotNull().alias("is_corrupt"),
    )


@check("fmt_flatten", "SELECT event_id, user_id AS e_user_id, event_type AS e_d_event_type, value AS e_d_value FROM events")
def fmt_flatten(spark: SparkSession, sf: str) -> DataFrame:
    nested = F.struct("user_id", F.struct("event_type", "value").alias("d"))
    return parse.flatten(fx.table(spark, sf, "events").select("event_id", nested.alias("e")))


@check("fmt_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def fmt_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A declared CSV source with a header and its own separator, read as a table."""
    customer = fx.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    path, options = staging_path(spark, "csv"), {"header": "true", "sep": ";"}
    customer.write.options(**options).csv(path)
    properties = {"path": path, "schema": customer.schema.toDDL(), "options": options}
    job = job_from_dict({"pipeline_id": "p1", "source": {"type": "csv", "properties": properties}, "sink": {"type": "discard"}})
    return open_source(spark, job, stream=False)


@check("fmt_csv_column", """
SELECT event_id, event_id % 10 <> 0 AS fits, CASE WHEN event_id % 10 <> 0 THEN event_type END AS event_type FROM events""")
def fmt_csv_column(spark: SparkSession, sf: str) -> DataFrame:
    """Delimited text in a column; one number in ten is not a number."""
    text = "CASE WHEN event_id % 10 = 0 THEN 'x' ELSE CAST(user_id AS STRING) END || ';' || event_type"
    rows = fx.table(spark, sf, "events").selectExpr("event_id", f"{text} AS body")
    parsed = parse.parse_csv(rows, "body", fields(user_id=LONG, event_type=TEXT), {"sep": ";"})
    fits = F.col(parse.CORRUPT).isNull()
    return parsed.select("event_id", fits.alias("fits"), F.when(fits, F.col("event_type")).alias("event_type"))


@check("fmt_xml", "SELECT event_id, user_id, event_type AS d_event_type FROM events")
def fmt_xml(spark: SparkSession, sf: str) -> DataFrame:
    body = "'<e><event_id>' || event_id || '</event_id><user_id>' || user_id || '</user_id><d><event_type>' || event_type || '</event_type></d></e>'"
    rows = fx.table(spark, sf, "events").selectExpr(f"{body} AS body")
    schema = fields(event_id=LONG, user_id=LONG, d=fields(event_type=TEXT))
    return parse.flatten(parse.parse_xml(rows, "body", schema).drop(parse.CORRUPT))


_FIXED_WIDTH = fields(user_id=LONG, event_type=TEXT)


def _fixed_width(line: str) -> list[dict]:
    return [{"user_id": int(line[:10]), "event_type": line[10:20].strip()}]


@check("fmt_custom_parser", """
SELECT event_id, event_id % 50 = 0 AS refused, CASE WHEN event_id % 50 <> 0 THEN event_type END AS event_type,
  CASE WHEN event_id % 50 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id FROM events""")
def fmt_custom_parser(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed-width lines through a user parser; 1 line in 50 has a broken number."""
    line = "CASE WHEN event_id % 50 = 0 THEN 'x' ELSE lpad(CAST(user_id AS STRING), 10, ' ') END || rpad(event_type, 10, ' ')"
    rows = fx.table(spark, sf, "events").selectExpr("event_id", f"{line} AS line")
    parsed = parse_custom(rows, "line", _fixed_width, _FIXED_WIDTH, keep=["event_id"])
    return parsed.select(
        "event_id", F.col("_error").isNotNull().alias("refused"), "event_type", F.col("user_id").cast("string").alias("user_id")
    )


@check("fmt_custom_serialiser", "SELECT event_id, event_id || '|' || event_type AS value FROM events")
def fmt_custom_serialiser(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "events").select("event_id", "event_type")
    made = serialise_custom(rows, lambda r: f"{r['event_id']}|{r['event_type']}".encode(), keep=["event_id"])
    return made.select("event_id", F.col("value").cast("string").alias("value"))


@check("fmt_to_ndjson", """
SELECT CAST(to_json({'event_id': event_id, 'event_type': event_type, 'value': value}) AS VARCHAR) AS value FROM events""")
def fmt_to_ndjson(spark: SparkSession, sf: str) -> DataFrame:
    return serialise.to_ndjson(fx.table(spark, sf, "events").select("event_id", "event_type", "value"))


@check("offset_cursor", """
WITH tops AS (SELECT event_type AS topic, user_id % 4 AS p, max(event_id) AS o, count(*) AS n FROM events GROUP BY 1, 2)
SELECT topic, string_agg(p || ':' || o, ',' ORDER BY p) AS cursor, CAST(sum(n) AS BIGINT) AS records_since_last
FROM tops GROUP BY topic""")
def offset_cursor(spark: SparkSession, sf: str) -> DataFrame:
    return broker.offset_cursor(broker.broker_envelope(fx.broker_raw(spark, sf)))


@check("offset_resume", """
SELECT event_type AS topic, user_id % 4 AS "partition", event_id AS "offset"
FROM events WHERE user_id % 4 IN (2, 3) OR event_id > 99""")
def offset_resume(spark: SparkSession, sf: str) -> DataFrame:
    records = broker.broker_envelope(fx.broker_raw(spark, sf)).select("topic", "partition", "offset")
    saved = records.select("topic").distinct().withColumn("cursor", F.lit("0:99,1:99,x:1"))
    return broker.resume_after(records, saved)
