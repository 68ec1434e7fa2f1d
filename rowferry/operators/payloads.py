"""Payloads for brokers, bulk APIs, search, vector and key-value stores."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.functions.records import name, record_json
from rowferry.operators.mapping import add_errors
from rowferry.operators.numbering import number_rows
from rowferry.schemas import LONG, TEXT, fields

# Most items one bulk request of each service takes.
REQUEST_SIZES = {"dynamodb": 25, "sqs": 10, "kinesis": 500, "search": 10_000}


def to_broker(df: DataFrame, key: str, topic: str, value_columns: list[str],
              headers: dict[str, Column] | None = None) -> DataFrame:
    """``topic, key, value, headers``; the key keeps the rows of one entity in order."""
    pairs = [
        F.struct(F.lit(k).alias("key"), v.cast("string").cast("binary").alias("value"))
        for k, v in (headers or {}).items()
    ]
    shaped = [
        name(topic).cast("string").alias("topic"),
        name(key).cast("string").alias("key"),
        record_json(value_columns).alias("value"),
    ]
    return df.select(*shaped, *([F.array(*pairs).alias("headers")] if pairs else []))


def chunk_in_order(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """``chunk_id, n, first, last, payload``: consecutive rows in a total order, ``size`` each.

    Uses distributed row numbers; a chunk gathers at most ``size`` rows.
    ``first`` and ``last`` are the values of the leading order column.
    """
    numbered = number_rows(df, order, "_at").withColumn("chunk_id", F.floor(F.col("_at") / F.lit(size)))
    item = F.struct("_at", F.struct(*[name(c) for c in df.columns]).alias("row"))
    gathered = numbered.groupBy("chunk_id").agg(
        F.count("*").alias("n"),
        F.min_by(name(order[0]), "_at").alias("first"),
        F.max_by(name(order[0]), "_at").alias("last"),
        F.sort_array(F.collect_list(item)).alias("_items"),
    )
    body = F.to_json(F.transform("_items", lambda i: i["row"]))
    return gathered.select("chunk_id", "n", "first", "last", body.alias("payload"))


def chunk(df: DataFrame, size: int) -> DataFrame:
    """``chunk_id, n, payload``: requests of at most ``size`` rows, in no given order.

    Spark makes the JSON text of each row; a task then joins its own rows, so
    nothing is sorted or shuffled, and a repeated task gives whole chunks again.
    """
    def requests(items: pa.Array, first: int) -> pa.RecordBatch:
        ends = [*range(0, len(items), size), len(items)]
        groups = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)
        ids = [f"{TaskContext.get().partitionId()}-{first + i}" for i in range(len(groups))]
        body = pc.binary_join_element_wise("[", pc.binary_join(groups, ","), "]", "")
        counts = pc.list_value_length(groups).cast(pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(ids), counts, body], names=["chunk_id", "n", "payload"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held = 0, pa.array([], pa.string())
        for batch in batches:
            held = pa.concat_arrays([held, batch.column(0)])
            full = len(held) - len(held) % size
            if full:
                yield requests(held[:full], made)
                made, held = made + full // size, held[full:]
        if len(held):
            yield requests(held, made)

    return df.select(record_json(df.columns).alias("item")).mapInArrow(pack, fields(chunk_id=TEXT, n=LONG, payload=TEXT))


def bulk_lines(df: DataFrame, index: str, id_column: str) -> DataFrame:
    """``id, line_no, line``: the action and the document of each row for a search bulk call."""
    action = F.to_json(F.struct(F.struct(
        F.lit(index).alias("_index"), name(id_column).cast("string").alias("_id")).alias("index")))
    both = F.array(action, record_json(df.columns))
    return df.select(name(id_column).alias("id"), F.posexplode(both).alias("line_no", "line"))


def vector_payload(df: DataFrame, id_column: str, vector: str, metadata: list[str], dimension: int) -> DataFrame:
    """``id, dim, payload, _errors``; vectors of another size are marked for the dead letters."""
    size = F.coalesce(F.size(name(vector)), F.lit(-1))
    body = F.to_json(F.struct(
        name(id_column).cast("string").alias("id"),
        name(vector).alias("values"),
        F.struct(*[name(c) for c in metadata]).alias("metadata"),
    ))
    shaped = df.select(name(id_column).alias("id"), size.alias("dim"), body.alias("payload"))
    return add_errors(shaped, [F.when(F.col("dim") != dimension, F.lit("type:" + vector))])


def kv_payload(df: DataFrame, key: str, columns: list[str], ttl: int) -> DataFrame:
    return df.select(
        name(key).cast("string").alias("key"), record_json(columns).alias("value"), F.lit(ttl).alias("ttl")
    )


def pre_aggregate(df: DataFrame, keys: list[str], aggregates: dict[str, Column]) -> DataFrame:
    """Fewer rows before a costly load; combines on the map side."""
    return df.groupBy(*[name(k) for k in keys]).agg(*[c.alias(label) for label, c in aggregates.items()])
