"""Broker records: reader options, the record envelope, position cursors."""

from __future__ import annotations

from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.config import Connector
from rowferry.errors import ConfigError, ConnectorMissing
from rowferry.operators.numbering import broadcast_if_small

# Connector property to Spark reader option.
KAFKA_OPTIONS = {
    "bootstrap_servers": "kafka.bootstrap.servers",
    "group_id": "kafka.group.id",
    "client_id": "kafka.client.id",
    "security_protocol": "kafka.security.protocol",
    "sasl_mechanism": "kafka.sasl.mechanism",
    "ssl_ca_location": "kafka.ssl.truststore.location",
}


def kafka_options(source: Connector) -> dict[str, str]:
    """Spark reader options for a declared Kafka source."""
    source.require("bootstrap_servers")
    topics = [t.strip() for t in str(source.require("topics")).split(",") if t.strip()]
    reset = source.get("auto_offset_reset", "latest")
    if reset not in ("latest", "earliest"):
        raise ConfigError(f"auto_offset_reset must be latest or earliest, not {reset!r}")
    options = {ours: str(source.get(p)) for p, ours in KAFKA_OPTIONS.items() if source.get(p) is not None}
    options.update(subscribe=",".join(topics), startingOffsets=reset, includeHeaders="true")
    user, password = source.get("sasl_username"), source.get("sasl_password")
    if user is not None and password is not None:
        options["kafka.sasl.jaas.config"] = (
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            f'username="{user}" password="{password}";'
        )
    return options


def read_kafka(spark: SparkSession, source: Connector, stream: bool = True, **limits: Any) -> DataFrame:
    """Kafka records as the seven-column envelope; needs Spark's Kafka package."""
    reader = spark.readStream if stream else spark.read
    options = kafka_options(source)
    if not stream and options["startingOffsets"] == "latest":
        raise ConfigError("a batch read needs auto_offset_reset=earliest")
    try:
        raw = reader.format("kafka").options(**options, **limits).load()
    except AnalysisException as missing:
        raise ConnectorMissing("Spark's Kafka package is not on the class path") from missing
    return broker_envelope(raw)


def broker_envelope(raw: DataFrame) -> DataFrame:
    """``topic, partition, offset, timestamp(ms), key, value, headers(JSON)``.

    Null keys and values stay null, so a tombstone can still delete. Of headers
    with the same name the last counts; no headers give ``{}``.
    """
    return raw.select(
        "topic",
        F.col("partition").cast("bigint").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.unix_millis(F.col("timestamp").cast("timestamp")).alias("timestamp"),
        _text(F.col("key")).alias("key"),
        _text(F.col("value")).alias("value"),
        _headers_json(F.col("headers")).alias("headers"),
    )


def _text(payload: Column) -> Column:
    """Bytes as text; byte sequences that are not UTF-8 are replaced, not refused."""
    return F.make_valid_utf8(payload.cast("string"))


def _headers_json(headers: Column) -> Column:
    names = F.transform(headers, lambda h: h["key"])
    back = F.reverse(names)
    last = F.filter(headers, lambda h, i: F.size(names) - F.array_position(back, h["key"]) == i)
    pairs = F.transform(last, lambda h: F.struct(h["key"].alias("key"), _text(h["value"]).alias("value")))
    return F.coalesce(F.to_json(F.map_from_entries(pairs)), F.lit("{}"))


def offset_cursor(df: DataFrame) -> DataFrame:
    """Per topic: ``cursor`` as ``partition:offset`` pairs, and the record count.

    Offsets combine on the map side; what is gathered per topic is one pair per
    partition of that topic.
    """
    tops = df.groupBy("topic", "partition").agg(F.max("offset").alias("top"), F.count("*").alias("n"))
    gathered = tops.groupBy("topic").agg(
        F.sort_array(F.collect_list(F.struct("partition", "top"))).alias("pairs"),
        F.sum("n").alias("records_since_last"),
    )
    text = F.transform("pairs", lambda p: F.concat_ws(":", p["partition"].cast("string"), p["top"].cast("string")))
    return gathered.select("topic", F.array_join(text, ",").alias("cursor"), "records_since_last")


def parse_cursor(cursors: DataFrame) -> DataFrame:
    """``topic, cursor`` to ``topic, partition, last_offset``; malformed pairs are ignored."""
    pairs = cursors.select("topic", F.explode(F.split("cursor", ",")).alias("pair"))
    halves = pairs.select("topic", F.split(F.trim("pair"), ":").alias("half"))
    typed = halves.where(F.size("half") == 2).select(
        "topic",
        F.col("half")[0].try_cast(T.LongType()).alias("partition"),
        F.col("half")[1].try_cast(T.LongType()).alias("last_offset"),
    )
    return typed.where("partition IS NOT NULL AND last_offset IS NOT NULL")


def resume_after(df: DataFrame, cursors: DataFrame) -> DataFrame:
    """Records beyond the saved position of their topic and partition.

    A partition without a saved position is read from its start. The positions
    are one row per broker partition; they are counted before they are sent to
    every executor, since a shuffle by so few keys would be badly skewed.
    """
    saved = parse_cursor(cursors).groupBy("topic", "partition").agg(F.max("last_offset").alias("last_offset"))
    joined = df.join(broadcast_if_small(saved), ["topic", "partition"], "left")
    beyond = F.col("last_offset").isNull() | (F.col("offset") > F.col("last_offset"))
    return joined.where(beyond).drop("last_offset").select(*df.columns)
