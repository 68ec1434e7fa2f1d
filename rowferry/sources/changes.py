"""Change feeds: decoded change events to columns, and the snapshot handover."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.formats.parse import CORRUPT, evaluate_once
from rowferry.functions.records import name
from rowferry.operators.contract import read_records
from rowferry.operators.mapping import ERRORS, add_errors

# Kinds of change.
CREATE, UPDATE, DELETE, READ = "c", "u", "d", "r"


def parse_changes(df: DataFrame, column: str, row: T.StructType, keys: list[str] | None = None) -> DataFrame:
    """``{op, key, before, after, lsn, ts}`` as JSON to ``lsn, ts, op``, the row's columns, and ``_errors``.

    A delete has no ``after``; its columns come from ``before``, or else those
    named by ``keys`` from ``key``: an object, or the value of an only key
    (the row's only column, unless ``keys`` says otherwise). A broken event, a
    value that does not fit, an unknown kind of change, and a change without
    its image, key or order are faults, so no value is lost unseen.
    """
    event = T.StructType([
        T.StructField("op", T.StringType(), False),
        T.StructField("key", T.StringType()),
        T.StructField("before", row),
        T.StructField("after", row),
        T.StructField("lsn", T.LongType(), False),
        T.StructField("ts", T.StringType()),
    ])
    events = read_records(df.select(name(column)), column, event, unknown=False)
    keys = keys if keys is not None else row.names[:1]
    keyed = T.StructType([row[k] for k in keys])
    is_object = F.startswith(F.ltrim("key"), F.lit("{"))
    whole = F.from_json("key", T.StructType([*keyed.fields, T.StructField(CORRUPT, T.StringType())]), {"columnNameOfCorruptRecord": CORRUPT})
    from_key = {k: whole[k] for k in keys}
    if len(keys) == 1:
        from_key = {keys[0]: F.when(is_object, whole[keys[0]]).otherwise(F.col("key").try_cast(keyed[keys[0]].dataType))}
    gone, image = F.col("op") == DELETE, F.when(F.col("op") == DELETE, F.col("before")).otherwise(F.col("after"))
    by_key = gone & F.col("before").isNull()
    values = [F.when(by_key, from_key[f.name]).otherwise(image[f.name]).alias(f.name) if f.name in keys else image[f.name].alias(f.name) for f in row.fields]
    sound = F.size(ERRORS) == 0
    shaped = evaluate_once(events, "_row", F.struct(*values))
    faults = [F.when(sound & ~F.col("op").isin(CREATE, UPDATE, DELETE, READ), F.lit("type:op"))]
    faults.append(F.when(sound & ~gone & F.col("after").isNull(), F.lit("missing:after")))
    faults += [F.when(sound & (gone | F.col("after").isNotNull()) & F.col("_row")[k].isNull(), F.lit(f"missing:{k}")) for k in keys]
    marked = add_errors(shaped, faults)
    return marked.select("lsn", "ts", "op", *[F.col("_row")[f.name].alias(f.name) for f in row.fields], ERRORS)


def snapshot_plus_changes(snapshot: DataFrame, changes: DataFrame, snapshot_lsn: int) -> DataFrame:
    """Snapshot rows as reads at ``snapshot_lsn``, then only the later changes."""
    reads = snapshot.withColumns({"op": F.lit(READ), "lsn": F.lit(snapshot_lsn).cast("bigint")})
    later = changes.where(F.col("lsn") > snapshot_lsn)
    return reads.unionByName(later, allowMissingColumns=True)
