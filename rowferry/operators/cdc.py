"""Change apply: newest change per key, merge into a current-state table, dedup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.records import name
from rowferry.session import stage
from rowferry.sources.changes import DELETE, UPDATE

GONE, GONE_AT, ORDER = "_gone", "_gone_at", "_order"

_FIXED_WIDTH = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.DateType, T.TimestampType, T.TimestampNTZType,
)


def _fixed_width(kind: T.DataType) -> bool:
    return isinstance(kind, _FIXED_WIDTH) or (isinstance(kind, T.DecimalType) and kind.precision <= 18)


def latest(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key by ``order`` (later columns break ties).

    ``max_by`` combines before the shuffle, so a key that holds a third of all
    changes sends one row per task. Fixed-width columns are taken one by one,
    which lets Spark aggregate by hashing; others travel as one struct.
    """
    rest = [c for c in changes.columns if c not in keys]
    newest = name(order[0]) if len(order) == 1 else F.struct(*[name(c) for c in order])
    by_key = changes.groupBy(*[name(c) for c in keys])
    if len(order) == 1 and all(_fixed_width(changes.schema[c].dataType) for c in rest):
        return by_key.agg(*[F.max_by(name(c), newest).alias(c) for c in rest])
    picked = by_key.agg(F.max_by(F.struct(*[name(c) for c in rest]), newest).alias("_row"))
    return picked.select(*[name(c) for c in keys], "_row.*")


def broker_changes(envelope: DataFrame) -> DataFrame:
    """Keyed broker records as changes; a key with a null value is a delete."""
    return envelope.where(F.col("key").isNotNull()).select(
        "topic", "key", "value",
        F.col("offset").alias("lsn"),
        F.when(F.col("value").isNull(), DELETE).otherwise(UPDATE).alias("op"),
    )


def _newest_state(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str], op: str) -> DataFrame:
    """Per key the newest values and whether that change was a delete."""
    values = [c for c in target.columns if c not in keys]
    gone = (F.col(op) == DELETE) if op in changes.columns else F.lit(False)
    needed = changes.select(
        *[name(c) for c in keys + values], *[name(c) for c in order if c not in keys + values], gone.alias(GONE)
    )
    return latest(needed, keys, order).select(*[name(c) for c in keys + values], GONE)


def merge(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str], op: str = "op") -> DataFrame:
    """The target after all changes: matched rows updated, new ones added, deleted ones gone.

    The changes are compared with each other, not with those applied before;
    :func:`merge_state` and keyed tables also refuse late ones. Keys and orders
    are not null (see :func:`unplaced`).

    One full outer join on the keys. A target bucketed by its keys is not
    shuffled. Applying the same changes twice gives the same rows. Write the
    result beside the target, never over it.
    """
    newest = _newest_state(target, changes, keys, order, op)
    values = [c for c in target.columns if c not in keys]
    old = target.select(*[name(c) for c in keys], *[name(c).alias(f"_old_{c}") for c in values])
    joined = old.join(newest, keys, "full_outer")
    changed = F.col(GONE).isNotNull()
    kept = joined.where(~F.coalesce(F.col(GONE), F.lit(False)))
    merged = [F.when(changed, name(c)).otherwise(name(f"_old_{c}")).alias(c) for c in values]
    return kept.select(*[name(c) for c in keys], *merged).select(*[name(c) for c in target.columns])


def merge_few(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str], op: str = "op") -> DataFrame:
    """The same result when the changes are few beside the target.

    The reduced changes are staged, so the optimizer knows their size: below
    its broadcast threshold the target is read twice (once its keys only) and
    never shuffled; above it both joins are ordinary shuffle joins.
    """
    newest = stage(_newest_state(target, changes, keys, order, op), "changes")
    values = [c for c in target.columns if c not in keys]
    new = newest.select(*[name(c) for c in keys], *[name(c).alias(f"_new_{c}") for c in values], GONE)
    joined = target.join(new, keys, "left").where(~F.coalesce(F.col(GONE), F.lit(False)))
    merged = [F.when(F.col(GONE).isNotNull(), name(f"_new_{c}")).otherwise(name(c)).alias(c) for c in values]
    kept = joined.select(*[name(c) for c in keys], *merged)
    hits = target.select(*[name(c) for c in keys]).join(newest.select(*[name(c) for c in keys]), keys, "left_semi")
    added = newest.where(~F.col(GONE)).drop(GONE).join(hits, keys, "left_anti")
    return kept.unionByName(added).select(*[name(c) for c in target.columns])


def unplaced(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Changes that no merge can place, since a key or an order is null."""
    return changes.where(_any_null([*keys, *order]))


def placed(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The other changes: those with a whole key and order."""
    return changes.where(~_any_null([*keys, *order]))


def _any_null(columns: list[str]) -> Column:
    return reduce(Column.__or__, [name(c).isNull() for c in columns])


def newest_changes(changes: DataFrame, keys: list[str], order: list[str], op: str = "op") -> DataFrame:
    """The newest change per key with its order in ``_order`` and whether it was a delete in ``_gone``.

    Order columns that are no keys leave the row unless ``_order`` is read.
    """
    whole = placed(changes, keys, order)
    gone = (F.col(op) == DELETE) if op in changes.columns else F.lit(False)
    ordered = whole.withColumns({ORDER: F.struct(*[name(c).alias(c) for c in order]), GONE: F.coalesce(gone, F.lit(False))})
    return latest(ordered.drop(op) if op in changes.columns else ordered, keys, [ORDER])


def merge_state(state: DataFrame, newest: DataFrame, keys: list[str], at: Column, few: bool = False) -> DataFrame:
    """``state`` after the newest change of each key, where that is newer than the row it finds.

    A state row has an ``_order``, null where it is unknown, and is a tombstone
    with ``_gone`` since ``_gone_at``; only live rows have values. The result
    holds either the old or the new form of a key, so it may come in any
    order, and again. With ``few`` changes the state is read twice, once its
    keys only, and is not shuffled as long as the changes are small enough for
    a broadcast.
    """
    values = [c for c in state.columns if c not in [*keys, ORDER, GONE, GONE_AT]]
    carried = [*values, ORDER, GONE]
    kind = {c: state.schema[c].dataType for c in carried}
    new = newest.select(
        *[name(k) for k in keys], *[_live(c, values).cast(kind[c]).alias(f"_new_{c}") for c in carried], F.lit(True).alias("_new"),
    )
    wins = F.col("_new") & (F.col(ORDER).isNull() | (F.col(f"_new_{ORDER}") > F.col(ORDER)))
    since = F.when(F.col(f"_new_{GONE}"), at)

    def chosen(joined: DataFrame, won: Column) -> DataFrame:
        return joined.select(
            *[name(k) for k in keys], *[F.when(won, name(f"_new_{c}")).otherwise(name(c)).alias(c) for c in carried],
            F.when(won, since).otherwise(F.col(GONE_AT)).alias(GONE_AT),
        )

    if not few:
        joined = state.select(*[name(k) for k in keys], *[name(c) for c in carried], GONE_AT, F.lit(True).alias("_old")).join(new, keys, "full_outer")
        merged = chosen(joined, F.col("_old").isNull() | F.coalesce(wins, F.lit(False)))
    else:
        kept = chosen(state.join(new, keys, "left"), F.coalesce(wins, F.lit(False)))
        hits = state.select(*[name(k) for k in keys]).join(newest.select(*[name(k) for k in keys]), keys, "left_semi")
        added = newest.join(hits, keys, "left_anti").select(
            *[name(k) for k in keys], *[_live(c, values).cast(kind[c]).alias(c) for c in carried], F.when(F.col(GONE), at).alias(GONE_AT),
        )
        merged = kept.unionByName(added)
    return merged.select(*[name(c) for c in state.columns])


def _live(column: str, values: list[str]) -> Column:
    """A value of a change, null in a tombstone."""
    return F.when(~F.col(GONE), name(column)) if column in values else name(column)


def apply_changes(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Insert, update and delete by a change feed with an ``op`` column."""
    return merge(target, changes, keys, order)


def removed_keys(target: DataFrame, changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keys of the target that the changes delete."""
    newest = _newest_state(target.select(*[name(c) for c in keys]), changes, keys, order, "op")
    return target.select(*[name(c) for c in keys]).join(newest.where(GONE).drop(GONE), keys, "left_semi")


def current_state(feed: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows left after a feed that starts with a snapshot: newest per key, deletes removed."""
    return latest(feed, keys, order).where(F.col("op") != DELETE).drop("op", *order)


def dedup(df: DataFrame, key: list[str] | None = None, event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """A batch delivered twice counts once; on a stream within the watermark delay."""
    if df.isStreaming:
        marked = df.withWatermark(event_time, delay)
        return marked.dropDuplicatesWithinWatermark(key) if key else marked.dropDuplicatesWithinWatermark()
    return df.dropDuplicates(key) if key else df.distinct()

