"""How a schema may grow: a lattice of types, and older rows read under a newer schema."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.records import name

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_FRACTIONAL = (T.FloatType, T.DoubleType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def join_types(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds the values of both, or None.

    Whole numbers grow by length, then to DOUBLE beside fractions (as Spark's
    own inference does; over 2^53 they lose digits there). Dates grow to
    timestamps, null to anything, nested types part by part. Text holds no
    other type: a word where numbers were declared is a fault, not growth.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return _join_numbers(a, b)
    for day, time in ((a, b), (b, a)):
        if isinstance(day, T.DateType) and isinstance(time, _TIMES):
            return time
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = join_types(a.elementType, b.elementType)
        return element and T.ArrayType(element, a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = join_types(a.keyType, b.keyType), join_types(a.valueType, b.valueType)
        return T.MapType(key, value, a.valueContainsNull or b.valueContainsNull) if key and value else None
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _join_structs(a, b)
    return None


def _join_numbers(a: T.NumericType, b: T.NumericType) -> T.DataType:
    if isinstance(a, _FRACTIONAL) or isinstance(b, _FRACTIONAL):
        return T.DoubleType()
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda kind: _WHOLE.index(type(kind)))
    sizes = [(k.precision - k.scale, k.scale) if isinstance(k, T.DecimalType) else (_DIGITS[type(k)], 0) for k in (a, b)]
    before, after = (max(parts) for parts in zip(*sizes))
    return T.DecimalType(before + after, after) if before + after <= 38 else T.DoubleType()


def _join_structs(a: T.StructType, b: T.StructType) -> T.StructType | None:
    """Fields by name; one that only one side has may be null."""
    others = {f.name: f for f in b.fields}
    joined = []
    for f in a.fields:
        other = others.pop(f.name, None)
        kind = join_types(f.dataType, other.dataType) if other else f.dataType
        if kind is None:
            return None
        joined.append(T.StructField(f.name, kind, f.nullable or other is None or other.nullable))
    return T.StructType(joined + [T.StructField(f.name, f.dataType, True) for f in b.fields if f.name in others])


def grow(known: T.StructType, seen: Iterable[T.StructField], add: bool, types: bool) -> T.StructType:
    """``known`` after fields that were seen; a type that nothing joins with stays as it is.

    ``seen`` may name a field several times, once for each kind of value. With
    ``add`` fields outside ``known`` come last, in the order of their names;
    where the kinds of a new field do not join it is text.
    """
    kinds = {f.name: f.dataType for f in known.fields}
    new: dict[str, T.DataType] = {}
    for f in seen:
        if f.name in kinds:
            kinds[f.name] = (join_types(kinds[f.name], f.dataType) if types else None) or kinds[f.name]
        elif add:
            new[f.name] = join_types(new.get(f.name, T.NullType()), f.dataType) or T.StringType()
    return T.StructType(
        [T.StructField(f.name, kinds[f.name], f.nullable) for f in known.fields]
        + [T.StructField(n, T.StringType() if isinstance(k, T.NullType) else k, True) for n, k in sorted(new.items())]
    )


def changes(before: T.StructType, after: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """``field, change, before, after`` between two versions, in the order of the fields."""
    old, new = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (before, after))
    found = [(n, "dropped", kind, None) for n, kind in old.items() if n not in new]
    for n, kind in new.items():
        if n not in old:
            found.append((n, "added", None, kind))
        elif old[n] != kind:
            found.append((n, "type_changed", old[n], kind))
    return found


def resolve(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of an older version under a newer one: values grow, absent fields are null."""
    def column(f: T.StructField) -> Column:
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return _grown(name(f.name), df.schema[f.name].dataType, f.dataType).alias(f.name)

    return df.select(*[column(f) for f in schema.fields])


def _grown(value: Column, old: T.DataType, new: T.DataType) -> Column:
    if old == new:
        return value
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        had = {f.name: f.dataType for f in old.fields}
        parts = [
            (_grown(value.getField(f.name), had[f.name], f.dataType) if f.name in had else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in new.fields
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return F.transform(value, lambda e: _grown(e, old.elementType, new.elementType))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType) and old.keyType == new.keyType:
        return F.transform_values(value, lambda _, v: _grown(v, old.valueType, new.valueType))
    return value.cast(new)


def union_versions(parts: list[DataFrame]) -> DataFrame:
    """Rows of several versions under the least schema that holds them all.

    Raises ValueError where two versions have types that nothing joins.
    """
    schema = reduce(lambda a, b: _join_structs(a, b) if a else None, [p.schema for p in parts])
    if schema is None:
        raise ValueError("these versions have a field whose types do not join")
    return reduce(DataFrame.unionByName, [resolve(p, schema) for p in parts])
