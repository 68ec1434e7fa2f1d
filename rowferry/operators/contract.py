"""Schema contract: row validation, inference, drift and its four policies."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.errors import ConfigError, SchemaDriftError
from rowferry.formats.parse import CORRUPT, as_text, evaluate_once
from rowferry.functions.casts import does_not_fit
from rowferry.functions.records import name
from rowferry.operators.mapping import ERRORS, MARK, add_errors, error_list
from rowferry.operators.widening import grow

_NESTED = (T.StructType, T.ArrayType, T.MapType)

# Faults that mean a record left the schema.
CHANGES = ("added", "dropped", "missing", "type", "type_changed")

# A record family with more fields than this is a map, not a schema.
MAX_FIELDS = 10_000


def validate(df: DataFrame, schema: T.StructType) -> DataFrame:
    """List every fault of every row in ``_errors``; a faultless row has an empty list.

    ``corrupt`` stands alone: the body could not be read. ``missing:<field>``
    is a required field without a value, ``type:<field>`` a value that does not
    fit the declared type.
    """
    readable = name(CORRUPT).isNull() if CORRUPT in df.columns else F.lit(True)
    faults = [F.when(~readable, F.lit("corrupt"))]
    for f in schema.fields:
        present = f.name in df.columns
        value = name(f.name) if present else F.lit(None)
        if not f.nullable:
            faults.append(F.when(readable & value.isNull(), F.lit(f"missing:{f.name}")))
        if present and df.schema[f.name].dataType != f.dataType:
            faults.append(F.when(readable & _misfit(value, f.dataType), F.lit(f"type:{f.name}")))
    return add_errors(df, faults)


def _misfit(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, _NESTED):
        return text.isNotNull() & _nested(text, kind)[CORRUPT].isNotNull()
    return does_not_fit(text, kind)


def _from_text(text: Column, kind: T.DataType) -> Column:
    return _nested(text, kind)["v"] if isinstance(kind, _NESTED) else text.try_cast(kind)


def _nested(text: Column, kind: T.DataType) -> Column:
    """JSON text of a nested value as field ``v``, with ``_corrupt`` set when any part does not fit."""
    around = T.StructType([T.StructField("v", kind), T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), around, options)


def conform(df: DataFrame, schema: T.StructType, carry: Iterable[str] = ()) -> DataFrame:
    """The declared fields in their declared types (values that do not fit become null)."""
    def typed(f: T.StructField) -> Column:
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType)
        if df.schema[f.name].dataType == f.dataType:
            return name(f.name)
        return _from_text(name(f.name), f.dataType)

    return df.select(*[typed(f).alias(f.name) for f in schema.fields], *[name(c) for c in carry if c in df.columns])


def infer_fields(df: DataFrame, column: str, first: int | None = None) -> DataFrame:
    """``field, type`` rows of JSON objects, types merged over all records.

    ``first`` restricts the reading to that many records (one poll of the
    source); without it the whole table is read. Types merge on the map side.
    """
    records = df.select(name(column)) if first is None else df.select(name(column)).limit(first)
    variants = records.select(F.try_parse_json(name(column)).alias("v"))
    pairs = variants.lateralJoin(variants.sparkSession.tvf.variant_explode_outer(F.col("v").outer()))
    found = pairs.where(F.col("key").isNotNull())
    return found.groupBy(F.col("key").alias("field")).agg(F.schema_of_variant_agg("value").alias("type"))


def infer_schema(df: DataFrame, column: str, first: int | None = None) -> T.StructType:
    """The inferred fields as a schema for :func:`rowferry.formats.parse.parse_json`."""
    fields = infer_fields(df, column, first).orderBy("field").take(MAX_FIELDS + 1)
    if len(fields) > MAX_FIELDS:
        raise ConfigError(f"more than {MAX_FIELDS} distinct fields: declare a schema instead")
    ddl = ", ".join(f"{_quoted(r.field)} {_sql_type(r.type)}" for r in fields)
    return T.StructType.fromDDL(ddl) if ddl else T.StructType([])


# A quoted name, a name before its colon, or a type.
_TYPE_PART = re.compile(r"`(?:[^`]|``)*`|\w+(?=\s*:)|DECIMAL\(\s*\d+\s*,\s*\d+\s*\)|\w+")


def _quoted(field: str) -> str:
    return "`" + field.replace("`", "``") + "`"


def _sql_type(variant_type: str) -> str:
    """The type in SQL; fractional numbers are widened, since later records may need more digits."""
    def part(found: re.Match) -> str:
        text, after = found[0], variant_type[found.end():]
        if text.startswith("`") or after.lstrip().startswith(":"):
            return text
        if text.startswith("DECIMAL"):
            return "DOUBLE"
        return {"OBJECT": "STRUCT", "VOID": "STRING", "VARIANT": "STRING"}.get(text, text)

    return _TYPE_PART.sub(part, variant_type)


def read_records(df: DataFrame, column: str, schema: T.StructType, absent: str = "missing",
                 misfit: str = "type", unknown: bool = True) -> DataFrame:
    """JSON text to the declared fields in their types, with every fault in ``_errors``.

    The usual record is parsed once, straight into its types, and is faultless
    in types when that works. Only a record that does not parse is parsed again
    as text, to tell a broken body from single values that do not fit. Null or
    blank text is a broken body. With
    ``unknown`` a field outside the schema is the fault ``added:<field>``.
    Input columns stay, except those named like a field of the schema.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    mark = T.StructField(CORRUPT, T.StringType())
    typed = F.from_json(name(column), T.StructType(nullable(schema).fields + [mark]), options)
    text = F.from_json(name(column), T.StructType(as_text(schema).fields + [mark]), options)
    keys = F.json_object_keys(name(column)) if unknown else F.lit(None).cast("array<string>")

    # Inside the one-item array, so that no field and no fault computes it again.
    empty_text = F.coalesce(F.trim(name(column)) == "", F.lit(True))

    def with_text(record: Column) -> Column:
        again = F.when(record[CORRUPT].isNotNull(), text)
        return F.struct(record.alias("typed"), again.alias("text"), keys.alias("keys"), empty_text.alias("blank"))

    kept = [name(c) for c in df.columns if c not in schema.names]
    parsed = df.select("*", F.explode(F.transform(F.array(typed), with_text)).alias("_p"))

    blank = F.col("_p.blank")
    fits = F.col("_p.typed")[CORRUPT].isNull() & ~blank
    broken = F.col("_p.text")[CORRUPT].isNotNull() | blank
    found = [F.when(broken, F.lit("corrupt"))]
    if unknown:
        # Records with just the declared names in their order are told by one comparison.
        known = F.array(*[F.lit(n) for n in schema.names])
        extra = F.array_except("_p.keys", known)
        texts = F.concat(F.lit("added:"), F.array_join(extra, f"{MARK}added:"))
        found.append(F.when((F.col("_p.keys") != known) & ~broken & (F.size(extra) > 0), texts))
    values = []
    for f in schema.fields:
        direct, raw = F.col("_p.typed")[f.name], F.col("_p.text")[f.name]
        value = F.when(fits, direct).otherwise(_from_text(raw, f.dataType))
        values.append(value.alias(f.name))
        if not f.nullable:
            empty = F.when(fits, direct.isNull()).otherwise(~broken & raw.isNull())
            found.append(F.when(empty, F.lit(f"{absent}:{f.name}")))
        found.append(F.when(~fits & ~broken & _misfit(raw, f.dataType), F.lit(f"{misfit}:{f.name}")))
    errors = error_list(found)
    if ERRORS in df.columns:
        errors, kept = F.concat(F.col(ERRORS), errors), [name(c) for c in df.columns if c not in schema.names + [ERRORS]]
    # Filters on the result would otherwise compute these once more each.
    made = evaluate_once(parsed.select(*kept, "_p", *([ERRORS] if ERRORS in df.columns else [])), "_r",
                         F.struct(*values, errors.alias(ERRORS)))
    return made.select(*kept, "_r.*")


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def mark_drift(df: DataFrame, column: str, expected: T.StructType) -> DataFrame:
    """The declared fields, and each record's drift in ``_errors`` as ``<change>:<field>``.

    Changes are ``added``, ``dropped`` (a required field that is absent) and
    ``type_changed``.
    """
    return read_records(df, column, expected, "dropped", "type_changed")


def drift(df: DataFrame, column: str, expected: T.StructType) -> DataFrame:
    """``field, change, n``: fields added, dropped or of another type, with row counts.

    Text that is no JSON object is not drift; :func:`validate` reports it.
    """
    everything = T.StructType([T.StructField(f.name, f.dataType, False) for f in expected.fields])
    return drift_of_errors(mark_drift(df.select(name(column)), column, everything))


def drift_of_errors(marked: DataFrame) -> DataFrame:
    """``field, change, n`` from rows that are marked already."""
    faults = marked.select(F.explode(ERRORS).alias("e"))
    change = F.substring_index("e", ":", 1)
    field = F.substring(F.col("e"), F.length(change) + 2, F.length("e"))
    found = faults.where(change.isin(*CHANGES))
    return found.groupBy(field.alias("field"), change.alias("change")).agg(F.count("*").alias("n"))


def grown(df: DataFrame, column: str, known: T.StructType, add: bool, types: bool) -> T.StructType:
    """``known`` after what the records show: with ``add`` new fields, with ``types`` wider types.

    One pass; only records that do not fit ``known`` are looked at again. The
    values of a field are joined kind by kind, so one word among numbers does
    not keep a fraction from widening them.
    """
    marked = read_records(df.select(name(column)), column, nullable(known), unknown=add)
    odd = marked.where(F.exists(ERRORS, lambda e: e.startswith("added:") | e.startswith("type:"))).select(name(column).alias("j"))
    variants = odd.select(F.try_parse_json("j").alias("v"))
    pairs = variants.lateralJoin(variants.sparkSession.tvf.variant_explode_outer(F.col("v").outer())).where(F.col("key").isNotNull())
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    found = pairs.groupBy(F.col("key").alias("field"), kind.alias("kind")).agg(F.schema_of_variant_agg("value").alias("type"))
    seen = found.orderBy("field", "kind").take(MAX_FIELDS + 1)
    if len(seen) > MAX_FIELDS:
        raise ConfigError(f"more than {MAX_FIELDS} distinct fields: declare a schema instead")
    return grow(known, [T.StructField(r.field, _kind_of(r.type)) for r in seen], add, types)


def _kind_of(variant_type: str) -> T.DataType:
    return T.NullType() if variant_type == "VOID" else T.StructType.fromDDL(f"v {_sql_type(variant_type)}")["v"].dataType


def halt_on_drift(df: DataFrame, column: str, expected: T.StructType) -> DataFrame:
    """Raise when any record drifts, before anything is written."""
    first = mark_drift(df, column, expected).where(F.size(ERRORS) > 0).select(ERRORS).first()
    if first is not None:
        raise SchemaDriftError("; ".join(first[0]))
    return df


def drop_unknown(df: DataFrame, column: str, expected: T.StructType) -> DataFrame:
    """The expected fields and ``_errors``; unknown fields go without notice.

    A broken body or a value that does not fit is a fault, beside the null it leaves.
    """
    kept = [c for c in df.columns if c != column and c not in [*expected.names, ERRORS]]
    found = read_records(df, column, nullable(expected), unknown=False)
    return found.select(*[name(c) for c in [*kept, *expected.names, ERRORS]])


def pack_unknown(df: DataFrame, column: str, expected: T.StructType, into: str = "payload") -> DataFrame:
    """The expected fields, all others as JSON text in one column (null when there are none), and ``_errors``.

    A broken body or an expected value that does not fit is a fault.
    """
    kept = [c for c in df.columns if c != column and c not in [*expected.names, ERRORS]]
    names = F.array(*[F.lit(n) for n in expected.names])
    everything = F.from_json(name(column), T.MapType(T.StringType(), T.StringType()))
    rest = F.map_filter(everything, lambda k, _: ~F.array_contains(names, k))
    packed = evaluate_once(df, "_rest", rest)
    found = read_records(packed, column, nullable(expected), unknown=False)
    text = F.when(F.map_keys("_rest") != F.array().cast("array<string>"), F.to_json("_rest")).alias(into)
    return found.select(*[name(c) for c in [*kept, *expected.names]], text, ERRORS)


def widen(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Old rows and new rows under the wider schema; missing fields are null."""
    return target.unionByName(batch, allowMissingColumns=True)
