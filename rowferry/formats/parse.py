"""Parsers. Text that does not fit is marked, never turned to null unseen."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.errors import ConnectorMissing
from rowferry.functions.records import name

CORRUPT = "_corrupt"


def evaluate_once(df: DataFrame, column: str, expression: Column) -> DataFrame:
    """Add a costly column that later filters must not compute a second time.

    Catalyst moves a filter below a projection by copying the projected
    expression into it, so a parse would run twice for each row. A generator
    over a one-item array is not copied.
    """
    return df.select("*", F.explode(F.array(expression)).alias(column))


def parse_json(df: DataFrame, column: str, schema: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """JSON text to the columns of ``schema`` plus ``_corrupt``.

    ``_corrupt`` holds the raw text when the body is broken or a value has the
    wrong type. ``keep`` names the input columns that stay (default: all).
    """
    kept = [c for c in (df.columns if keep is None else keep) if c not in schema.names]
    target = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(name(column), target, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    once = evaluate_once(df.select(*{c: name(c) for c in kept + [column]}.values()), "_parsed", parsed)
    return once.select(*[name(c) for c in kept], "_parsed.*")


def as_text(schema: T.StructType) -> T.StructType:
    """The same fields, all as text: the shape to validate value by value."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def parse_csv(df: DataFrame, column: str, schema: T.StructType, options: dict[str, str] | None = None) -> DataFrame:
    """One delimited line per row to the columns of ``schema`` plus ``_corrupt``."""
    target = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    wanted = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **(options or {})}
    parsed = F.from_csv(name(column), F.lit(target.toDDL()), wanted)
    return evaluate_once(df, "_parsed", parsed).select(*[name(c) for c in df.columns if c != column], "_parsed.*")


def parse_xml(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """One XML element per row to the columns of ``schema`` plus ``_corrupt``."""
    target = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_xml(name(column), target, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return evaluate_once(df, "_parsed", parsed).select(*[name(c) for c in df.columns if c != column], "_parsed.*")


def parse_avro(df: DataFrame, column: str, schema_json: str) -> DataFrame:
    """Avro bytes to columns; needs Spark's own avro package on the class path."""
    from pyspark.sql.avro.functions import from_avro

    return _with_package(df, column, "spark-avro", lambda c: from_avro(c, schema_json, {"mode": "PERMISSIVE"}))


def parse_protobuf(df: DataFrame, column: str, message: str, descriptor_path: str) -> DataFrame:
    """Protobuf bytes to columns; needs Spark's own protobuf package on the class path."""
    from pyspark.sql.protobuf.functions import from_protobuf

    return _with_package(
        df, column, "spark-protobuf",
        lambda c: from_protobuf(c, message, descriptor_path, {"mode": "PERMISSIVE"}),
    )


def _with_package(df: DataFrame, column: str, package: str, parse) -> DataFrame:
    try:
        parsed = evaluate_once(df, "_parsed", parse(name(column)))
        return parsed.select(*[name(c) for c in df.columns if c != column], "_parsed.*")
    except (AnalysisException, TypeError) as missing:
        if "NOT_LOADED" in str(missing) or "JavaPackage" in str(missing):
            raise ConnectorMissing(f"the package {package} is not on the class path") from missing
        raise


def flatten(df: DataFrame, sep: str = "_", explode_arrays: bool = False) -> DataFrame:
    """Nested structs to ``a_b`` columns; arrays stay unless asked otherwise."""
    leaves: list[Column] = []
    arrays: list[str] = []

    def walk(fields: list[T.StructField], reach: Column | None, prefix: str) -> None:
        for f in fields:
            here = name(f.name) if reach is None else reach.getField(f.name)
            label = f.name if not prefix else f"{prefix}{sep}{f.name}"
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType.fields, here, label)
            else:
                leaves.append(here.alias(label))
                if isinstance(f.dataType, T.ArrayType):
                    arrays.append(label)

    walk(df.schema.fields, None, "")
    flat = df.select(*leaves)
    if not (explode_arrays and arrays):
        return flat
    for label in arrays:
        flat = flat.withColumn(label, F.explode_outer(name(label)))
    return flatten(flat, sep, explode_arrays)
