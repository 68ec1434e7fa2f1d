"""Short spelling for schemas; needs no session, so workers can import it too."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()


def fields(nullable: bool = True, **types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(label, kind, nullable) for label, kind in types.items()])
