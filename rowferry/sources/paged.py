"""Tables kept in an order, with an index of positions, so that a far page is as cheap as a near one.

The rows lie in one folder per range of the order, each with its place in the
range; beside them is the number of rows of each range. A page reads the
folders it falls into and no others. Rows that are equal in the order have one
place each for as long as the copy stays, so pages never overlap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.errors import ConfigError
from rowferry.functions.records import name
from rowferry.operators.numbering import in_ranges
from rowferry.schemas import LONG, fields

RANGE, PLACE = "_range", "_place"
_COUNTS = fields(**{RANGE: LONG, "rows": LONG})


def write_pages(df: DataFrame, order: list[str], path: str) -> None:
    """Keep ``df`` in the order of ``order`` below ``path``, which is replaced.

    One range shuffle and one write; rows equal in the order are spread over
    ranges by a random last key. Null comes first.
    """
    clash = [c for c in df.columns if c.lower() in (RANGE, PLACE)]
    if clash:
        raise ConfigError(f"columns {clash} clash with those of a paged table")
    placed = in_ranges(df, order, RANGE, PLACE)
    placed.write.mode("overwrite").partitionBy(RANGE).parquet(f"{path}/rows")
    stored = df.sparkSession.read.schema(T.StructType([*_COUNTS.fields[:1]])).parquet(f"{path}/rows")
    counts = stored.groupBy(RANGE).agg(F.count("*").alias("rows"))
    counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/counts")


def read_page(spark: SparkSession, path: str, schema: T.StructType, page: int, per_page: int) -> DataFrame:
    """Page ``page`` (from 0) of a paged table, in its order; empty beyond the last one."""
    if page < 0 or per_page < 1:
        raise ConfigError("a page has a number from 0 and at least one row")
    start, end = page * per_page, (page + 1) * per_page
    wanted, seen = F.lit(False), 0
    # As many rows as there are ranges.
    for row in spark.read.schema(_COUNTS).parquet(f"{path}/counts").orderBy(RANGE).collect():
        low, high = max(start - seen, 0), min(end - seen, row.rows)
        if low < high:
            wanted = wanted | ((F.col(RANGE) == row[RANGE]) & (F.col(PLACE) >= low) & (F.col(PLACE) < high))
        seen += row.rows
    stored = T.StructType([*schema.fields, *fields(**{PLACE: LONG, RANGE: LONG}).fields])
    rows = spark.read.schema(stored).parquet(f"{path}/rows").where(wanted)
    return rows.orderBy(RANGE, PLACE).select(*[name(c) for c in schema.names])


def page_count(spark: SparkSession, path: str, per_page: int) -> int:
    """Pages of that size, the last one maybe shorter."""
    rows = spark.read.schema(_COUNTS).parquet(f"{path}/counts").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    return -(-rows // per_page)
