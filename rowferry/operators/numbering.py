"""Row numbers over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowferry.functions.records import name
from rowferry.session import stage

BROADCAST_ROWS = 100_000

# monotonically_increasing_id keeps the row's place within its task in these bits.
_PLACE_BITS = 33


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast when it has at most ``max_rows`` rows.

    The count stops at the bound. Above it ``df`` comes back unmarked and Spark
    joins by shuffle.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def in_ranges(df: DataFrame, order: list[str], range_name: str, place_name: str) -> DataFrame:
    """Rows sorted within ranges of the order, with the number of the range and the place in it, from 0.

    A random last key spreads rows that are equal in ``order`` over several
    ranges. Write the result before it is read twice: a place holds for one run.
    """
    keys = [name(c).asc() for c in order] + [F.col("_spread").asc()]
    sorted_rows = df.withColumn("_spread", F.rand(0)).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_spread")
    at = sorted_rows.withColumn("_at_", F.monotonically_increasing_id())
    return at.select(
        *[name(c) for c in df.columns], F.col("_at_").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias(place_name),
        F.shiftright("_at_", _PLACE_BITS).alias(range_name),
    )


def number_rows(df: DataFrame, order: list[str], into: str = "row_number") -> DataFrame:
    """Add the 0-based position of each row in the order of ``order``.

    Rows are range-partitioned and sorted, staged once, and counted per range;
    a row's number is the count of all earlier ranges plus its place in its
    own. Only one count per range is gathered. A random last key spreads rows
    that are equal in ``order`` over several ranges.
    """
    keys = [name(c).asc() for c in order] + [F.col("_spread").asc()]
    sorted_rows = (
        df.withColumn("_spread", F.rand(0)).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_spread")
    )
    placed = stage(sorted_rows.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    here = F.shiftright("_place", _PLACE_BITS)
    counts = placed.groupBy(here.alias("_range")).agg(F.count("*").alias("_rows"))
    # One row per range, so this window sees a few thousand rows at most.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    # At most one row per shuffle partition, so the size of this side is known beforehand.
    if int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    joined = placed.withColumn("_range", here).join(starts, "_range")
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return joined.select(*[name(c) for c in df.columns], (F.col("_start") + place).alias(into))
