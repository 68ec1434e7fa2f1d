"""Pages by the index of positions."""

import pytest
from plans import plan
from pyspark.sql import functions as F

from rowferry.errors import ConfigError
from rowferry.sources import paged


def pages(spark, path, schema, per_page):
    count = paged.page_count(spark, path, per_page)
    return [paged.read_page(spark, path, schema, page, per_page).collect() for page in range(count)]


def test_pages_are_disjoint_and_whole_with_ties(spark, tmp_path):
    path = str(tmp_path / "t")
    # One value holds most of the rows, some are null, and whole rows repeat.
    table = spark.range(1000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 7).when(F.col("id") % 10 < 9, 3).alias("v"), (F.col("id") % 500).alias("w"))
    paged.write_pages(table, ["v"], path)
    found = pages(spark, path, table.schema, 130)
    assert [len(p) for p in found] == [130] * 7 + [90]
    read = [row for page in found for row in page]
    assert sorted(read, key=str) == sorted(table.collect(), key=str)
    values = [-1 if row.v is None else row.v for row in read]
    assert values == sorted(values)
    assert pages(spark, path, table.schema, 130) == found
    assert paged.read_page(spark, path, table.schema, 8, 130).count() == 0


def test_a_page_reads_its_own_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.range(4000)
    # Without adaptive execution no ranges are joined, small as they are.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        paged.write_pages(table, ["id"], path)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    page = paged.read_page(spark, path, table.schema, 35, 100)
    assert [r.id for r in page.collect()] == list(range(3500, 3600))
    counts = spark.read.parquet(f"{path}/counts").count()
    files = page.inputFiles()
    assert counts == 4 and 1 <= len({f.split("_range=")[1].split("/")[0] for f in files}) <= 4
    assert "PartitionFilters: [" in plan(page) and "PushedFilters: []" not in plan(page)


def test_odd_columns_empty_tables_and_wrong_pages(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    empty = rows("`a.b` STRING, rows INT")
    paged.write_pages(empty, ["a.b"], path)
    assert paged.page_count(spark, path, 10) == 0 and paged.read_page(spark, path, empty.schema, 0, 10).count() == 0
    few = rows("`a.b` STRING, rows INT", ("y", 2), (None, 3), ("x", None))
    paged.write_pages(few, ["a.b", "rows"], path)
    assert [r["a.b"] for r in paged.read_page(spark, path, few.schema, 0, 10).collect()] == [None, "x", "y"]
    with pytest.raises(ConfigError):
        paged.read_page(spark, path, few.schema, -1, 10)
    with pytest.raises(ConfigError):
        paged.write_pages(rows("_Place INT", (1,)), ["_Place"], path)
