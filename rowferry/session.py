"""Session settings and the shared staging folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from typing import Any
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rowferry.functions.casts import constant

STAGING_SETTING = "spark.checkpoint.dir"
ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

# Keys appear in query plans as hexadecimal literals; this hides them there.
_KEY_LITERAL = r"0x[0-9A-Fa-f]{32,64}"

_local_roots: dict[str, str] = {}
_shipped: set[str] = set()
_staged: WeakKeyDictionary[DataFrame, tuple[str, ...]] = WeakKeyDictionary()
_scratch = threading.local()


def build_session(app_name: str = "rowferry", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings this package is tested with.

    The cluster decides about memory, executors and shuffle partitions; only
    settings that change results or protect keys are fixed here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Set UTC, hide key literals in plans, and send this package to the executors."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.redaction.string.regex", _KEY_LITERAL)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers, once per application.

    User functions, sources and sinks run there. A cluster that has the
    package installed can set ``spark.rowferry.ship`` to ``false``.
    """
    app = spark.conf.get("spark.app.id", "local")
    if app in _shipped or spark.conf.get("spark.rowferry.ship", "true") == "false":
        return
    source = os.path.dirname(os.path.abspath(__file__))
    if not os.path.isdir(source):
        return  # imported from an archive, so it was sent along already
    base = os.path.join(tempfile.mkdtemp(prefix="rowferry-package-"), "rowferry")
    archive = shutil.make_archive(base, "zip", os.path.dirname(source), os.path.basename(source))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


@contextmanager
def sql_settings(spark: SparkSession, settings: dict[str, Any]) -> Iterator[None]:
    """Set SQL options for one write and put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def staging_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    root = spark.conf.get(STAGING_SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {STAGING_SETTING} to a folder that all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="rowferry-")
    return _local_roots[app]


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared staging folder."""
    return f"{staging_root(spark)}/rowferry/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the staging folder and read it back.

    Cuts the lineage without keeping blocks on executors, fixes values that a
    task retry could change, and gives the optimizer a size on disk to decide
    about broadcasts with. Texts take a third less there than by Spark's own codec.
    """
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path, compression="zstd")
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    _staged[found] = (path,)
    if getattr(_scratch, "open", None):
        _scratch.open[-1][path] = found.sparkSession
    return found


def together(tables: list[DataFrame]) -> DataFrame:
    """Staged tables as one, which can be kept or discarded like each of them."""
    found = reduce(DataFrame.unionAll, tables)
    _staged[found] = tuple(dict.fromkeys(path for table in tables for path in _staged.get(table, ())))
    return found


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stage`` gave. Nothing that reads them may run later."""
    for table in tables:
        for path in _staged.pop(table, ()):
            _delete(table.sparkSession, path)
            for own in getattr(_scratch, "open", []):
                own.pop(path, None)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables staged inside are deleted at its end, but those given to the function it yields.

    After an error they stay, as the tables of a job that was killed do.
    """
    own: dict[str, SparkSession] = {}
    kept: set[str] = set()
    _scratch.open = [*getattr(_scratch, "open", []), own]

    def keep(table: DataFrame) -> DataFrame:
        kept.update(_staged.get(table, ()))
        return table

    try:
        yield keep
    finally:
        _scratch.open = _scratch.open[:-1]
    for path, spark in own.items():
        if path not in kept:
            _delete(spark, path)
        elif _scratch.open:
            _scratch.open[-1][path] = spark


def one_row(spark: SparkSession, schema: T.StructType, *values: Any) -> DataFrame:
    """A table of one row, made without shipping Python objects."""
    cells = [constant(v, f.dataType).alias(f.name) for f, v in zip(schema.fields, values)]
    return spark.range(1, numPartitions=1).select(*cells)
