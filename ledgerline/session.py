"""Session settings, shared scratch space and option lookup."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_passing = threading.local()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder in the storage all executors share.

    That is ``spark.checkpoint.dir``, or where it is unset a folder in the warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and return the table.

    Fixes the rows, so later reads agree with each other whatever executors are lost.
    """
    path = scratch_path(df.sparkSession, name)
    for paths in getattr(_passing, "paths", ()):
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that are materialized inside, by this thread, are removed at the end.

    For work that is done with its tables when it ends, such as one batch of a stream; what is read from them
    must be written by then. Only folders made in here are touched, each by its own unused name.
    """
    paths: list[str] = []
    _passing.paths = [*getattr(_passing, "paths", ()), paths]
    try:
        yield
    finally:
        _passing.paths = _passing.paths[:-1]
        hadoop = spark._jsc.hadoopConfiguration()
        for path in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(hadoop).delete(at, True)


def resolve_option(
    spark: SparkSession,
    key: str,
    value: str | None = None,
    default: str | None = "",
    required: bool = False,
) -> str | None:
    """``value`` if given, else the session setting ``key``, else ``default`` (or an error)."""
    found = value if value else spark.conf.get(key, None)
    if found:
        return found
    if required:
        raise ValueError(f"no value given and {key} is not set")
    return default


def ship_package(spark: SparkSession) -> None:
    """Let the executors import this package, once per application (as ``--py-files`` would)."""
    context = spark.sparkContext
    name = f"{__package__}.zip"
    if name in context._python_includes:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix=f"{__package__}-"), name)
    with zipfile.ZipFile(path, "w") as bundle:
        for folder, _, files in os.walk(home):
            for file in files:
                if file.endswith(".py"):
                    full = os.path.join(folder, file)
                    bundle.write(full, os.path.join(__package__, os.path.relpath(full, home)))
    context.addPyFile(path)
