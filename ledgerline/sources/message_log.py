"""A log of messages with positions 0, 1, 2, … over all that was ever appended to it.

``rows/from=N`` holds the messages of one append, sorted by ``offset``; an empty folder ``marks/from=N/to=M`` is made
after them and makes them part of the log. An append that was cut short left no mark, and the next one
overwrites its rows. One writer at a time; any number of readers.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.operators.numbering import number_rows

SCHEMA = "offset bigint, value string"

_MARK = re.compile(r"from=(\d+)/to=(\d+)$")


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``path``, one of those that Arrow knows: local, HDFS, S3, GCS."""
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", re.sub(r"^s3[an]:", "s3:", path)))


def appends(log: str) -> list[tuple[int, int]]:
    """First offset and end of each append, in order. Lists the marks only, and needs no session."""
    system, path = _folder(log)
    found = system.get_file_info(fs.FileSelector(f"{path}/marks", allow_not_found=True, recursive=True))
    return sorted((int(m[1]), int(m[2])) for m in map(_MARK.search, (f.path for f in found)) if m)


def log_end(log: str) -> int:
    """The offset that the next message will get."""
    return max((end for _, end in appends(log)), default=0)


def append_messages(messages: DataFrame, log: str, order_by: Sequence[str] = ("value",), unique: bool = False) -> tuple[int, int]:
    """Append the column ``value`` of ``messages``, in order; returns the first offset and the end.

    ``unique`` promises that ``order_by`` tells messages apart. No messages leave the log as it is.
    """
    first = log_end(log)
    numbered = number_rows(messages, order_by, name="_number", unique=unique)
    placed = numbered.select((F.col("_number") - 1 + first).alias("offset"), "value")
    rows = f"{log}/rows/from={first}"
    placed.sortWithinPartitions("offset").write.mode("overwrite").parquet(rows)
    end = messages.sparkSession.read.schema(SCHEMA).parquet(rows).agg(F.max("offset")).first()[0]
    if end is None:
        return first, first
    system, path = _folder(log)
    system.create_dir(f"{path}/marks/from={first}/to={end + 1}", recursive=True)
    return first, end + 1


def read_log(spark: SparkSession, log: str, first: int = 0, end: int | None = None) -> DataFrame:
    """``offset`` and ``value`` of the messages from ``first`` up to and without ``end``.

    Only the appends that hold them are opened; in these the offsets reach the scan, which passes over
    row groups that lie outside.
    """
    end = log_end(log) if end is None else end
    holding = [f"{log}/rows/from={a}" for a, b in appends(log) if a < end and b > first]
    if not holding:
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(SCHEMA).parquet(*holding)
    return rows.where((F.col("offset") >= first) & (F.col("offset") < end))
