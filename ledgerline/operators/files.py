"""Choosing files: by name and by what was seen before."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerline.operators.joins import BROADCAST_BYTES, keyed_join


def path_filter(files: DataFrame, column: str, prefix: str = "", suffix: str = ".csv") -> DataFrame:
    """Rows whose path starts and ends as given; both tests reach a Parquet scan."""
    return files.where(F.col(column).startswith(prefix) & F.col(column).endswith(suffix))


def unseen(files: DataFrame, seen: DataFrame, key: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``files`` whose ``key`` is not among those of ``seen``."""
    names = seen.select(key)
    return keyed_join(files, names.distinct(), key, "left_anti", broadcast_bytes, measure=names)
