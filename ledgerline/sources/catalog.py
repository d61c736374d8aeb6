"""Catalog tables: declare over a location, look up, reload with a dense key."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerline.operators.numbering import number_rows
from ledgerline.session import scratch_path


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str, fmt: str = "parquet") -> None:
    """Declare an external table, and its database, unless they are there."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} LOCATION '{location}'")


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    if not spark.catalog.tableExists(name):
        raise LookupError(f"no table {name}")
    return spark.table(name)


def describe_table(spark: SparkSession, name: str) -> tuple[str, list[str]]:
    """Where the table lies and the names of its columns."""
    columns = [c.name for c in spark.catalog.listColumns(name)]
    detail = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'")
    return detail.first()["data_type"], columns


def reload_table(
    df: DataFrame,
    name: str,
    key: str,
    order_by: Sequence[str],
    location: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Replace the rows of table ``name`` by ``df`` with a new ``key``: 1, 2, 3, … in order.

    The table is created if it is absent, as an external Parquet table. The new rows are written to a
    folder of their own beside ``location``, then the table is pointed there: until that moment, and if
    the write fails, it has its old rows. The folder with the old rows is left for who still reads it.
    """
    spark = df.sparkSession
    numbered = number_rows(df, order_by, name=key, unique=unique).select(F.col(key), *df.columns)
    exists = spark.catalog.tableExists(name)
    if exists:
        numbered = numbered.select(*[F.col(f.name).cast(f.dataType) for f in spark.table(name).schema])
        base = location or describe_table(spark, name)[0].rsplit("/rows-", 1)[0]
    else:
        base = location or scratch_path(spark, name.replace(".", "-"))
    rows = f"{base.rstrip('/')}/rows-{uuid.uuid4().hex}"
    numbered.write.parquet(rows)
    if exists:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{rows}'")
        spark.catalog.refreshTable(name)
    else:
        create_table(spark, name, numbered.schema, rows)
    return spark.table(name)
