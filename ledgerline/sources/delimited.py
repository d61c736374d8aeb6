"""Pipe-delimited files: write, read as columns, read as raw lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerline.operators.numbering import sort_rows

# A separator and a quote built from code points that Unicode never assigns, so that
# the CSV source hands over each line untouched.
_NO_SEPARATOR = "\uffff\ufffe\uffff\ufffe"
_NO_QUOTE = "\ufffe"

LINE_OPTIONS = {
    "sep": _NO_SEPARATOR,
    "quote": _NO_QUOTE,
    "escape": _NO_QUOTE,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "emptyValue": "",
}


def _field_options(null_value: str | None) -> dict[str, str]:
    options = {
        "sep": "|",
        "header": "true",
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    if null_value is not None:
        options["nullValue"] = null_value
    return options


def write_delimited(
    df: DataFrame,
    path: str,
    order_by: Sequence[str] = (),
    unique_order: bool = False,
    null_value: str | None = None,
    max_records_per_file: int = 0,
    mode: str = "overwrite",
) -> None:
    """Write pipe-separated files with a header line in each.

    ``order_by`` sorts globally: file names in order hold the rows in order, whatever the size.
    """
    out = sort_rows(df, order_by, unique=unique_order) if order_by else df
    writer = out.write.mode(mode).options(**_field_options(null_value))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.csv(path)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    null_value: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Read pipe-separated files with a header; without ``schema`` every column is text.

    The header must have the names of ``schema`` in its order, else the read fails.
    ``null_value`` (say ``\\N``, given on write too) keeps null and empty text apart. ``multiline`` is
    for newlines inside quoted values; it reads a file in one task, so write with
    ``max_records_per_file``.
    """
    reader = spark.read.options(**_field_options(null_value))
    if null_value is not None:
        reader = reader.option("emptyValue", "")
    if multiline:
        reader = reader.option("multiLine", "true")
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", "false")
    return reader.csv(path)


def write_lines(df: DataFrame, path: str, header: str, partition_by: Sequence[str] = ()) -> None:
    """Write the column ``line`` as it is, one file per task, each file with a first line ``header``."""
    kept = [F.col(name) for name in partition_by]
    out = df.select(F.col("line").alias(header), *kept)
    writer = out.write.mode("overwrite").options(**LINE_OPTIONS).option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    header: bool = True,
    glob: str = "*.csv",
    position: bool = False,
) -> DataFrame:
    """Raw lines as column ``line``; blank lines and the first line of each file are left out.

    Files are taken from nested folders too and split over tasks. ``position`` adds ``file``,
    ``block`` and ``seq``, which order the lines of a file although it is read in pieces: ``block`` is
    where the piece starts, ``seq`` grows within a task. The pieces may differ between two reads, so
    write the lines before comparing positions.
    """
    lines = (
        spark.read.schema("line string")
        .options(**LINE_OPTIONS)
        .option("header", str(header).lower())
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .csv(path)
    )
    if not position:
        return lines.select("line")
    return add_sequence(lines.select("line", *file_columns()))


def file_columns() -> list:
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    ]


def add_sequence(lines: DataFrame) -> DataFrame:
    return lines.withColumn("seq", F.monotonically_increasing_id())
