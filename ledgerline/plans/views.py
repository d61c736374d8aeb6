"""The given tables as records and as the lines of files with faults in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.functions.text import to_line
from ledgerline.schemas import ORDER_RECORD
from ledgerline.session import scratch_path
from ledgerline.sources.delimited import write_lines
from ledgerline.sources.extract import sql_extract

HEADER = "|".join(ORDER_RECORD.names)

# Where the file a line is in matters: lines per file, and where the bad lines are.
FILE_LINES = 5000
BAD_EVERY, BAD_AT = 3001, 1700

# Faults by rec_id % 50; every other line is a plain record.
EMPTY_DATE, EMPTY_GROUP, BAD_AMOUNT, SIXTH_FIELD, PADDED, BLANK, SHORT, BAD_ID, LONG_DATE, FINE_AMOUNT = range(10)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as five-field records."""
    return sql_extract(
        spark,
        """
        SELECT o_orderkey AS rec_id, o_orderpriority AS rec_name, o_orderstatus AS rec_group,
               CAST(o_totalprice AS DECIMAL(12, 2)) AS amount, CAST(o_orderdate AS DATE) AS rec_date
        FROM orders
        """,
        {"orders": table(spark, sf_dir, "orders")},
    )


def clean_line() -> Column:
    return to_line(*[F.col(name).cast("string") for name in ORDER_RECORD.names])


def faulty_line() -> Column:
    """The record's line, with the fault its key picks."""
    fault = F.pmod("rec_id", F.lit(50))
    rec_id, amount, date = (F.col(c).cast("string") for c in ("rec_id", "amount", "rec_date"))
    name, group = F.col("rec_name"), F.col("rec_group")
    none = F.lit("")
    return (
        F.when(fault == EMPTY_DATE, to_line(rec_id, name, group, amount, none))
        .when(fault == EMPTY_GROUP, to_line(rec_id, name, none, amount, date))
        .when(fault == BAD_AMOUNT, to_line(rec_id, name, group, F.lit("x"), date))
        .when(fault == SIXTH_FIELD, to_line(rec_id, name, group, amount, date, F.lit("more")))
        .when(fault == PADDED, F.concat(F.lit("\t "), F.concat_ws(" |\t", rec_id, name, group, amount, date), F.lit(" \t")))
        .when(fault == BLANK, F.lit(" \t "))
        .when(fault == SHORT, to_line(rec_id, name, group))
        .when(fault == BAD_ID, to_line(F.lit("n/a"), name, group, amount, date))
        .when(fault == LONG_DATE, to_line(rec_id, name, group, amount, F.concat(date, F.lit("Tjunk"))))
        .when(fault == FINE_AMOUNT, to_line(rec_id, name, group, F.concat(amount, F.lit("9")), date))
        .otherwise(clean_line())
    )


def land_faulty_lines(spark: SparkSession, sf_dir: str) -> str:
    """Files with one faulty line per order; returns their folder."""
    path = scratch_path(spark, "faulty-lines")
    write_lines(order_records(spark, sf_dir).select(faulty_line().alias("line")), path, HEADER)
    return path


def land_nested_lines(spark: SparkSession, sf_dir: str) -> str:
    """The same lines in folders, one in the other; returns the outermost."""
    path = scratch_path(spark, "nested-lines")
    lines = order_records(spark, sf_dir).select(faulty_line().alias("line"), F.pmod("rec_id", F.lit(3)).alias("a"), F.pmod("rec_id", F.lit(2)).alias("b"))
    write_lines(lines, path, HEADER, ["a", "b"])
    return path


def positioned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders with a few bad amounts, and the file and place that the key gives them."""
    bad = F.pmod("rec_id", F.lit(BAD_EVERY)) == BAD_AT
    amount = F.when(bad, F.lit("x")).otherwise(F.col("amount").cast("string"))
    line = to_line(F.col("rec_id").cast("string"), "rec_name", "rec_group", amount, F.col("rec_date").cast("string"))
    file = F.expr(f"rec_id div {FILE_LINES}").cast("string")
    place = [F.lit(0).cast("long").alias("block"), F.col("rec_id").alias("seq")]
    return order_records(spark, sf_dir).select(line.alias("line"), file.alias("file"), *place)


def land_ordered_files(spark: SparkSession, sf_dir: str) -> str:
    """The same lines as files."""
    path = scratch_path(spark, "ordered-files")
    lines = positioned_lines(spark, sf_dir).select("seq", F.col("file").alias("file_no"), "line")
    lines = lines.repartition("file_no").sortWithinPartitions("file_no", "seq").drop("seq")
    write_lines(lines, path, HEADER, ["file_no"])
    return path


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, which every engine hands over alike."""
    shown = {"decimal": "double", "date": "string"}
    return df.select(
        *[F.col(f.name).cast(shown.get(f.dataType.typeName(), f.dataType.simpleString())).alias(f.name) for f in df.schema]
    )
