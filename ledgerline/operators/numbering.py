"""Global order and row numbers without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ledgerline.operators.joins import BROADCAST_BYTES, has_many_copies, row_hash, text_bytes
from ledgerline.session import materialize

_TIE, _AT = "_tie", "_at"
_ROW_BITS = 33  # monotonically_increasing_id: task number above, row in the task below


def sort_rows(df: DataFrame, order_by: Sequence[str], unique: bool = False) -> DataFrame:
    """Global sort that stays even if many rows share a key.

    Range cuts cannot fall between equal rows. Unless ``unique`` promises that ``order_by`` tells
    rows apart, ties are broken by a hash of the row, which a task that runs again finds again. Only copies
    then stay together; where some row has many, the rows are written first and its copies, which are
    interchangeable, told apart by where they lie. Values are not touched.
    """
    columns = df.columns
    if unique:
        return df.orderBy(*order_by)
    if has_many_copies(df):
        df = materialize(df, "copies")
        tied = df.withColumns({_TIE: row_hash(df), _AT: F.monotonically_increasing_id()})
        return tied.orderBy(*order_by, _TIE, _AT).select(*columns)
    return df.withColumn(_TIE, row_hash(df)).orderBy(*order_by, _TIE).select(*columns)


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    group_by: Sequence[str] = (),
    name: str = "row_number",
    unique: bool = False,
) -> DataFrame:
    """Number rows 1, 2, 3, … by ``order_by`` within each group (or over all).

    The rows are sorted over range partitions, cut by position and not by group, and written once.
    A group's number is its position in the partition plus its rows in earlier partitions; only
    those counts, one per group and partition, meet in a window.
    """
    columns = df.columns
    placed = sort_rows(df, [*group_by, *order_by], unique).withColumn(_AT, F.monotonically_increasing_id())
    placed = materialize(placed, "numbered")
    part = F.shiftright(F.col(_AT), _ROW_BITS).alias("_part")
    runs = placed.groupBy(*group_by, part).agg(F.min(_AT).alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group_by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    starts = materialize(runs.select(*group_by, "_part", "_first", before), "starts")
    if text_bytes(starts) <= BROADCAST_BYTES:
        starts = F.broadcast(starts)
    same_group = [F.col(f"p.{c}").eqNullSafe(F.col(f"s.{c}")) for c in group_by]
    matched = placed.withColumn("_part", part).alias("p").join(
        starts.alias("s"), [F.col("p._part") == F.col("s._part"), *same_group]
    )
    number = F.col("p._at") - F.col("s._first") + F.col("s._before") + 1
    return matched.select(*[F.col(f"p.{c}") for c in columns], number.alias(name))


def message_batches(
    df: DataFrame,
    source: str,
    order_by: Sequence[str],
    size: int = 10,
    unique: bool = False,
) -> DataFrame:
    """Add ``batch``: consecutive rows of a source in groups of at most ``size``, from 0."""
    numbered = number_rows(df, order_by, [source], "_number", unique)
    batch = F.floor((F.col("_number") - 1) / size).cast("long")
    return numbered.withColumn("batch", batch).drop("_number")
