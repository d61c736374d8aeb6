"""Delimited lines to typed records, with explicit rules for lines that are not records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerline.functions.text import clean, parse_field, split_fields
from ledgerline.operators.joins import BROADCAST_BYTES, keyed_join
from ledgerline.operators.rows import keep_rows
from ledgerline.schemas import compat_schema
from ledgerline.session import materialize

REASON = "reject_reason"
BLANK = "blank"
POSITION = ("file", "block", "seq")


def _parse(lines: DataFrame, schema: T.StructType, compat: bool) -> DataFrame:
    kinds = compat_schema(schema) if compat else schema
    carried = [c for c in lines.columns if c != "line"]
    split = lines.withColumn("_line", clean(F.col("line"))).withColumn("_parts", split_fields(F.col("_line"), compat))
    texts = [clean(F.get("_parts", F.lit(i))) for i in range(len(kinds))]
    fields = [parse_field(t, f.dataType, compat).alias(f.name) for t, f in zip(texts, kinds)]
    parsed = split.select("line", "_line", "_parts", *carried, *fields)
    return parsed.withColumn(REASON, _reason(kinds)).drop("_line", "_parts")


def parse_lines(lines: DataFrame, schema: T.StructType, compat: bool = False) -> DataFrame:
    """Every line that is not blank, with its fields by position and ``reject_reason`` (null if good).

    Reasons are ``short`` and ``bad_<field>``. Fields past the last are ignored, quotes mean
    nothing. By default an empty field is null and numbers must be present; ``compat`` takes 32-bit
    ints, doubles and text, keeps empty text, and does not count empty fields at the end of a line.
    """
    parsed = _parse(lines, schema, compat)
    return keep_rows(parsed, ~F.col(REASON).eqNullSafe(BLANK), *parsed.columns)


def _reason(kinds: T.StructType) -> Column:
    reason = F.when(F.col("_line") == "", F.lit(BLANK)).when(F.size("_parts") < len(kinds), F.lit("short"))
    for i, field in enumerate(kinds):
        if isinstance(field.dataType, T.StringType):
            continue
        bad = F.col(field.name).isNull()
        if not isinstance(field.dataType, T.NumericType):
            bad &= clean(F.get("_parts", F.lit(i))) != ""
        reason = reason.when(bad, F.lit(f"bad_{field.name}"))
    return reason


def parse_records(
    lines: DataFrame,
    schema: T.StructType,
    on_error: str = "reject",
    compat: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The records among ``lines``.

    ``on_error`` says what a malformed number or date does: ``reject`` leaves out that line, ``stop_file``
    also leaves out all later lines of its file (give lines with position), ``fail`` ends the job.
    Short lines are left out in any case.
    """
    names = schema.names
    if on_error == "stop_file":
        return parse_files(lines, schema, on_error, compat, broadcast_bytes)[0]
    parsed = _parse(lines, schema, compat)
    good = F.col(REASON).isNull()
    if on_error == "reject":
        return keep_rows(parsed, good, *names)
    if on_error == "fail":
        message = F.concat(F.col(REASON), F.lit(": "), F.col("line"))
        return keep_rows(parsed, F.when(_malformed(), F.raise_error(message).cast("boolean")).otherwise(good), *names)
    raise ValueError(f"unknown on_error: {on_error}")


def parse_files(
    lines: DataFrame,
    schema: T.StructType,
    on_error: str = "reject",
    compat: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """The records and the rejected lines (``line``, the reason and what else ``lines`` carries).

    Every line is parsed once: the parsed lines are written, and both come from that table. With
    ``stop_file`` nothing after the first malformed line of a file is a record or a reject.
    """
    names = schema.names
    carried = [c for c in lines.columns if c != "line"]
    if on_error == "stop_file" and (missing := [c for c in POSITION if c not in lines.columns]):
        raise ValueError(f"stop_file needs lines with position, missing {missing}")
    parsed = materialize(parse_lines(lines, schema, compat), "parsed")
    if on_error == "stop_file":
        # Files stay cut into pieces: the position is a minimum per file over all of them, and the few
        # rows meet the lines in a join that copes with one huge file.
        stops = parsed.where(_malformed()).groupBy("file").agg(F.min(_place()).alias("_stop"))
        parsed = keyed_join(parsed, materialize(stops, "first-bad"), "file", "left", broadcast_bytes)
        parsed = parsed.where(F.col("_stop").isNull() | (_place() <= F.col("_stop")))
    good = parsed.where(F.col(REASON).isNull()).select(*names)
    return good, parsed.where(F.col(REASON).isNotNull()).select("line", REASON, *carried)


def _malformed() -> Column:
    return F.coalesce(F.col(REASON).startswith("bad_"), F.lit(False))


def _place() -> Column:
    return F.struct("block", "seq")


def parse_rejects(lines: DataFrame, schema: T.StructType, compat: bool = False) -> DataFrame:
    """The lines that are no records, with the reason."""
    parsed = _parse(lines, schema, compat)
    carried = [c for c in lines.columns if c != "line"]
    return keep_rows(parsed, F.col(REASON) != BLANK, "line", REASON, *carried)
