"""Records to JSON messages and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerline.operators.records import REASON
from ledgerline.operators.rows import keep_rows
from ledgerline.schemas import compat_schema

_CORRUPT = "_corrupt"

# Fixed value: what JSON allows around its tokens.
JSON_BLANKS = " \t\r\n"


def to_messages(records: DataFrame, columns: list[str] | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """One JSON object per record in column ``value``: keys in column order, nulls written out."""
    body = F.to_json(F.struct(*(columns or records.columns)), {"ignoreNullFields": "false"})
    return records.select(*carry, body.alias("value"))


def decode_messages(
    messages: DataFrame,
    schema: T.StructType,
    strict_fields: bool = False,
    compat: bool = False,
) -> DataFrame:
    """Every message with its fields and ``reject_reason`` (null if good).

    ``bad_json`` is a body that is no JSON object or has a field of the wrong type;
    ``strict_fields`` also rejects objects with a field the schema lacks (``unknown_field``).
    ``compat`` has 32-bit ints, doubles and text, rejects unknown fields, and gives 0 for a number
    that is null or missing.
    """
    kinds = compat_schema(schema) if compat else schema
    carried = [c for c in messages.columns if c != "value"]
    shape = T.StructType([*[T.StructField(f.name, f.dataType) for f in kinds], T.StructField(_CORRUPT, T.StringType())])
    body = F.from_json("value", shape, {"columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE"})
    decoded = messages.withColumn("_body", body)
    opens = F.ltrim("value", F.lit(JSON_BLANKS)).startswith("{")
    no_object = F.col("_body").isNull() | F.col(f"_body.{_CORRUPT}").isNotNull() | ~opens
    reason = F.when(no_object, F.lit("bad_json"))
    if strict_fields or compat:
        known = F.array(*[F.lit(f.name) for f in kinds])
        extra = F.size(F.array_except(F.json_object_keys("value"), known)) > 0
        reason = reason.when(extra, F.lit("unknown_field"))
    fields = [_field(f, compat).alias(f.name) for f in kinds]
    return decoded.select("value", *carried, *fields, reason.alias(REASON))


def _field(field: T.StructField, compat: bool) -> Column:
    value = F.col(f"_body.{field.name}")
    if compat and isinstance(field.dataType, T.NumericType):
        return F.coalesce(value, F.lit(0).cast(field.dataType))
    return value


def parse_messages(
    messages: DataFrame,
    schema: T.StructType,
    strict_fields: bool = False,
    compat: bool = False,
) -> DataFrame:
    """The records among ``messages``; repeated messages give repeated records."""
    decoded = decode_messages(messages, schema, strict_fields, compat)
    carried = [c for c in messages.columns if c != "value"]
    return keep_rows(decoded, F.col(REASON).isNull(), *carried, *schema.names)


def message_rejects(
    messages: DataFrame,
    schema: T.StructType,
    strict_fields: bool = False,
    compat: bool = False,
) -> DataFrame:
    """The messages that are no records, with the reason."""
    decoded = decode_messages(messages, schema, strict_fields, compat)
    carried = [c for c in messages.columns if c != "value"]
    return keep_rows(decoded, F.col(REASON).isNotNull(), "value", REASON, *carried)
