"""Column expressions for delimited lines. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Fixed value: the characters a trim removes, U+0000 to U+0020.
BLANKS = "".join(map(chr, range(0x21)))

FIRST_VISIBLE = "!"  # U+0021

# Number words Spark's cast accepts, and the spellings that are valid here.
ANY_NUMBER_WORD = r"(?i)^[+-]?(inf|infinity|nan)$"
VALID_NUMBER_WORD = r"^[+-]?(Infinity|NaN)$"

# The one form of a date.
WHOLE_DATE = r"^\d{4}-\d{2}-\d{2}$"


def clean(text: Column) -> Column:
    """Strip control characters and spaces at both ends (plain ``trim`` strips only spaces).

    Text that starts and ends above the blanks, as nearly all does, is passed on as it is.
    """
    nothing_to_strip = (text >= FIRST_VISIBLE) & (F.substring(text, -1, 1) >= FIRST_VISIBLE)
    return F.when(nothing_to_strip, text).otherwise(F.trim(text, F.lit(BLANKS)))


def split_fields(line: Column, compat: bool = False) -> Column:
    """Split on the pipe without regard to quotes; ``compat`` drops empty fields at the end."""
    if compat:
        line = F.when(line.endswith("|"), F.rtrim(line, F.lit("|"))).otherwise(line)
    return F.split(line, r"\|", -1)


def parse_double(text: Column) -> Column:
    """Text to double, null if malformed; number words only as ``NaN`` and ``Infinity``."""
    value = text.try_cast("double")
    ordinary = ~F.isnan(value) & (F.abs(value) < float("inf"))
    wrong_word = text.rlike(ANY_NUMBER_WORD) & ~text.rlike(VALID_NUMBER_WORD)
    return F.when(ordinary, value).when(~wrong_word, value)


def parse_field(text: Column, kind: T.DataType, compat: bool = False) -> Column:
    """One cleaned field as ``kind``; null if it is empty or malformed (compat keeps ``""``)."""
    if isinstance(kind, T.StringType):
        return text if compat else F.nullif(text, F.lit(""))
    if isinstance(kind, T.DoubleType):
        return parse_double(text)
    value = text.try_cast(kind)
    if isinstance(kind, T.DateType):
        return F.when(text.rlike(WHOLE_DATE), value)
    if isinstance(kind, T.DecimalType):
        # More digits than the scale has would be rounded away, unless they are zeros.
        longer = text.try_cast(T.DecimalType(38, min(38, kind.scale + 12)))
        too_fine = text.rlike(rf"\.\d{{{kind.scale}}}\d*[1-9]") | (longer != value)
        return F.when(~F.coalesce(too_fine, F.lit(False)), value)
    return value


def to_line(*columns: Column | str) -> Column:
    """Fields joined by the pipe; a null becomes an empty field."""
    return F.concat_ws("|", *[F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in columns])


def split_lines(text: Column) -> Column:
    """Text cut at ``\\n``, ``\\r`` or ``\\r\\n``."""
    return F.split(text, "\r\n|\r|\n", -1)
