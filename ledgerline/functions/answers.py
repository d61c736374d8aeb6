"""Column expressions around a lookup answer."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def exists_by_text(answer: Column, status: Column | None = None) -> Column:
    """The answer counts if its text holds one of two spellings of a true ``exists``."""
    # The two spellings looked for.
    found = F.contains(answer, F.lit('"exists": true')) | F.contains(answer, F.lit('"exists":true'))
    return _only_ok(F.coalesce(found, F.lit(False)), status)


def exists_by_field(answer: Column, status: Column | None = None) -> Column:
    """The answer counts if its JSON field ``exists`` is true, however it is spaced."""
    found = F.get_json_object(answer, "$.exists") == "true"
    return _only_ok(F.coalesce(found, F.lit(False)), status)


def _only_ok(found: Column, status: Column | None) -> Column:
    if status is None:
        return found
    return F.when(status == 200, found).otherwise(F.lit(False))


def lookup_url(endpoint: str, key: Column) -> Column:
    # Fixed value: the path of a record at the service.
    return F.concat(F.lit(f"{endpoint}/employee/"), key.cast("string"))


def answer_line(key: Column, name: Column, answer: Column) -> Column:
    """The log line of one lookup: key, name and whatever came back."""
    # Fixed value: the words of the line.
    return F.format_string("Employee %s (%s): %s", key.cast("string"), name, answer.cast("string"))
