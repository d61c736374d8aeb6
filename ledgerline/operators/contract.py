"""Checking a table against the constraints its source declares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def contract_check(
    df: DataFrame,
    key: str,
    required: Sequence[str] = (),
    max_length: Mapping[str, int] | None = None,
    decimals: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """One row per rule (``rule``, ``violations``), zero if it holds.

    A key must be present and unique (every row past the first counts), ``required`` columns
    present, text no longer than ``max_length``, numbers within (precision, scale) after rounding.
    One scan: rows are counted per key, together with their violations, then summed.
    """
    rules = {f"{key}_present": F.col(key).isNull()}
    rules |= {f"{c}_present": F.col(c).isNull() for c in required}
    rules |= {f"{c}_length": F.length(c) > n for c, n in (max_length or {}).items()}
    rules |= {
        f"{c}_range": F.abs(F.round(F.col(c), scale)) >= float(10 ** (precision - scale))
        for c, (precision, scale) in (decimals or {}).items()
    }
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(broken).alias(rule) for rule, broken in rules.items()]
    )
    repeats = F.when(F.col(key).isNotNull(), F.col("_n") - 1).otherwise(0)
    totals = per_key.agg(
        F.coalesce(F.sum(repeats), F.lit(0)).alias(f"{key}_unique"),
        *[F.coalesce(F.sum(rule), F.lit(0)).alias(rule) for rule in rules],
    )
    return totals.select(
        F.explode(F.create_map(*[x for c in totals.columns for x in (F.lit(c), F.col(c))])).alias("rule", "violations")
    )
