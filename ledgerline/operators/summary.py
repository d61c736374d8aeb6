"""Counts that report what a stage did."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def run_summary(df: DataFrame, *by: str, counts: Mapping[str, Column] | None = None) -> DataFrame:
    """``records`` per group, and for each entry of ``counts`` the rows where it is true."""
    extra = [F.count_if(condition).alias(name) for name, condition in (counts or {}).items()]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("records"), *extra)


def watch(df: DataFrame, name: str, counts: Mapping[str, Column] | None = None) -> DataFrame:
    """Report the same counts to query listeners and streaming progress while ``df`` runs."""
    extra = [F.count_if(condition).alias(label) for label, condition in (counts or {}).items()]
    return df.observe(name, F.count(F.lit(1)).alias("records"), *extra)


def result_line(summary: DataFrame, verb: str, count: str = "records") -> DataFrame:
    """The sentence a stage ends with, one per row of a summary."""
    return summary.select(F.concat(F.lit(f"{verb} "), F.col(count).cast("string"), F.lit(" messages")).alias("result"))
