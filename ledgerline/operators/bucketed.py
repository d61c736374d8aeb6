"""Lookup tables that lie in buckets by key, so that what looks keys up is all that moves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.operators.joins import hot_keys, one_of
from ledgerline.operators.lookup import one_per_key
from ledgerline.session import scratch_path

BUCKETS = 200


def bucket_lookup(
    table: DataFrame,
    name: str,
    key: str,
    table_key: str | None = None,
    answers: Sequence[str] = (),
    exists_column: str | None = None,
    status_column: str | None = None,
    buckets: int = BUCKETS,
    location: str | None = None,
) -> BucketedLookup:
    """Write one row per key of ``table`` as catalog table ``name``, dealt by key into ``buckets`` of one sorted file each.

    Which row of a key counts is as in :func:`lookup_exists`. This is the only shuffle of the table; any
    number of batches and streams may use it. ``buckets`` bounds how many tasks look keys up at once: choose
    it so that a bucket is some hundred megabytes.
    """
    rows = one_per_key(table, key, table_key, answers, exists_column, status_column)
    writer = rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    path = location or scratch_path(table.sparkSession, name.replace(".", "-"))
    writer.mode("overwrite").option("path", path).saveAsTable(name)
    return BucketedLookup(table.sparkSession, name, key, answers)


class BucketedLookup:
    """A table of :func:`bucket_lookup`, by its name in the catalog."""

    def __init__(self, spark: SparkSession, name: str, key: str, answers: Sequence[str] = ()) -> None:
        self.name, self.key, self.answers = name, key, tuple(answers)
        self.kind = spark.table(name).schema[key].dataType

    def check(self, records: DataFrame) -> DataFrame:
        """``records`` with ``exists`` and the answers, none dropped.

        Rows of ordinary keys are shuffled into the table's buckets; the table is read where it lies. The rows of
        hot keys (at most ``HOT_SHARE`` of them, null among them) would all meet in one bucket, so the few rows
        that the table has for these are read by key, which opens their buckets only, and broadcast.
        """
        spark, key, columns = records.sparkSession, self.key, records.columns
        table = spark.table(self.name).select(F.col(key).alias("_key"), F.col("exists").alias("_exists"), *self._taken())
        # The hash of a key depends on its type, and the buckets have the table's.
        same = records.schema[key].dataType == self.kind
        asked = records.withColumn("_asked", F.col(key) if same else F.col(key).try_cast(self.kind))
        hot = hot_keys(asked, "_asked")
        often = one_of(F.col("_asked"), hot)
        on = F.col("_asked") == F.col("_key")
        rare = asked.where(~often) if hot else asked
        joined = rare.join(table.hint("shuffle_merge"), on, "left")
        if hot:
            named = [k for k in hot if k is not None]
            few = table.where(F.col("_key").isin(named)) if named else table.where("false")
            joined = joined.union(asked.where(often).join(F.broadcast(few), on, "left"))
        exists = F.coalesce("_exists", F.lit(False)).alias("exists")
        return joined.select(*columns, exists, *[F.col(f"_answer_{a}").alias(a) for a in self.answers])

    def _taken(self):
        return [F.col(a).alias(f"_answer_{a}") for a in self.answers]
