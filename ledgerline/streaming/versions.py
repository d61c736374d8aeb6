"""Lookups of a stream that stay current: each batch is bound to one version of the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.joins import BROADCAST_BYTES, text_bytes
from ledgerline.operators.lookup import Lookup, one_per_key


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers in a small table of one column; none if it is not there yet."""
    try:
        return [r["version"] for r in spark.read.schema("version long").parquet(path).collect()]
    except AnalysisException as failure:
        if failure.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def publish_lookup(
    table: DataFrame,
    root: str,
    key: str,
    table_key: str | None = None,
    answers: Sequence[str] = (),
    exists_column: str | None = None,
    status_column: str | None = None,
) -> int:
    """Write one row per key of ``table`` as the next version under ``root`` and return its number, from 1.

    Streams see a version when all its rows are there. Earlier versions stay as they are, since a batch that is
    repeated needs its own. One writer at a time.
    """
    spark = table.sparkSession
    version = max(_numbers(spark, f"{root}/versions"), default=0) + 1
    rows = one_per_key(table, key, table_key, answers, exists_column, status_column)
    rows.write.mode("overwrite").parquet(f"{root}/rows/version={version}")
    spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").parquet(f"{root}/versions")
    return version


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{root}/rows/version={version}")


def stream_lookup_versions(
    records: DataFrame,
    root: str,
    key: str,
    out: str,
    checkpoint: str,
    answers: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Check each arriving record against the newest version under ``root`` when its batch is first handled.

    The result, with ``exists``, the ``answers`` and the ``version`` used, overwrites ``rows/batch_id=N`` at ``out``. The
    version is written to ``bindings/batch_id=N`` before it is used: a batch that comes again finds it
    there and gives the same rows, whatever was published meanwhile. A version is measured once, when a batch
    first uses it. Without any version the batch fails and comes again.
    """
    used: dict[int, Lookup] = {}

    def prepared(spark: SparkSession, version: int) -> Lookup:
        if version not in used:
            rows = read_version(spark, root, version)
            used.clear()
            used[version] = Lookup(rows, key, answers, text_bytes(rows) <= broadcast_bytes)
        return used[version]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        binding = f"{out}/bindings/batch_id={batch_id}"
        bound = _numbers(spark, binding)
        if not bound:
            bound = [max(_numbers(spark, f"{root}/versions"), default=0)]
            if not bound[0]:
                raise LookupError(f"no version of the lookup table at {root}")
            spark.createDataFrame([(bound[0],)], "version long").coalesce(1).write.mode("overwrite").parquet(binding)
        batch.persist()
        try:
            checked = prepared(spark, bound[0]).check(batch).withColumn("version", F.lit(bound[0]).cast("long"))
            checked.write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = records.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_checked(spark: SparkSession, out: str) -> DataFrame:
    """The checked records so far."""
    return spark.read.parquet(f"{out}/rows").drop("batch_id")
