"""Files that events name: each event tells of some new files, and no folder is listed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.records import REASON, parse_files
from ledgerline.operators.rows import keep_rows
from ledgerline.session import passing_tables
from ledgerline.sources.delimited import read_lines
from ledgerline.streaming.state import keyed_state

# Fixed value: the form of a notification about objects in a store.
NOTICE = "Records array<struct<s3: struct<bucket: struct<name: string>, object: struct<key: string, eTag: string>>>>"
NO_NOTICE, NO_FILE = "no_notice", "no_file"


def object_place(bucket: Column, key: Column) -> Column:
    """Where an object is, as the object store's file system has it."""
    return F.concat(F.lit("s3a://"), bucket, F.lit("/"), key)


def named_files(events: DataFrame, place=object_place, prefix: str = "", suffix: str = ".csv") -> DataFrame:
    """``path``, ``version`` and ``reject_reason`` of every file that the events (``value``, JSON) name.

    Keys that do not begin with ``prefix`` or end with ``suffix`` are passed over. A text that is no notification, or
    names a file without a bucket or key, gives a row with its text as ``path`` and the reason ``no_notice``; so does
    a notification whose list is missing. An empty list names nothing.
    """
    notice = F.from_json("value", NOTICE)["Records"]
    each = F.explode(F.when(notice.isNull(), F.array(F.lit(None).cast(_element()))).otherwise(notice))
    named = events.select("value", each.alias("_named"))
    bucket, key = F.col("_named.s3.bucket.name"), F.col("_named.s3.object.key")
    known = bucket.isNotNull() & key.isNotNull()
    rows = named.select(
        F.when(known, place(bucket, key)).otherwise(F.col("value")).alias("path"),
        F.col("_named.s3.object.eTag").alias("version"),
        F.when(~known, F.lit(NO_NOTICE)).alias(REASON),
        (~known | (key.startswith(prefix) & key.endswith(suffix))).alias("_wanted"),
    )
    return keep_rows(rows, F.col("_wanted"), "path", "version", REASON)


def _element() -> T.DataType:
    return T.StructType.fromDDL(NOTICE)["Records"].dataType.elementType


def present(spark: SparkSession, paths: Sequence[str], calls: int = 32) -> list[bool]:
    """Whether each file is there: one question a file, ``calls`` of them at a time."""
    hadoop = spark._jsc.hadoopConfiguration()

    def there(path: str) -> bool:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(hadoop).exists(at)

    with ThreadPoolExecutor(calls) as pool:
        return list(pool.map(there, paths))


def stream_file_events(
    events: DataFrame,
    out: str,
    checkpoint: str,
    schema: T.StructType,
    on_error: str = "reject",
    compat: bool = False,
    place=object_place,
    prefix: str = "",
    suffix: str = ".csv",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Parse the files that events name, each version of a file once, however often it is named.

    A batch asks for the files its events name and for nothing else. Which files were named is keyed state, not a
    listing. Three tables grow at ``out`` by folders ``batch_id=N``, which a repeated batch overwrites: ``records``,
    ``rejects`` (lines that are no records) and ``faults`` (events that are no notifications, and files that are not
    there). None of these stops the other files. ``on_error`` as in :func:`parse_files`. The names of one
    batch go through the driver, which has to plan their reading: bound them by the stream of events.
    """
    spark = events.sparkSession
    files = named_files(events, place, prefix, suffix)
    once = keep_rows(files, F.col(REASON).isNull(), *files.columns).dropDuplicates(["path", "version"])
    arriving = once.union(keep_rows(files, F.col(REASON).isNotNull(), *files.columns))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        def put(df: DataFrame, name: str) -> None:
            df.write.mode("overwrite").parquet(f"{out}/{name}/batch_id={batch_id}")

        batch.persist()
        try:
            paths = sorted({r["path"] for r in batch.where(F.col(REASON).isNull()).select("path").collect()})
            there = [path for path, found in zip(paths, present(spark, paths)) if found]
            lost = sorted(set(paths) - set(there))
            faults = batch.where(F.col(REASON).isNotNull()).select("path", REASON)
            put(faults.union(spark.createDataFrame([(p, NO_FILE) for p in lost], f"path string, {REASON} string")), "faults")
        finally:
            batch.unpersist()
        if there:
            with passing_tables(spark):
                good, bad = parse_files(read_lines(spark, there, position=True), schema, on_error, compat)
                put(good, "records")
                put(bad.select("line", REASON, "file"), "rejects")

    writer = arriving.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    with keyed_state(spark):
        return (writer.trigger(**trigger) if trigger else writer).start()


def read_events_table(spark: SparkSession, out: str, name: str) -> DataFrame:
    """``records``, ``rejects`` or ``faults`` of :func:`stream_file_events` so far."""
    return spark.read.parquet(f"{out}/{name}").drop("batch_id")
