"""Files as they arrive, parsed into records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.messages import to_messages
from ledgerline.operators.records import REASON, parse_files, parse_lines, parse_records
from ledgerline.session import passing_tables
from ledgerline.sources.delimited import LINE_OPTIONS, add_sequence, file_columns

# Fixed value: how often a folder is looked at.
POLL = {"processingTime": "5 seconds"}

# Older than the newest file by so much, a new file is still read: a hundred years.
ANY_AGE = "36500d"


def arrival_options(max_files: int | None = None, max_age: str = ANY_AGE, archive: str | None = None) -> dict[str, str]:
    """Options of a stream over the files of a folder and of all folders in it.

    ``max_files`` bounds a batch, not what is read in all. ``max_age`` forgets names that are older than the
    newest file by more than that, and with them new files of such an age; by default it never does.
    ``archive`` moves files there that are done, so that the listing and the seen names do not
    grow for ever.
    """
    options = {"recursiveFileLookup": "true", "maxFileAge": max_age}
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    return options


def arriving_lines(
    spark: SparkSession,
    path: str,
    glob: str = "*.csv",
    header: bool = True,
    max_files_per_trigger: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Lines of each new file under ``path``, nested or not, of any age, without first and blank lines."""
    return (
        spark.readStream.schema("line string")
        .options(**LINE_OPTIONS, **arrival_options(max_files_per_trigger, archive=archive))
        .option("header", str(header).lower())
        .option("pathGlobFilter", glob)
        .csv(path)
        .select("line", *file_columns())
    )


def stream_files(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    schema: T.StructType,
    on_error: str = "reject",
    compat: bool = False,
    glob: str = "*.csv",
    max_files_per_trigger: int | None = None,
    archive: str | None = None,
    trigger: Mapping[str, object] = POLL,
) -> StreamingQuery:
    """Parse every file once, also over restarts, and append its records to the table at ``out``.

    With ``reject`` the table also holds the rejected lines with their reason, so one pass serves
    both (see :func:`read_parsed`); the file sink's log makes a repeated batch replace itself.
    ``archive`` is a folder for the files that are done. ``stop_file`` compares the lines of a file, which a stream cannot, so each batch is parsed as a
    table and overwrites its own folder; a file is never spread over batches.
    """
    lines = arriving_lines(spark, path, glob, max_files_per_trigger=max_files_per_trigger, archive=archive)
    if on_error == "reject":
        writer = parse_lines(lines, schema, compat).writeStream.format("parquet").option("path", out)
    else:

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            with passing_tables(batch.sparkSession):
                records = parse_records(add_sequence(batch), schema, on_error, compat)
                records.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

        writer = lines.writeStream.foreachBatch(write_batch)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def stream_publish(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    schema: T.StructType,
    on_error: str = "reject",
    compat: bool = False,
    rejects: str | None = None,
    glob: str = "*.csv",
    max_files_per_trigger: int | None = None,
    archive: str | None = None,
    trigger: Mapping[str, object] = POLL,
) -> StreamingQuery:
    """Turn each record of each new file into one JSON message, a line of text at ``out``.

    ``rejects`` is a folder for the lines that are no records, with the reason and the file (see
    :func:`read_rejects`). ``on_error="stop_file"`` publishes nothing after the first malformed line of a
    file. Either way a batch is parsed once, as a table, and writes its own folders ``batch_id=N``, which
    a repeated batch overwrites.
    """
    lines = arriving_lines(spark, path, glob, max_files_per_trigger=max_files_per_trigger, archive=archive)
    if on_error == "reject" and rejects is None:
        messages = to_messages(parse_records(lines, schema, compat=compat))
        writer = messages.writeStream.format("text").option("path", out)
    else:

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            with passing_tables(batch.sparkSession):
                good, bad = parse_files(add_sequence(batch), schema, on_error, compat)
                to_messages(good).write.mode("overwrite").text(f"{out}/batch_id={batch_id}")
                if rejects is not None:
                    bad.select("line", REASON, "file").write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")

        writer = lines.writeStream.foreachBatch(write_batch)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_parsed(spark: SparkSession, out: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The records and the rejected lines that a ``reject`` stream has written so far."""
    table = spark.read.parquet(out)
    good = table.where(table[REASON].isNull()).select(*schema.names)
    bad = table.where(table[REASON].isNotNull()).select("line", REASON, "file")
    return good, bad


def read_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    """What a stream has put in its folder of rejects so far."""
    return spark.read.parquet(rejects).drop("batch_id")
