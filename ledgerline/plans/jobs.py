"""The stages put together: extract, handle files, handle messages."""

from __future__ import annotations

import argparse
import math
import re
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ledgerline.operators.lookup import http_caller, lookup_exists, lookup_external
from ledgerline.operators.messages import decode_messages, parse_messages, to_messages
from ledgerline.operators.records import REASON, parse_lines, parse_records
from ledgerline.operators.summary import run_summary
from ledgerline.schemas import EMPLOYEE
from ledgerline.session import resolve_option
from ledgerline.sources.delimited import read_delimited, read_lines, write_delimited
from ledgerline.sources.extract import jdbc_extract
from ledgerline.streaming.events import stream_file_events
from ledgerline.streaming.files import POLL, stream_publish
from ledgerline.streaming.messages import arriving_messages, lookup_check, stream_process
from ledgerline.streaming.progress import ProgressLog
from ledgerline.streaming.retry import DELAY_SECONDS, await_settled, lookup_attempts, stream_retry


def land(
    records: DataFrame,
    output: str,
    key: str,
    check: Callable[[DataFrame], DataFrame] | None = None,
    order_by: Sequence[str] = (),
    unique_order: bool = False,
) -> DataFrame | None:
    """Write the records, whatever their columns, and return them checked (None without a check).

    The check reads what was written, not the source again, so both see the same rows, by name and
    with the types of ``records``. A failing check cannot undo the write.
    """
    if check is not None and key not in records.columns:
        raise ValueError(f"the records have no column {key}")
    write_delimited(records, output, order_by, unique_order)
    return None if check is None else check(read_delimited(records.sparkSession, output, records.schema))


def publish_files(
    spark: SparkSession,
    paths: str | list[str],
    output: str,
    schema: T.StructType,
    on_error: str = "reject",
    compat: bool = False,
) -> DataFrame:
    """Turn the records of the given files into messages at ``output``; returns how many there are.

    They are counted while they are written.
    """
    lines = read_lines(spark, paths, position=on_error == "stop_file")
    sent = Observation()
    messages = to_messages(parse_records(lines, schema, on_error, compat))
    messages.observe(sent, F.count(F.lit(1)).alias("records")).write.mode("overwrite").text(output)
    return spark.createDataFrame([(sent.get["records"],)], "records long")


def process_messages(
    messages: DataFrame,
    schema: T.StructType,
    key: str,
    lookup: DataFrame | None,
    compat: bool = False,
) -> DataFrame:
    """The records of the good messages, checked; without a lookup table every one exists."""
    return lookup_exists(parse_messages(messages, schema, compat=compat), lookup, key, enabled=lookup is not None)


def trace_lines(
    lines: DataFrame,
    line: Column,
    schema: T.StructType,
    key: str,
    lookup: DataFrame,
    lookup_key: str,
    by: str,
) -> DataFrame:
    """Every stage after extraction in one plan without landing: parse, publish, process, look up.

    Per value of ``by``: records read, messages published, messages processed, keys that exist.
    """
    parsed = parse_lines(lines.select(F.col(by).alias("_by"), line.alias("line")), schema)
    good = F.col(REASON).isNull()
    body = F.when(good, F.to_json(F.struct(*schema.names), {"ignoreNullFields": "false"}))
    sent = parsed.select("_by", good.alias("_sent"), body.alias("value"))
    handled = decode_messages(sent, schema).withColumn("_handled", F.col(REASON).isNull())
    checked = lookup_exists(handled, lookup, key, lookup_key)
    counts = {"published": F.col("_sent"), "processed": F.col("_handled"), "matched": F.col("exists")}
    return run_summary(checked, "_by", counts=counts).withColumnRenamed("_by", by)


def extract(spark: SparkSession, given: argparse.Namespace) -> None:
    """Extract by JDBC to delimited files, then count the keys that the lookup knows."""
    records = jdbc_extract(
        spark,
        given.database,
        given.user,
        given.password,
        given.query,
        fetch_size=given.fetch_size,
        partition_column=given.split_column,
        num_partitions=given.splits,
        even=given.even,
    )
    checked = land(records, given.output, given.key, _check(spark, given), given.order_by)
    if checked is not None:
        print(run_summary(checked, counts={"matched": F.col("exists")}).first())
    print(f"Written to {given.output}")


def handle_files(spark: SparkSession, given: argparse.Namespace) -> None:
    """Publish the records of each file that arrives, up to the first malformed number in it."""
    _keep_counts(spark, given)
    stream_publish(
        spark,
        given.folder,
        given.messages,
        given.checkpoint,
        EMPLOYEE,
        on_error=given.on_error,
        compat=True,
        rejects=given.rejects or f"{given.messages.rstrip('/')}-rejects",
        max_files_per_trigger=given.most_files,
        archive=given.archive,
        trigger=_trigger(given.every),
    ).awaitTermination()


def handle_events(spark: SparkSession, given: argparse.Namespace) -> None:
    """Parse the files that arriving notifications name."""
    _keep_counts(spark, given)
    stream_file_events(
        arriving_messages(spark, given.folder, given.most_files, archive=given.archive),
        given.output,
        given.checkpoint,
        EMPLOYEE,
        on_error=given.on_error,
        compat=True,
        place=_place(given.place),
        prefix=given.prefix,
        trigger=_trigger(given.every),
    ).awaitTermination()


def handle_messages(spark: SparkSession, given: argparse.Namespace) -> None:
    """Check the record of each message that arrives; with --attempts each by itself until its call is answered."""
    _keep_counts(spark, given)
    arriving = arriving_messages(spark, given.folder, given.most_files, archive=given.archive)
    if given.attempts:
        if not given.endpoint:
            raise ValueError("attempts need an endpoint that can fail")
        attempt = lookup_attempts(EMPLOYEE, given.key, http_caller(given.endpoint), compat=True, calls_per_task=given.calls)
        named = arriving.select(F.concat_ws(" ", F.col("_metadata.file_path"), F.sha2("value", 256)).alias("id"), "value")
        once = given.every == "once"  # until all that is there is settled
        trigger = {"processingTime": "0 seconds"} if once else _trigger(given.every)
        query = stream_retry(named, attempt, given.output, given.checkpoint, given.attempts, given.retry_after, trigger)
        await_settled(query, math.inf) if once else query.awaitTermination()
        return
    check = _check(spark, given) or lookup_check(None, given.key, enabled=False)
    stream_process(
        arriving,
        check,
        given.output,
        given.rejects or f"{given.output.rstrip('/')}-rejects",
        given.checkpoint,
        EMPLOYEE,
        compat=True,
        trigger=_trigger(given.every),
    ).awaitTermination()


def _place(pattern: str) -> Callable[[Column, Column], Column]:
    """Where the object with a bucket and a key is."""
    before, between, after = re.fullmatch(r"(.*)\{bucket\}(.*)\{key\}(.*)", pattern).groups()
    return lambda bucket, key: F.concat(F.lit(before), bucket, F.lit(between), key, F.lit(after))


def _keep_counts(spark: SparkSession, given: argparse.Namespace) -> None:
    if given.counts:
        spark.streams.addListener(ProgressLog(spark, given.counts))


def _check(spark: SparkSession, given: argparse.Namespace) -> Callable[[DataFrame], DataFrame] | None:
    """By calls if an endpoint is named, else by a table if one is, else none."""
    if given.endpoint:
        connect = http_caller(given.endpoint)
        return lambda records: lookup_external(records, given.key, connect, calls_per_task=given.calls)
    path = resolve_option(spark, "spark.ledgerline.lookup", given.lookup)
    return lookup_check(spark.read.parquet(path), given.key) if path else None


def _trigger(every: str | None) -> dict[str, object]:
    """Seconds between polls; ``once`` takes what is there and ends."""
    if every is None:
        return dict(POLL)
    return {"availableNow": True} if every == "once" else {"processingTime": f"{every} seconds"}


def arguments_of() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="jobs")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, run: Callable, *places: str) -> argparse.ArgumentParser:
        made = jobs.add_parser(name, help=run.__doc__.splitlines()[0])
        made.set_defaults(run=run)
        for place in places:
            made.add_argument(place)
        return made

    def checking(made: argparse.ArgumentParser) -> None:
        made.add_argument("--key", default="emp_id", help="column that is looked up")
        made.add_argument("--lookup", help="Parquet table of known keys")
        made.add_argument("--endpoint", help="address of a service that knows the keys")
        made.add_argument("--calls", type=int, default=8, help="calls that a task has open at once")

    def streaming(made: argparse.ArgumentParser) -> None:
        made.add_argument("--every", help="seconds between polls, or once")
        made.add_argument("--most-files", type=int, help="files of one batch; all by default")
        made.add_argument("--rejects", help="folder for what is no record")
        made.add_argument("--archive", help="folder for arrived files that are done")
        made.add_argument("--counts", help="table of what each batch counted")

    made = job("extract", extract, "database", "user", "password", "query", "output")
    checking(made)
    made.add_argument("--split-column", help="key whose ranges are read side by side")
    made.add_argument("--splits", type=int, help="number of such ranges")
    made.add_argument("--even", action="store_true", help="ranges of about equally many rows instead of equal length")
    made.add_argument("--fetch-size", type=int)
    made.add_argument("--order-by", nargs="*", default=[])
    made = job("files", handle_files, "folder", "messages", "checkpoint")
    streaming(made)
    made.add_argument("--on-error", choices=["stop_file", "reject"], default="stop_file")
    made = job("events", handle_events, "folder", "output", "checkpoint")
    streaming(made)
    made.add_argument("--on-error", choices=["stop_file", "reject"], default="stop_file")
    made.add_argument("--place", default="s3a://{bucket}/{key}", help="where an object with a bucket and a key is")
    made.add_argument("--prefix", default="", help="keys that are looked at begin so")
    made = job("messages", handle_messages, "folder", "output", "checkpoint")
    checking(made)
    streaming(made)
    made.add_argument("--attempts", type=int, help="how often a message is tried; without it a failed call means no")
    made.add_argument("--retry-after", type=float, default=DELAY_SECONDS, help="seconds until a message is tried again")
    return parser


def main(arguments: Sequence[str]) -> int:
    try:
        given = arguments_of().parse_args(list(arguments))
    except SystemExit as ended:
        return int(bool(ended.code))
    spark = SparkSession.builder.appName(given.job).getOrCreate()
    try:
        given.run(spark, given)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
