"""Registered queries over streams that keep state, positions or versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerline.operators.bucketed import bucket_lookup
from ledgerline.operators.lookup import Call, lookup_external
from ledgerline.operators.messages import parse_messages, to_messages
from ledgerline.operators.rules import lookup_rules
from ledgerline.plans.views import land_nested_lines, plain, table
from ledgerline.schemas import ORDER_RECORD
from ledgerline.session import scratch_path, ship_package
from ledgerline.sources.message_log import append_messages
from ledgerline.streaming.events import read_events_table, stream_file_events
from ledgerline.streaming.messages import arriving_messages, stream_checked, stream_messages
from ledgerline.streaming.progress import ProgressLog, read_progress
from ledgerline.streaming.receives import take_receives
from ledgerline.streaming.retry import await_settled, read_receipts, stream_retry
from ledgerline.streaming.versions import publish_lookup, read_checked, stream_lookup_versions

ONCE = {"availableNow": True}
EVENT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType())])


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a message, beside its id."""
    return to_messages(table(spark, sf_dir, "events").select("event_id", "user_id"), carry=("event_id",))


def faltering_service() -> Call:
    """Stands in for a service: asked for event and attempt, some calls fail once, some twice, some always."""

    def call(asked: str) -> tuple[int, str]:
        event, attempt = map(int, asked.split("/"))
        if attempt <= {0: 1000, 1: 1, 2: 2}.get(event % 10, 0):
            raise TimeoutError("no answer")
        return 200, '{"exists": true}'

    return call


def stream_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages whose lookup fails once, twice or always; each is tried three times at most."""
    ship_package(spark)
    path, out, checkpoint = (scratch_path(spark, n) for n in ("to-try", "tried", "tried-log"))
    event_messages(spark, sf_dir).select("value").write.text(path)

    def attempt(deliveries: DataFrame) -> DataFrame:
        asked = deliveries.withColumn("asked", F.concat_ws("/", "id", "attempt"))
        found = lookup_external(asked, "asked", faltering_service, tasks=8, calls_per_task=4)
        return found.select("id", "attempt", F.col("error").isNull().alias("ok"), "error", "exists")

    arriving = arriving_messages(spark, path).select(F.get_json_object("value", "$.event_id").alias("id"), "value")
    query = stream_retry(arriving, attempt, out, checkpoint, delay_seconds=0.1, trigger={"processingTime": "0 seconds"})
    await_settled(query, 1800)
    settled = read_receipts(spark, out)
    return settled.select(F.col("id").cast("long").alias("event_id"), "status", "attempts", F.coalesce("error", F.lit("none")).alias("error"))


def stream_named_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of orders that events name, several to an event; the events come twice."""
    folder = land_nested_lines(spark, sf_dir)
    path, out, checkpoint = (scratch_path(spark, n) for n in ("notices", "named", "named-log"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    of = F.pmod(F.xxhash64("path"), F.lit(3))
    named = F.struct(F.struct(F.struct(F.lit("store").alias("name")).alias("bucket"), F.struct(F.col("path").alias("key")).alias("object")).alias("s3"))
    notices = files.groupBy(of.alias("event")).agg(F.collect_list(named).alias("Records"))
    notices = notices.select(F.to_json(F.struct("Records")).alias("value"))
    notices.write.text(f"{path}/first")
    notices.write.text(f"{path}/second")
    arriving = arriving_messages(spark, path, max_files_per_trigger=2)
    stream_file_events(
        arriving, out, checkpoint, ORDER_RECORD, place=lambda bucket, key: key, trigger=ONCE
    ).awaitTermination()
    return plain(read_events_table(spark, out, "records"))


def stream_ten_at_most(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended to a log in two parts, taken after each: what every receive of ten holds."""
    log, out, checkpoint = (scratch_path(spark, n) for n in ("message-log", "received", "received-log"))
    messages = event_messages(spark, sf_dir)
    handle = lambda receives: parse_messages(receives, EVENT)
    for part in ("event_id % 3 = 0", "event_id % 3 <> 0"):
        append_messages(messages.where(part), log, ["event_id"], unique=True)
        take_receives(spark, log, handle, out, checkpoint)
    ends = [F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event")]
    return spark.read.parquet(out).groupBy("receive").agg(F.count(F.lit(1)).alias("records"), *ends)


def stream_lookup_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a stream against customers in buckets; most order keys are no customer's."""
    path, out, checkpoint = (scratch_path(spark, n) for n in ("orders", "in-buckets", "in-buckets-log"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    orders.repartition(3).write.parquet(path)
    name = "customers_" + path.rsplit("-", 1)[1]
    lookup = bucket_lookup(
        table(spark, sf_dir, "customer"), name, "o_orderkey", "c_custkey", answers=["c_name"], buckets=8
    )
    arriving = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(path)
    stream_checked(arriving, lookup.check, out, checkpoint, trigger=ONCE).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


def stream_lookup_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a stream; a second version of the lookup table is published between its two parts."""
    path, root, out, checkpoint = (scratch_path(spark, n) for n in ("callers", "versions", "current", "current-log"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    suppliers = table(spark, sf_dir, "supplier")
    parts = (("c_custkey % 2 = 0", suppliers.where("s_acctbal > 0")), ("c_custkey % 2 = 1", suppliers))
    for k, (part, rows) in enumerate(parts):
        customers.where(part).write.parquet(f"{path}/part-{k}")
        publish_lookup(rows, root, "c_custkey", "s_suppkey", answers=["s_name"])
        arriving = spark.readStream.schema(customers.schema).option("recursiveFileLookup", "true").parquet(path)
        stream_lookup_versions(
            arriving, root, "c_custkey", out, checkpoint, answers=["s_name"], trigger=ONCE
        ).awaitTermination()
    return read_checked(spark, out)


def lookup_by_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers against rules that suppliers give: exact keys, ranges that overlap, prefixes and a default."""
    number = F.col("s_suppkey")
    kind = F.when(number % 3 == 0, "exact").when(number % 3 == 1, "range").otherwise("prefix")
    rules = table(spark, sf_dir, "supplier").select(
        kind.alias("kind"),
        F.when(number % 3 != 1, number.cast("string")).alias("key"),
        F.when(number % 3 == 1, number * 7).alias("low"),
        F.when(number % 3 == 1, number * 7 + F.col("s_nationkey") * 5).alias("high"),
        (F.col("s_nationkey") % 8).alias("priority"),
        (F.col("s_acctbal") > 0).alias("exists"),
        F.col("s_name").alias("answer"),
    )
    default = spark.range(1).selectExpr(
        "'any' kind", "cast(null as string) key", "cast(null as bigint) low", "cast(null as bigint) high",
        "6 priority", "false exists", "'nobody' answer",
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return lookup_rules(customers, rules.unionByName(default), "c_custkey", ["answer"])


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged events in two files, one a batch: what each batch received and handled, as a listener kept it."""
    path, out, checkpoint, kept = (scratch_path(spark, n) for n in ("counted-mail", "counted", "counted-log", "counts"))
    fault = F.col("event_id") % 50 == 0
    value = F.when(fault, F.lit("{")).otherwise(F.to_json(F.struct("event_id", "user_id")))
    for part in ("event_id % 3 = 0", "event_id % 3 <> 0"):
        events = table(spark, sf_dir, "events").where(part).coalesce(1)
        events.select(value.alias("value")).write.mode("append").text(path)
    log = ProgressLog(spark, kept)
    spark.streams.addListener(log)
    try:
        arriving = arriving_messages(spark, path, max_files_per_trigger=1)
        query = stream_messages(arriving, out, checkpoint, EVENT, trigger=ONCE)
        query.awaitTermination()
        log.await_batches(query)
    finally:
        spark.streams.removeListener(log)
    return read_progress(spark, kept).select("batch_id", "stage", "count", "value")


STREAM_QUERIES = {
    "stream_lookup_large": stream_lookup_bucketed,
    "stream_lookup_versions": stream_lookup_current,
    "stream_progress": stream_counts,
    "lookup_rules": lookup_by_rules,
    "stream_retry": stream_retries,
    "stream_file_events": stream_named_files,
    "stream_receives": stream_ten_at_most,
}
