"""Delivery by message: each is tried until it succeeds or has been tried too often, without the others.

Each message that is not settled is state: its text, how often it was tried, and when it is due again. Messages lie
in buckets by a hash of their id, and a bucket is one entry of keyed state: a batch calls Python once per bucket
that it touches, not once per message.
The state emits deliveries; a batch tries them and writes the outcomes to a table, which is a second source of
the same stream, so an outcome reaches the state of its message in a later batch. What is settled leaves
the state with a receipt.
"""

from __future__ import annotations

import pickle
import time
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerline.operators.lookup import Call, lookup_external
from ledgerline.operators.messages import decode_messages
from ledgerline.operators.records import REASON
from ledgerline.session import passing_tables
from ledgerline.streaming.files import arrival_options
from ledgerline.streaming.state import keyed_state

MOST_ATTEMPTS = 3
DELAY_SECONDS = 30.0
BUCKETS = 1024

DELIVERY, ACKNOWLEDGED, GIVEN_UP = "delivery", "acknowledged", "given_up"

_STATE = "messages binary"
_EMITTED = "id string, kind string, value string, attempt int, copies long, error string"


def stream_retry(
    messages: DataFrame,
    attempt: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    most_attempts: int = MOST_ATTEMPTS,
    delay_seconds: float = DELAY_SECONDS,
    trigger: Mapping[str, object] | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Try each message (``id``, ``value``) until its attempt succeeds, ``most_attempts`` times at most.

    ``attempt`` gets ``id``, ``value`` and ``attempt`` (1, 2, …) of the deliveries of a batch as a table and returns
    them with ``ok`` and ``error``, and whatever else is to be kept. A message whose attempt failed is tried
    again ``delay_seconds`` later; the others go on meanwhile. Two tables grow at ``out`` by folders ``batch_id=N``,
    which a repeated batch overwrites: ``attempts``, what ``attempt`` returned, and ``receipts``, one row per
    settled message (see :func:`read_receipts`).

    Messages of one id are one message, ``copies`` of it, as long as it is not settled; after that the id
    is a new message. A null id is taken from the text. A message is tried at least once: if a batch is
    repeated, so are its attempts.

    A batch writes the buckets that it touches anew, each with its messages that are not settled. A checkpoint
    stays with the number of ``buckets`` it was made with.
    """
    spark = messages.sparkSession
    outcomes = f"{out}/attempts"
    shape = T.StructType.fromDDL("id string, attempt int, ok boolean, error string")
    spark.createDataFrame([], shape).write.mode("overwrite").parquet(f"{outcomes}/batch_id=-1")
    nothing = {name: F.lit(None).cast(kind) for name, kind in (("attempt", "int"), ("ok", "boolean"), ("error", "string"))}
    named = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("text "), F.sha2(F.coalesce("value", F.lit("")), 256)))
    fresh = messages.select(named.alias("id"), "value").withColumns(nothing)
    told = spark.readStream.schema(shape).options(**arrival_options()).parquet(outcomes)
    told = told.select("id", F.lit(None).cast("string").alias("value"), "attempt", "ok", "error")
    emitted = (
        fresh.union(told)
        .withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandasWithState(
            _settle(most_attempts, max(1, int(delay_seconds * 1000))),
            _EMITTED,
            _STATE,
            "append",
            GroupStateTimeout.ProcessingTimeTimeout,
        )
    )

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            kinds = {r["kind"] for r in batch.select("kind").distinct().collect()}  # three at most
            if kinds - {DELIVERY}:
                receipts = batch.where(F.col("kind") != DELIVERY)
                receipts = receipts.selectExpr("id", "kind AS status", "attempt AS attempts", "copies", "error")
                receipts.write.mode("overwrite").parquet(f"{out}/receipts/batch_id={batch_id}")
            if DELIVERY in kinds:
                with passing_tables(spark):
                    tried = attempt(batch.where(F.col("kind") == DELIVERY).select("id", "value", "attempt"))
                    tried.write.mode("overwrite").parquet(f"{outcomes}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = emitted.writeStream.outputMode("append").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    with keyed_state(spark):
        return (writer.trigger(**trigger) if trigger else writer).start()


def _settle(most: int, delay: int) -> Callable:
    """What the state of one bucket does: at texts and outcomes, and when a message of it is due again."""

    # Runs on the executors, which need not have this package: it refers to nothing outside but names.
    def settle(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out = []
        # Each message's text, attempts, copies, and when it is due; 0 while an attempt is under way.
        held = pickle.loads(state.get[0]) if state.exists else {}
        now = state.getCurrentProcessingTimeMs()

        def emit(name: str, kind: str, value: str | None, tried: int, copies: int, error: str | None = None) -> None:
            out.append((name, kind, value, tried, copies, error))

        for name, (value, tried, copies, due) in held.items():
            if due and due <= now:
                held[name] = (value, tried + 1, copies, 0)
                emit(name, "delivery", value, tried + 1, copies)
        texts, outcomes = {}, []
        for frame in () if state.hasTimedOut else frames:
            told = frame["attempt"].notna()
            for name, value in zip(frame["id"][~told].tolist(), frame["value"][~told].tolist()):
                texts.setdefault(name, []).append(value)
            outcomes.extend(frame.loc[told, ["id", "attempt", "ok", "error"]].itertuples(index=False, name=None))
        for name, values in texts.items():
            value, tried, copies, due = held.get(name, (None, 0, 0, 0))
            if not tried:
                value, tried = min((t for t in values if t is not None), default=None), 1
                emit(name, "delivery", value, tried, len(values))
            held[name] = (value, tried, copies + len(values), due)
        for name, attempt, ok, error in outcomes:
            value, tried, copies, due = held.get(name, (None, 0, 0, 0))
            if attempt != tried or due:
                continue  # told before
            if ok is not None and bool(ok):
                emit(name, "acknowledged", None, tried, copies)
                del held[name]
            elif tried >= most:
                emit(name, "given_up", None, tried, copies, error)
                del held[name]
            else:
                held[name] = (value, tried, copies, now + delay)
        if held:
            state.update((pickle.dumps(held),))
            waiting = min((due for *_, due in held.values() if due), default=0)
            if waiting:
                state.setTimeoutDuration(max(1, waiting - now))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=["id", "kind", "value", "attempt", "copies", "error"])

    return settle


def lookup_attempts(
    schema: T.StructType,
    key: str,
    connect: Callable[[], Call],
    strict_fields: bool = False,
    compat: bool = False,
    **options: object,
) -> Callable[[DataFrame], DataFrame]:
    """An attempt that looks the record of a message up by a call; see :func:`lookup_external` for the options.

    It fails if the text is no record or the call got no answer. The outcome also has ``exists`` (null if it failed).
    """

    def attempt(deliveries: DataFrame) -> DataFrame:
        decoded = decode_messages(deliveries, schema, strict_fields, compat)
        asked = decoded.select("id", "attempt", F.col(key).alias("_key"), F.col(REASON).alias("_reason"))
        # A text that is no record asks for nothing: its key is null.
        asked = asked.withColumn("_key", F.when(F.col("_reason").isNull(), F.col("_key")))
        found = lookup_external(asked, "_key", connect, **options)
        error = F.coalesce("_reason", "error")
        return found.select(
            "id", "attempt", error.isNull().alias("ok"), error.alias("error"), F.when(error.isNull(), F.col("exists")).alias("exists")
        )

    return attempt


def read_receipts(spark: SparkSession, out: str) -> DataFrame:
    """``id``, ``status`` (acknowledged or given_up), ``attempts``, ``copies`` and the last ``error`` of what is settled."""
    return spark.read.parquet(f"{out}/receipts").drop("batch_id")


def read_attempts(spark: SparkSession, out: str) -> DataFrame:
    """What every attempt returned."""
    return spark.read.option("mergeSchema", "true").parquet(f"{out}/attempts").where("batch_id >= 0").drop("batch_id")


def await_settled(query: StreamingQuery, seconds: float) -> None:
    """Wait until no message is under way, then stop the stream; an error after ``seconds``."""
    until = time.monotonic() + seconds
    try:
        while True:
            # The first batch of a run may be one of the run before, so it says nothing about what is there.
            done = query.recentProgress
            if len(done) > 2 and not done[-1]["numInputRows"] and not done[-1]["stateOperators"][0]["numRowsTotal"]:
                return
            if query.exception() is not None:
                raise query.exception()
            if time.monotonic() > until:
                raise TimeoutError(f"messages are still under way after {seconds} seconds")
            time.sleep(0.2)
    finally:
        query.stop()
