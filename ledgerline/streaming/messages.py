"""Messages as they arrive: parse, check, commit."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.lookup import lookup_exists, prepare_lookup
from ledgerline.operators.messages import decode_messages
from ledgerline.operators.records import REASON
from ledgerline.operators.rows import keep_rows
from ledgerline.operators.summary import watch
from ledgerline.session import materialize, passing_tables
from ledgerline.streaming.files import arrival_options
from ledgerline.streaming.state import keyed_state

# Fixed value: how many deliveries a receive hands over at most where a cap is wanted.
PER_RECEIVE = 10


def arriving_messages(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    arrival: bool = False,
    archive: str | None = None,
) -> DataFrame:
    """One message per line of each new file under ``path``, in column ``value``.

    ``arrival`` adds when the file came in. Any other stream with a text column ``value`` does as
    well, such as a Kafka source capped by ``maxOffsetsPerTrigger``.
    """
    options = arrival_options(max_files_per_trigger, archive=archive)
    messages = spark.readStream.options(**options).text(path)
    if not arrival:
        return messages
    return messages.select("value", F.col("_metadata.file_modification_time").alias("arrived"))


def stream_messages(
    messages: DataFrame,
    out: str,
    checkpoint: str,
    schema: T.StructType,
    strict_fields: bool = False,
    compat: bool = False,
    dedupe: Sequence[str] = (),
    dedupe_within: str | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Append every message to the table at ``out``, with its fields and ``reject_reason``.

    A bad message does not stop the others. The checkpoint is the acknowledgement: a batch is
    committed after its rows are, and one that is repeated replaces itself. Repeated messages stay
    unless ``dedupe`` names the key (see :func:`drop_copies`). Each batch reports its counts ``received``: the
    messages and how many of them were handled, copies included.
    """
    decoded = decode_messages(messages, schema, strict_fields, compat)
    decoded = watch(decoded, "received", {"handled": F.col(REASON).isNull()})
    if dedupe:
        decoded = drop_copies(decoded, dedupe, dedupe_within)
    writer = decoded.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    with keyed_state(messages.sparkSession):
        return (writer.trigger(**trigger) if trigger else writer).start()


def drop_copies(decoded: DataFrame, keys: Sequence[str], within: str | None = None) -> DataFrame:
    """Of the good messages with equal keys, none of it null, one: from the first batch that has the key.

    The keys that came are keyed state: a batch reads its own messages and looks up their keys, however many
    came before. Rejected messages and messages without a key are never copies of each other and do not
    enter the state. ``within`` (such as ``"2 days"``) forgets a key that long after it came, by column
    ``arrived``, which bounds the state; messages that are later than that are then left out. Without it
    no key is forgotten and no message is too late.
    """
    keyed = F.col(REASON).isNull()
    for key in keys:
        keyed &= F.col(key).isNotNull()
    columns = decoded.columns
    once = keep_rows(decoded, keyed, *columns)
    if within is None:
        once = once.dropDuplicates(list(keys))
    else:
        once = once.withWatermark("arrived", within).dropDuplicatesWithinWatermark(list(keys))
    return once.union(keep_rows(decoded, ~keyed, *columns))


def read_messages(spark: SparkSession, out: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The records and the rejected messages that :func:`stream_messages` has written so far."""
    table = spark.read.parquet(out)
    good = table.where(table[REASON].isNull()).select(*schema.names)
    bad = table.where(table[REASON].isNotNull()).select("value", REASON)
    return good, bad


def stream_checked(
    records: DataFrame,
    check: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Apply ``check`` to each batch of records and write the result to its own folder.

    The batch is a table to ``check``, so the hot keys of the batch can decide the join; it is kept while
    it is checked, so the stream's source is read once. If the check fails the batch is not committed and
    comes again; if only the commit is lost the batch overwrites its folder ``batch_id=N``.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            with passing_tables(batch.sparkSession):
                check(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = records.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def lookup_check(table: DataFrame | None, key: str, enabled: bool = True, **options: object) -> Callable[[DataFrame], DataFrame]:
    """A check against a lookup table that is prepared and measured once, however many batches come."""
    if not enabled:
        return lambda batch: lookup_exists(batch, None, key, enabled=False)
    return prepare_lookup(table, key, keep=True, **options).check


def stream_lookup(
    records: DataFrame,
    table: DataFrame | None,
    key: str,
    out: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    **options: object,
) -> StreamingQuery:
    """Check each arriving record against the lookup table; ``options`` as in :func:`lookup_exists`.

    The table is read when the stream starts; start it again to take up a new one.
    """
    return stream_checked(records, lookup_check(table, key, **options), out, checkpoint, trigger)


def stream_process(
    messages: DataFrame,
    check: Callable[[DataFrame], DataFrame],
    out: str,
    rejects: str,
    checkpoint: str,
    schema: T.StructType,
    strict_fields: bool = False,
    compat: bool = False,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Check the record of each good message into ``out``; the others go to ``rejects`` with the reason.

    A batch is decoded once and writes its own folders ``batch_id=N`` in both, which a repeated batch
    overwrites.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        with passing_tables(batch.sparkSession):
            decoded = materialize(decode_messages(batch, schema, strict_fields, compat), "decoded")
            good = F.col(REASON).isNull()
            decoded.where(~good).select("value", REASON).write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
            records = decoded.where(good).select(*schema.names)
            check(records).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = messages.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
