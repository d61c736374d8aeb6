"""Messages of a log in receives of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

from ledgerline.session import passing_tables, ship_package
from ledgerline.sources.message_log import log_end, read_log
from ledgerline.streaming.messages import PER_RECEIVE

# Receives that one batch handles side by side. Each batch has a cost of its own, so a backlog wants few of them.
RECEIVES = 100_000


class _Ranges(SimpleDataSourceStreamReader):
    """One row a batch: where it begins in the log and where it ends, ``most`` messages at most."""

    def __init__(self, log: str, most: int) -> None:
        self.log, self.most = log, most

    def initialOffset(self) -> dict:
        return {"offset": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        end = {"offset": max(start["offset"], min(start["offset"] + self.most, log_end(self.log)))}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(start["offset"], end["offset"])] if start["offset"] < end["offset"] else [])


class _RangeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ledgerline_ranges"

    def schema(self) -> str:
        return "first bigint, end bigint"

    def simpleStreamReader(self, schema) -> _Ranges:
        return _Ranges(self.options["log"], int(self.options["most"]))


def stream_receives(
    spark: SparkSession,
    log: str,
    handle: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    size: int = PER_RECEIVE,
    receives: int = RECEIVES,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Handle the messages of a log in order, ``size`` to a receive at most, up to ``receives`` of them in one batch.

    ``handle`` gets ``offset``, ``receive`` and ``value`` of a batch and its result overwrites ``batch_id=N`` at
    ``out``; ``receive`` is the offset of the receive's first message. Only the two ends of a batch are
    streamed, so the cap counts messages whatever files they lie in, and the executors read just these from
    the log. The ends are in the checkpoint before the batch is handled: one that comes again has the same
    receives. A receive is as full as the log allows when it is taken.
    """
    ship_package(spark)
    spark.dataSource.register(_RangeSource)
    ends = spark.readStream.format(_RangeSource.name()).option("log", log).option("most", size * receives).load()

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        for first, end in batch.collect():  # one row
            place = F.col("offset") - (F.col("offset") - first) % size
            messages = read_log(spark, log, first, end).select("offset", place.alias("receive"), "value")
            with passing_tables(spark):
                handle(messages).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = ends.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def take_receives(spark: SparkSession, log: str, handle: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, **options) -> None:
    """Handle what the log holds and end; see :func:`stream_receives`."""
    query = stream_receives(spark, log, handle, out, checkpoint, **options)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
