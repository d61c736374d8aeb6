"""What streams counted, kept in a table."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = "query string, run string, batch_id long, at string, stage string, count string, value long"


class ProgressLog(StreamingQueryListener):
    """Appends the counts that batches report (see ``watch``) to the table at ``path``.

    One small file per batch that reports; :func:`read_progress` counts a repeated batch once. Only numbers pass
    through here, whatever the batch held. Register it with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.written: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        rows = [
            (str(progress.id), str(progress.runId), progress.batchId, progress.timestamp, stage, count, int(value))
            for stage, counts in progress.observedMetrics.items()
            for count, value in counts.asDict().items()
            if value is not None
        ]
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        self.written[str(progress.runId)] = progress.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def await_batches(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until the last batch that ``query`` reported is written; reports come after the batch."""
        until, last = time.monotonic() + seconds, query.lastProgress
        while last and self.written.get(str(query.runId), -1) < last["batchId"]:
            if time.monotonic() > until:
                raise TimeoutError(f"no report of batch {last['batchId']} after {seconds} seconds")
            time.sleep(0.1)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """``query``, ``batch_id``, ``stage``, ``count`` and ``value``, once for each batch.

    A batch that was repeated reports again: the same counts, or none if its rows were there already and it
    did not run.
    """
    reports = spark.read.schema(SCHEMA).parquet(path)
    return reports.groupBy("query", "batch_id", "stage", "count").agg(F.max("value").alias("value"))
