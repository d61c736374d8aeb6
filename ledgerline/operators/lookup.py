"""Checking records against a keyed lookup, held as a table or behind a call."""

from __future__ import annotations

import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerline.functions.answers import exists_by_field, exists_by_text
from ledgerline.operators.joins import BROADCAST_BYTES, keyed_join, text_bytes
from ledgerline.session import materialize

# Fixed value: seconds to wait for a connection and for an answer.
TIMEOUT_SECONDS = 5

Call = Callable[[object], tuple[int, str]]


def lookup_exists(
    records: DataFrame,
    table: DataFrame | None,
    key: str,
    table_key: str | None = None,
    answers: Sequence[str] = (),
    exists_column: str | None = None,
    status_column: str | None = None,
    enabled: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``exists`` and the ``answers`` columns of the table; no record is dropped.

    A key without a row answers false and nulls. A row counts only with status 200, if the table
    has a status, and with a true ``exists_column``, if it has one. Should a key occur twice, the
    row that exists wins, then the smallest answer. With ``enabled=False`` every record exists.
    """
    if not enabled:
        return records.withColumn("exists", F.lit(True))
    prepared = prepare_lookup(table, key, table_key, answers, exists_column, status_column, broadcast_bytes)
    return prepared.check(records)


class Lookup:
    """A lookup table ready to be joined with any number of batches of records."""

    def __init__(self, one_each: DataFrame, key: str, answers: Sequence[str], small: bool) -> None:
        self.one_each, self.key, self.answers, self.small = one_each, key, tuple(answers), small

    def check(self, records: DataFrame) -> DataFrame:
        joined = keyed_join(records, self.one_each, self.key, "left", small=self.small)
        return joined.select(*records.columns, F.coalesce("exists", F.lit(False)).alias("exists"), *self.answers)


def one_per_key(
    table: DataFrame,
    key: str,
    table_key: str | None = None,
    answers: Sequence[str] = (),
    exists_column: str | None = None,
    status_column: str | None = None,
) -> DataFrame:
    """``key``, ``exists`` and the answers of each key of ``table``, once; the row that wins as in :func:`lookup_exists`."""
    entries = _entries(table, key, table_key, answers, exists_column, status_column)
    if not answers:
        return entries.groupBy(key).agg(F.bool_or("exists").alias("exists"))
    best = F.min(F.struct((~F.col("exists")).alias("absent"), *answers)).alias("best")
    taken = [F.col(f"best.{a}").alias(a) for a in answers]
    return entries.groupBy(key).agg(best).select(key, (~F.col("best.absent")).alias("exists"), *taken)


def _entries(
    table: DataFrame, key: str, table_key: str | None, answers: Sequence[str], exists_column: str | None, status_column: str | None
) -> DataFrame:
    exists = F.col(exists_column) if exists_column else F.lit(True)
    if status_column:
        exists = F.when(F.col(status_column) == 200, exists).otherwise(F.lit(False))
    exists = F.coalesce(exists, F.lit(False))
    entries = table.select(F.col(table_key or key).alias(key), exists.alias("exists"), *answers)
    return entries.where(F.col(key).isNotNull())


def prepare_lookup(
    table: DataFrame,
    key: str,
    table_key: str | None = None,
    answers: Sequence[str] = (),
    exists_column: str | None = None,
    status_column: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    keep: bool = False,
) -> Lookup:
    """One row per key of ``table``, measured once; ``keep`` writes it, for many uses."""
    form = (table, key, table_key, answers, exists_column, status_column)
    one_each = one_per_key(*form)
    if keep:
        one_each = materialize(one_each, "lookup")
    return Lookup(one_each, key, answers, text_bytes(one_each if keep else _entries(*form)) <= broadcast_bytes)


def http_caller(endpoint: str) -> Callable[[], Call]:
    """Opens a caller in each task that asks ``endpoint`` for one key at a time.

    Any answer counts, whatever its status; only a failure to get one is a failure.
    """

    def connect() -> Call:
        def text(answer) -> str:
            return answer.read().decode("utf-8").replace("\r", "").replace("\n", "")

        def call(key: object) -> tuple[int, str]:
            try:
                # Fixed value: the path of a record at the service.
                with urllib.request.urlopen(f"{endpoint}/employee/{key}", timeout=TIMEOUT_SECONDS) as answer:
                    return answer.status, text(answer)
            except urllib.error.HTTPError as refusal:
                with refusal:
                    return refusal.code, text(refusal)

        return call

    return connect


def ask_keys(
    records: DataFrame,
    key: str,
    connect: Callable[[], Call],
    on_failure: str = "no",
    tasks: int = 32,
    calls_per_task: int = 1,
) -> DataFrame:
    """``status``, ``answer`` and ``error`` of one call per distinct key, as a written table.

    ``connect`` runs once per task and returns the caller, which must bear ``calls_per_task`` calls at a
    time. At most ``tasks`` times that many are open at once.
    """
    if on_failure not in ("no", "raise"):
        raise ValueError(f"unknown on_failure: {on_failure}")
    keys = records.select(key).where(F.col(key).isNotNull()).distinct().coalesce(tasks)
    kind = keys.schema[key].dataType.simpleString()

    # Runs on the executors, which need not have this package: it refers to nothing outside.
    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor

        call = connect()

        def reply(value: object) -> tuple[int | None, str | None, str | None]:
            try:
                return (*call(value), None)
            except Exception as failure:
                if on_failure == "raise":
                    raise
                return None, None, str(failure)

        with ThreadPoolExecutor(calls_per_task) as pool:
            for batch in batches:
                replies = pd.DataFrame(pool.map(reply, batch[key]), columns=["status", "answer", "error"])
                yield replies.astype({"status": "Int32"}).assign(**{key: batch[key].values})

    return materialize(keys.mapInPandas(ask, f"status int, answer string, error string, `{key}` {kind}"), "answers")


def lookup_external(
    records: DataFrame,
    key: str,
    connect: Callable[[], Call],
    by_text: bool = False,
    on_failure: str = "no",
    tasks: int = 32,
    calls_per_task: int = 1,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``exists``, ``status``, ``answer`` and ``error`` from a call made once per distinct key.

    A call that fails answers false, or with ``on_failure="raise"`` fails the task, so that a stream
    does not commit its messages. The answers are written before they are joined back, so no key is
    asked again for it. See :func:`ask_keys` for the rest.
    """
    answered = ask_keys(records, key, connect, on_failure, tasks, calls_per_task)
    test = exists_by_text if by_text else exists_by_field
    found = answered.withColumn("exists", test(F.col("answer"), F.col("status")))
    joined = keyed_join(records, found, key, "left", broadcast_bytes)
    return joined.select(
        *records.columns, F.coalesce("exists", F.lit(False)).alias("exists"), "status", "answer", "error"
    )
