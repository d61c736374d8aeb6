from __future__ import annotations

import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F, types as T

from ledgerline.operators.lookup import lookup_external
from ledgerline.operators.messages import parse_messages
from ledgerline.operators.records import parse_records, parse_rejects
from ledgerline.operators.summary import watch
from ledgerline.schemas import EMPLOYEE
from ledgerline.sources.delimited import read_lines
from ledgerline.streaming.files import read_parsed, read_rejects, stream_files, stream_publish
from ledgerline.streaming.messages import (
    PER_RECEIVE,
    arriving_messages,
    read_messages,
    stream_checked,
    stream_lookup,
    stream_messages,
)

ONCE = {"availableNow": True}
SCHEMA = T.StructType([T.StructField("emp_id", T.LongType()), *EMPLOYEE.fields[1:]])
KEYS = T.StructType([T.StructField("emp_id", T.LongType())])


def drop(folder, name, *lines):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text("\n".join(["header", *lines]) + "\n")


def line(i, salary="2.0"):
    return f"{i}|A|B|{salary}|2020-01-01"


def ids(df):
    return sorted(r.emp_id for r in df.collect())


def test_files_once_over_restarts(spark, tmp_path):
    inbox, out, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    drop(inbox, "a.csv", line(1), "short|line", "", line(2))
    drop(inbox, "b.txt", line(99))

    def run():
        stream_files(spark, str(inbox), out, log, SCHEMA, trigger=ONCE).awaitTermination()
        return read_parsed(spark, out, SCHEMA)

    good, bad = run()
    assert ids(good) == [1, 2] and [r.reject_reason for r in bad.collect()] == ["short"]
    drop(inbox, "c.csv", line(3, "x"), line(4))
    good, bad = run()
    assert ids(good) == [1, 2, 4]
    assert sorted(r.reject_reason for r in bad.collect()) == ["bad_salary", "short"]
    assert ids(run()[0]) == [1, 2, 4]


def test_stream_equals_batch(spark, tmp_path):
    inbox, out, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    for n in range(5):
        drop(inbox, f"{n}.csv", *[line(100 * n + i, "x" if i == 7 else "1.5") for i in range(20)])
    stream_files(spark, str(inbox), out, log, SCHEMA, max_files_per_trigger=2, trigger=ONCE).awaitTermination()
    good, bad = read_parsed(spark, out, SCHEMA)
    lines = read_lines(spark, str(inbox))
    assert ids(good) == ids(parse_records(lines, SCHEMA))
    assert bad.count() == parse_rejects(lines, SCHEMA).count() == 5


def test_stop_file_in_a_stream(spark, tmp_path):
    inbox, out, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    drop(inbox, "a.csv", *[line(i, "x" if i == 5 else "1.0") for i in range(10)])
    drop(inbox, "b.csv", *[line(100 + i) for i in range(10)])
    stream_files(
        spark, str(inbox), out, log, SCHEMA, on_error="stop_file", max_files_per_trigger=1, trigger=ONCE
    ).awaitTermination()
    assert ids(spark.read.parquet(out)) == [*range(5), *range(100, 110)]
    assert {r.batch_id for r in spark.read.parquet(out).select("batch_id").distinct().collect()} == {0, 1}


def test_polling(spark, tmp_path):
    """A running stream takes up a file that arrives later."""
    inbox, out, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    drop(inbox, "a.csv", line(1))
    query = stream_publish(spark, str(inbox), out, log, SCHEMA, trigger={"processingTime": "1 second"})
    try:
        query.processAllAvailable()
        drop(inbox, "b.csv", line(2), line(3))
        for _ in range(30):
            query.processAllAvailable()
            found = ids(parse_messages(spark.read.text(out), SCHEMA))
            if len(found) == 3:
                break
            time.sleep(1)
    finally:
        query.stop()
    assert found == [1, 2, 3]


@pytest.fixture
def mail(spark, tmp_path):
    folder = tmp_path / "mail"
    folder.mkdir()
    for n in range(25):
        (folder / f"{n}.txt").write_text('{"emp_id":%d}\n' % n + ("broken\n" if n == 3 else '{"emp_id":0}\n'))
    return str(folder)


def test_messages_in_batches_of_ten_deliveries(spark, mail, tmp_path):
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    query = stream_messages(arriving_messages(spark, mail, PER_RECEIVE), out, log, KEYS, trigger=ONCE)
    query.awaitTermination()
    assert PER_RECEIVE == 10
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    good, bad = read_messages(spark, out, KEYS)
    assert ids(good) == sorted([*range(25), *[0] * 24])
    assert [tuple(r) for r in bad.collect()] == [("broken", "bad_json")]


def test_duplicates_go_only_on_request(spark, mail, tmp_path):
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    arriving = arriving_messages(spark, mail, arrival=True)
    stream_messages(arriving, out, log, KEYS, dedupe=["emp_id"], trigger=ONCE).awaitTermination()
    good, bad = read_messages(spark, out, KEYS)
    assert ids(good) == list(range(25)) and bad.count() == 1


def test_only_copies_of_keyed_messages_go(spark, tmp_path):
    """Two equal good ones, three broken ones, two without a key; then the same once more."""
    folder, out, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    folder.mkdir()
    fields = T.StructType([*KEYS.fields, T.StructField("n", T.LongType())])
    texts = ['{"emp_id":1}', '{"emp_id":1}', "a", "b", "c", '{"n":1}', '{"n":2}']

    def run(name):
        (folder / name).write_text("\n".join(texts) + "\n")
        arriving = arriving_messages(spark, str(folder), arrival=True)
        stream_messages(arriving, out, log, fields, dedupe=["emp_id"], trigger=ONCE).awaitTermination()
        return sorted(r.value for r in spark.read.parquet(out).collect())

    assert run("1.txt") == sorted(texts[1:])
    assert run("2.txt") == sorted([*texts[1:], *texts[2:]])


def test_old_and_nested_files_are_taken_up(spark, tmp_path):
    inbox, out, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    drop(inbox, "a.csv", line(1))

    def run():
        stream_files(spark, str(inbox), out, log, SCHEMA, trigger=ONCE).awaitTermination()
        return ids(read_parsed(spark, out, SCHEMA)[0])

    assert run() == [1]
    drop(inbox, "c.csv", line(3))
    drop(inbox / "sub", "b.csv", line(2))
    nine_days_ago = time.time() - 9 * 86_400
    os.utime(inbox / "sub" / "b.csv", (nine_days_ago, nine_days_ago))
    assert run() == [1, 2, 3]


def test_files_that_are_done_can_be_moved(spark, tmp_path):
    inbox, out, log, done = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log"), tmp_path / "done"
    for n in range(3):
        drop(inbox, f"{n}.csv", line(n))
        stream_publish(spark, str(inbox), out, log, SCHEMA, archive=str(done), trigger=ONCE).awaitTermination()
    assert ids(parse_messages(spark.read.text(out), SCHEMA)) == [0, 1, 2]


@pytest.mark.parametrize("on_error", ["reject", "stop_file"])
def test_publishing_keeps_rejects(spark, tmp_path, on_error):
    inbox, out, bad, log = tmp_path / "in", *(str(tmp_path / n) for n in ("out", "bad", "log"))
    drop(inbox, "a.csv", line(1), "short", line(2, "x"), line(3))
    stream_publish(
        spark, str(inbox), out, log, SCHEMA, on_error=on_error, rejects=bad, trigger=ONCE
    ).awaitTermination()
    sent = ids(parse_messages(spark.read.text(out).select("value"), SCHEMA))
    assert sent == ([1, 3] if on_error == "reject" else [1])
    assert sorted(r.reject_reason for r in read_rejects(spark, bad).collect()) == ["bad_salary", "short"]


def test_a_stream_measures_its_lookup_table_once(spark, tmp_path, monkeypatch):
    from ledgerline.operators import lookup

    measured = []
    real = lookup.text_bytes
    monkeypatch.setattr(lookup, "text_bytes", lambda df: measured.append(df) or real(df))
    inbox, out, log = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log")
    spark.range(300).select(F.col("id").alias("k")).repartition(3).write.parquet(inbox)
    arriving = spark.readStream.schema("k long").option("maxFilesPerTrigger", 1).parquet(inbox)
    table = spark.range(100).select(F.col("id").alias("k"))
    stream_lookup(arriving, table, "k", out, log, trigger=ONCE).awaitTermination()
    found = spark.read.parquet(out)
    assert found.select("batch_id").distinct().count() == 3 and found.where("exists").count() == 100
    assert len(measured) == 1


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_lookup_in_a_stream(spark, tmp_path, limit):
    inbox, out, log = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log")
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    rows.repartition(3).write.parquet(inbox)
    table = spark.range(0, 3000, 2).select(F.col("id").alias("k"))
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    stream_lookup(arriving, table, "k", out, log, trigger=ONCE, broadcast_bytes=limit).awaitTermination()
    found = spark.read.parquet(out)
    assert found.count() == 3000 and found.where("exists").count() == rows.where("k % 2 = 0").count()


def test_repeated_batch_replaces_itself(spark, tmp_path):
    """The commit of the last batch is lost: it runs again and its rows are there once."""
    inbox, out, log = tmp_path / "in", str(tmp_path / "out"), tmp_path / "log"
    spark.range(10).select(F.col("id").alias("k")).write.parquet(str(inbox))
    table = spark.range(5).select(F.col("id").alias("k"))

    def run():
        arriving = spark.readStream.schema("k long").parquet(str(inbox))
        stream_lookup(arriving, table, "k", out, str(log), trigger=ONCE).awaitTermination()
        return spark.read.parquet(out).count()

    assert run() == 10
    for commit in (log / "commits").iterdir():
        commit.unlink()
    assert run() == 10


def test_failed_check_brings_the_batch_again(spark, tmp_path):
    """A batch whose calls fail is not committed; the next run takes it up."""
    inbox, out, log, down = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log"), tmp_path / "down"
    spark.range(4).select(F.col("id").alias("k")).write.parquet(inbox)
    flag = str(down)

    def connect():
        def call(key):
            import os

            if os.path.exists(flag):
                raise OSError("service is down")
            return 200, '{"exists": true}'

        return call

    def run():
        arriving = spark.readStream.schema("k long").parquet(inbox)
        check = lambda batch: lookup_external(batch, "k", connect, on_failure="raise", tasks=1)
        stream_checked(arriving, check, out, log, trigger=ONCE).awaitTermination()

    down.write_text("")
    with pytest.raises(StreamingQueryException):
        run()
    down.unlink()
    run()
    assert spark.read.parquet(out).where("exists").count() == 4


def test_progress_of_a_stream(spark, mail, tmp_path):
    seen = watch(arriving_messages(spark, mail), "seen", {"broken": F.col("value") == "broken"})
    query = stream_messages(seen, str(tmp_path / "out"), str(tmp_path / "log"), KEYS, trigger=ONCE)
    query.awaitTermination()
    reports = [p["observedMetrics"]["seen"] for p in query.recentProgress if p["numInputRows"]]
    assert sum(r["records"] for r in reports) == 50 and sum(r["broken"] for r in reports) == 1
