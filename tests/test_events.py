"""Events that name files, and receives of a positioned log."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F, types as T

from ledgerline.schemas import EMPLOYEE
from ledgerline.sources.message_log import append_messages, appends, log_end, read_log
from ledgerline.streaming import events as module
from ledgerline.streaming.events import named_files, read_events_table, stream_file_events
from ledgerline.streaming.messages import PER_RECEIVE, arriving_messages
from ledgerline.streaming.receives import take_receives

ONCE = {"availableNow": True}
SCHEMA = T.StructType([T.StructField("emp_id", T.LongType()), *EMPLOYEE.fields[1:]])


def notice(*names, bucket="bucket", tag=None):
    return json.dumps({"Records": [{"s3": {"bucket": {"name": bucket}, "object": {"key": n, "eTag": tag}}} for n in names]})


def drop(folder, name, *lines):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def records(folder, name, *keys):
    drop(folder, name, "header", *[f"{k}|A|B|{'x' if k < 0 else 1.5}|2020-01-01" for k in keys])


@pytest.fixture
def store(tmp_path):
    """Starts the stream over what events there are and returns the ids of all records."""
    data, inbox, out, log = (tmp_path / n for n in ("data", "events", "out", "log"))

    def run(spark, **options):
        place = lambda bucket, key: F.concat(F.lit(f"{data}/"), bucket, F.lit("/"), key)
        arriving = arriving_messages(spark, str(inbox), max_files_per_trigger=1)
        query = stream_file_events(arriving, str(out), str(log), SCHEMA, place=place, trigger=ONCE, **options)
        query.awaitTermination()
        return sorted(r.emp_id for r in read_events_table(spark, str(out), "records").collect())

    return data / "bucket", inbox, out, run


def test_files_named_by_events(spark, store):
    data, inbox, out, run = store
    for n in range(4):
        records(data / "in", f"{n}.csv", 10 * n, 10 * n + 1)
    records(data / "in", "unnamed.csv", 999)
    records(data / "in", "3.txt", 888)
    drop(inbox, "1", notice("in/0.csv", "in/1.csv"), "no json", notice("in/gone.csv", "in/3.txt"), "{}", '{"Records":[]}')
    assert run(spark) == [0, 1, 10, 11]
    # A file that is named again is not read again, in this batch or another; the others of its event are.
    drop(inbox, "2", notice("in/1.csv", "in/2.csv"), notice("in/2.csv"))
    assert run(spark) == [0, 1, 10, 11, 20, 21]
    faults = sorted((r.reject_reason, r.path.rsplit("/", 1)[-1]) for r in read_events_table(spark, str(out), "faults").collect())
    assert faults == [("no_file", "gone.csv"), ("no_notice", "no json"), ("no_notice", "{}")]


def test_a_new_version_is_read(spark, store):
    data, inbox, _, run = store
    records(data, "a.csv", 1)
    drop(inbox, "1", notice("a.csv", tag="v1"))
    assert run(spark) == [1]
    records(data, "a.csv", 2)
    drop(inbox, "2", notice("a.csv", tag="v2"), notice("a.csv", tag="v1"))
    assert run(spark) == [1, 2]


def test_no_folder_is_listed(spark, store, monkeypatch):
    data, inbox, _, run = store
    records(data, "a.csv", 1)
    asked = []
    real = module.read_lines
    monkeypatch.setattr(module, "read_lines", lambda spark, paths, **o: asked.append(paths) or real(spark, paths, **o))
    drop(inbox, "1", notice("a.csv"))
    run(spark)
    assert asked == [[f"{data}/a.csv"]]


@pytest.mark.parametrize("on_error, kept", [("reject", [1, 2, 4, 5]), ("stop_file", [1, 4, 5])])
def test_bad_lines_of_named_files(spark, store, on_error, kept):
    data, inbox, out, run = store
    records(data, "a.csv", 1, -1, 2)
    records(data, "b.csv", 4, 5)
    drop(inbox, "1", notice("a.csv", "b.csv"))
    assert run(spark, on_error=on_error) == kept
    assert [r.reject_reason for r in read_events_table(spark, str(out), "rejects").collect()] == ["bad_salary"]


def test_key_filters(spark):
    texts = [(notice("data/a.csv", "data/b.txt", "other/c.csv"),), (json.dumps({"Records": [{"s3": None}]}),), (None,)]
    rows = named_files(spark.createDataFrame(texts, "value string"), prefix="data/").collect()
    assert sorted((r.path or "", r.reject_reason) for r in rows if not r.reject_reason) == [("s3a://bucket/data/a.csv", None)]
    assert [r.reject_reason for r in rows if r.reject_reason] == ["no_notice"] * 2


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_log_positions(spark, tmp_path):
    log = str(tmp_path / "log")
    assert log_end(log) == 0 and read_log(spark, log).count() == 0
    assert append_messages(messages(spark, "b", "a", "c"), log) == (0, 3)
    assert append_messages(messages(spark), log) == (3, 3)
    # An append that was cut short leaves rows without a mark: the next one takes their place.
    messages(spark, "lost").selectExpr("3L AS offset", "value").write.mode("overwrite").parquet(f"{log}/rows/from=3")
    assert read_log(spark, log).count() == 3
    assert append_messages(messages(spark, "e", "d", "d"), log) == (3, 6)
    assert appends(log) == [(0, 3), (3, 6)] and appends(f"file:{log}") == appends(log)
    assert [tuple(r) for r in read_log(spark, log).orderBy("offset").collect()] == list(enumerate("abcdde"))
    part = read_log(spark, log, 2, 4)
    assert sorted(r.value for r in part.collect()) == ["c", "d"]
    scan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset,2)" in scan and "LessThan(offset,4)" in scan


def receives(spark, out):
    rows = spark.read.parquet(out).collect()
    found = {}
    for r in rows:
        found.setdefault(r.receive, []).append(r.offset)
    return {first: sorted(offsets) for first, offsets in sorted(found.items())}


def test_receives_hold_ten_at_most(spark, tmp_path):
    """One append, that is one file a task, is cut by messages; what comes later makes receives of its own."""
    log, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "checkpoint"))
    same = lambda df: df
    append_messages(messages(spark, *[f"{i:03d}" for i in range(47)]), log)
    take_receives(spark, log, same, out, checkpoint, receives=2)
    found = receives(spark, out)
    assert PER_RECEIVE == 10 and [len(v) for v in found.values()] == [10, 10, 10, 10, 7]
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 3
    append_messages(messages(spark, *[f"{i:03d}" for i in range(12)]), log)
    append_messages(messages(spark, "x"), log)
    take_receives(spark, log, same, out, checkpoint, receives=2)
    found = receives(spark, out)
    assert [len(v) for v in found.values()] == [10, 10, 10, 10, 7, 10, 3]
    assert sorted(o for v in found.values() for o in v) == list(range(60))
    assert all(v == list(range(first, first + len(v))) for first, v in found.items())


def test_a_repeated_receive_is_the_same(spark, tmp_path):
    """Handling fails once, and messages come in before it is repeated: the receive does not grow."""
    log, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "checkpoint"))
    append_messages(messages(spark, *[f"{i:03d}" for i in range(13)]), log)
    failed = []

    def handle(df):
        if not failed:
            failed.append(True)
            raise RuntimeError("handling failed")
        return df

    with pytest.raises(Exception, match="handling failed"):
        take_receives(spark, log, handle, out, checkpoint, receives=5)
    append_messages(messages(spark, *[f"{i:03d}" for i in range(9)]), log)
    take_receives(spark, log, handle, out, checkpoint, receives=5)
    found = receives(spark, out)
    assert {first: len(v) for first, v in found.items()} == {0: 10, 10: 3, 13: 9}
    assert sorted(o for v in found.values() for o in v) == list(range(22))


def test_a_backlog_is_few_batches(spark, tmp_path):
    """More messages than a batch once took are one batch, and its receives hold ten each."""
    log, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "checkpoint"))
    append_messages(spark.range(25_003).selectExpr("cast(id AS string) AS value", "id"), log, ["id"], unique=True)
    take_receives(spark, log, lambda messages: messages, out, checkpoint)
    assert [p.name for p in (tmp_path / "out").glob("batch_id=*")] == ["batch_id=0"]
    found = receives(spark, out)
    assert sorted(found) == list(range(0, 25_003, 10)) and all(len(found[k]) == 10 for k in found if k != 25_000)
    assert sorted(o for offsets in found.values() for o in offsets) == list(range(25_003))
