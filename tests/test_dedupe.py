"""Copies of messages over batches: the keys are state, the output is never read."""

from __future__ import annotations

import os
import time

from pyspark.sql import types as T

from ledgerline.streaming.messages import arriving_messages, stream_messages
from ledgerline.streaming.state import keyed_state

ONCE = {"availableNow": True}
FIELDS = T.StructType([T.StructField("emp_id", T.LongType()), T.StructField("n", T.LongType())])


def start(spark, folder, out, log, **options):
    arriving = arriving_messages(spark, str(folder), max_files_per_trigger=1, arrival=True)
    query = stream_messages(arriving, str(out), str(log), FIELDS, dedupe=["emp_id"], trigger=ONCE, **options)
    query.awaitTermination()
    return query


def drop(folder, name, *texts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(texts) + "\n")


def good(spark, out):
    return sorted(r.emp_id for r in spark.read.parquet(str(out)).where("reject_reason is null").collect())


def test_a_later_batch_reads_no_earlier_output(spark, tmp_path):
    folder, out, log = (tmp_path / n for n in ("in", "out", "log"))
    drop(folder, "1", *['{"emp_id":%d}' % i for i in range(50)], "broken")
    drop(folder, "2", *['{"emp_id":%d}' % i for i in range(25, 75)])
    start(spark, folder, out, log)
    written = [p for p in out.iterdir() if p.suffix == ".parquet"]
    assert good(spark, out) == list(range(75))
    for path in written:
        path.unlink()
    drop(folder, "3", *['{"emp_id":%d}' % i for i in range(60, 90)])
    query = start(spark, folder, out, log)
    fresh = [str(p) for p in out.iterdir() if p.suffix == ".parquet"]
    rows = spark.read.parquet(*fresh).collect()
    assert sorted(r.emp_id for r in rows) == list(range(75, 90))
    state = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"]]
    # What is known of the past is one entry a key, and rejects are none of it.
    assert state[-1]["numRowsTotal"] == 90 and state[-1]["customMetrics"].keys() & {"rocksdbGetCount"}


def test_one_of_equal_keys_in_a_batch(spark, tmp_path):
    folder, out, log = (tmp_path / n for n in ("in", "out", "log"))
    drop(folder, "1", *['{"emp_id":%d,"n":%d}' % (i % 3, i) for i in range(30)], *['{"n":1}'] * 4, *["{"] * 5)
    start(spark, folder, out, log)
    rows = spark.read.parquet(str(out)).collect()
    assert sorted(r.emp_id for r in rows if r.emp_id is not None) == [0, 1, 2]
    assert sum(r.reject_reason == "bad_json" for r in rows) == 5
    assert sum(r.emp_id is None and r.n == 1 for r in rows) == 4


def test_repeated_batch_replaces_itself(spark, tmp_path):
    """The commit of the second batch is lost: its rows come once."""
    folder, out, log = (tmp_path / n for n in ("in", "out", "log"))
    drop(folder, "1", *['{"emp_id":%d}' % i for i in range(5)])
    drop(folder, "2", *['{"emp_id":%d}' % i for i in range(3, 8)])
    start(spark, folder, out, log)
    last = max(int(p.name) for p in (log / "commits").iterdir() if p.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (log / "commits" / name).unlink()
    start(spark, folder, out, log)
    assert good(spark, out) == list(range(8))


def test_keys_can_be_forgotten(spark, tmp_path):
    folder, out, log = (tmp_path / n for n in ("in", "out", "log"))
    now = time.time()
    for name, age in (("1", 60), ("2", 50), ("3", 10), ("4", 0)):
        drop(folder, name, '{"emp_id":1}', '{"emp_id":%s}' % name)
        os.utime(folder / name, (now - age * 86_400, now - age * 86_400))
        query = start(spark, folder, out, log, dedupe_within="15 days")
    kept = good(spark, out)
    assert kept == [1, 1, 2, 3, 4]
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] < 4


def test_state_settings(spark, conf):
    name = "spark.sql.streaming.stateStore.providerClass"
    with keyed_state(spark):
        assert "RocksDB" in spark.conf.get(name)
    assert spark.conf.get(name, None) is None
    own = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    conf(spark__sql__streaming__stateStore__providerClass=own)
    with keyed_state(spark):
        assert spark.conf.get(name) == own
