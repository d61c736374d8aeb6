from __future__ import annotations

import io
import os
import subprocess
import sys
import urllib.error
import urllib.request

import pytest
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline.functions.answers import exists_by_field, exists_by_text
from ledgerline.operators.files import path_filter, unseen
from ledgerline.operators.joins import hot_keys, keyed_join, text_bytes
from ledgerline.operators.lookup import http_caller, lookup_exists, lookup_external

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def records(spark):
    """A third of the rows have key 1, a third have none, the rest are told apart; all keys twice."""
    key = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, 1).otherwise(F.col("id"))
    return spark.range(6000).select(key.alias("k"), (F.col("id") % 7).alias("v"))


@pytest.fixture
def entries(spark):
    return spark.range(0, 4000, 2).union(spark.range(1, 2)).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def expected(records, entries):
    names = {r.k: r.name for r in entries.collect()}
    return sorted(((r.k, r.v, r.k in names, names.get(r.k)) for r in records.collect()), key=repr)


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_no_record_is_dropped(records, entries, limit):
    checked = lookup_exists(records, entries, "k", answers=["name"], broadcast_bytes=limit)
    assert rows(checked) == expected(records, entries)


def test_large_table_plan(records, entries, plan_of):
    """One join: rows of hot keys are dealt over several places, their entries repeated there."""
    plan = plan_of(lookup_exists(records, entries, "k", broadcast_bytes=0))
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 1


def test_large_table_scans_the_records_twice(spark, conf):
    """Once for the hot keys, once for the join."""
    conf(spark__sql__adaptive__enabled="false")
    path = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{path}/orders.parquet").select("o_orderkey", "o_custkey")
    joined = lookup_exists(orders, spark.read.parquet(f"{path}/customer.parquet"), "o_custkey", "c_custkey", broadcast_bytes=0)
    assert joined._jdf.queryExecution().executedPlan().toString().count("orders.parquet") == 1


def test_large_table_without_hot_keys(spark, entries, plan_of):
    even = spark.range(50_000).select(F.col("id").alias("k"))
    joined = keyed_join(even, entries, "k", broadcast_bytes=0)
    assert "BroadcastHashJoin" not in plan_of(joined)
    assert joined.where("name IS NOT NULL").count() == entries.count()


def test_small_table_plan(spark, records, entries, plan_of):
    path = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{path}/orders.parquet").select("o_orderkey", "o_custkey")
    plan = plan_of(lookup_exists(orders, spark.read.parquet(f"{path}/supplier.parquet"), "o_custkey", "s_suppkey"))
    assert "BroadcastHashJoin" in plan and "Python" not in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan and "ReadSchema: struct<s_suppkey:bigint>" in plan


def test_hot_keys(records):
    hot = hot_keys(records, "k")
    assert None in hot and 1 in hot


@pytest.mark.parametrize("how", ["left_anti", "left_semi", "left"])
def test_ways_agree(records, entries, how):
    assert rows(keyed_join(records, entries, "k", how)) == rows(keyed_join(records, entries, "k", how, 0))


def test_only_null_keys(spark, entries):
    none = spark.range(100).select(F.lit(None).cast("long").alias("k"))
    for limit in (1 << 20, 0):
        assert lookup_exists(none, entries, "k", broadcast_bytes=limit).where("NOT exists").count() == 100


def test_repeated_entry_keys(spark):
    entries = spark.createDataFrame([(1, "b", False), (1, "a", False), (1, "c", True), (2, "z", False)], "k int, name string, found boolean")
    records = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    checked = lookup_exists(records, entries, "k", answers=["name"], exists_column="found")
    assert rows(checked) == [(1, True, "c"), (2, False, "z"), (3, False, None)]


def test_status_and_null_exists(spark):
    entries = spark.createDataFrame(
        [(1, 200, True), (2, 404, True), (3, 200, None), (4, None, True)], "k int, status int, found boolean"
    )
    records = spark.createDataFrame([(i,) for i in range(1, 6)], "k int")
    checked = lookup_exists(records, entries, "k", exists_column="found", status_column="status")
    assert rows(checked) == [(1, True), (2, False), (3, False), (4, False), (5, False)]


def test_switched_off(records):
    checked = lookup_exists(records, None, "k", enabled=False)
    assert checked.count() == 6000 and checked.where("exists").count() == 6000


def test_empty_table(spark, records, entries):
    assert lookup_exists(records, entries.limit(0), "k").where("exists").count() == 0


def test_answer_spellings(spark):
    answers = [
        ('{"exists":true}', 200, True, True),
        ('{"exists": true}', 200, True, True),
        ('{"exists" : true}', 200, False, True),
        ('[{"exists":true}]', 200, True, False),
        ('{"exists":false}', 200, False, False),
        ('{"exists":true}', 404, False, False),
        ('{"exists":true}', None, False, False),
        (None, 200, False, False),
        ("", 200, False, False),
    ]
    df = spark.createDataFrame(answers, "a string, s int, t boolean, f boolean")
    for r in df.withColumn("by_t", exists_by_text(F.col("a"), F.col("s"))).withColumn("by_f", exists_by_field(F.col("a"), F.col("s"))).collect():
        assert (r.by_t, r.by_f) == (r.t, r.f), r


def counting_caller(folder):
    def connect():
        def call(key):
            with open(f"{folder}/{key}", "a") as log:
                log.write("x")
            if key == 5:
                raise OSError("refused")
            return (404 if key == 8 else 200), '{"exists": true}'

        return call

    return connect


def test_external_asks_each_key_once(spark, tmp_path):
    records = spark.range(90).select(F.when(F.col("id") < 10, F.lit(None)).otherwise(F.col("id") % 9).alias("k"))
    checked = lookup_external(records, "k", counting_caller(str(tmp_path)), tasks=4)
    found = {r.k: (r.exists, r.status, r.error) for r in checked.distinct().collect()}
    assert checked.count() == 90
    assert found[1] == (True, 200, None) and found[8] == (False, 404, None)
    assert found[5] == (False, None, "refused") and found[None] == (False, None, None)
    assert {p.read_text() for p in tmp_path.iterdir()} == {"x"} and len(list(tmp_path.iterdir())) == 9


def test_external_failure_can_end_the_job(spark, tmp_path):
    records = spark.range(6).select(F.col("id").alias("k"))
    with pytest.raises(PySparkException, match="refused"):
        lookup_external(records, "k", counting_caller(str(tmp_path)), on_failure="raise")
    with pytest.raises(ValueError):
        lookup_external(records, "k", counting_caller(str(tmp_path)), on_failure="maybe")


def outside(code, *arguments):
    """Run code in a process that does not find this package by itself."""
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    command = [sys.executable, "-c", code, *arguments]
    return subprocess.run(command, cwd="/", env=clean, capture_output=True, text=True, timeout=300)


def test_executors_need_no_package(tmp_path):
    """The calls run where only Spark is installed."""
    (tmp_path / "sent").write_bytes(cloudpickle.dumps(http_caller("http://127.0.0.1:1")))
    done = outside("import pickle, sys; print(callable(pickle.load(open(sys.argv[1], 'rb'))()))", str(tmp_path / "sent"))
    assert done.stdout == "True\n", done.stderr
    code = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "from ledgerline.session import local_session\n"
        "import __spark_entry__ as e\n"
        "print('rows', e.queries()['lookup_external'](local_session(2), '/root/testdata/sf0.001').count())\n"
    )
    done = outside(code, ROOT)
    assert "rows 150" in done.stdout, done.stderr[-2000:]


def test_http_failure_is_no_answer(spark):
    records = spark.createDataFrame([(1,), (2,)], "k int")
    checked = lookup_external(records, "k", http_caller("http://127.0.0.1:1"), by_text=True, tasks=1)
    assert [(r.exists, r.status, bool(r.error)) for r in checked.collect()] == [(False, None, True)] * 2


def test_unseen_and_paths(spark):
    listing = spark.createDataFrame([("data/a.csv",), ("data/b.csv",), ("data/c.txt",), ("x/d.csv",), (None,)], "path string")
    seen = spark.createDataFrame([("data/a.csv",), ("data/a.csv",), (None,)], "path string")
    for limit in (1 << 20, 0):
        left = unseen(listing, seen, "path", broadcast_bytes=limit)
        assert rows(left) == rows(listing.where("path IS NULL OR path <> 'data/a.csv'"))
    assert rows(path_filter(listing, "path", "data/")) == [("data/a.csv",), ("data/b.csv",)]


def test_path_filter_reaches_the_scan(spark, plan_of):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url")
    plan = plan_of(path_filter(pages, "url", "https://", ".html"))
    assert "StringStartsWith(url,https://)" in plan and "StringEndsWith(url,.html)" in plan


def test_text_bytes(spark):
    assert text_bytes(spark.range(0)) == 0
    df = spark.createDataFrame([("é", 1, [1, 2]), (None, None, None)], "a string, b int, c array<int>")
    assert text_bytes(df) == 2 + 8 + len("[1,2]") + 8


class Answer:
    def __init__(self, status, body):
        self.status, self.body = status, body

    def read(self):
        return self.body

    def __enter__(self):
        return self

    def __exit__(self, *failure):
        return False


def test_any_status_is_an_answer(monkeypatch):
    """No server: the opener is replaced."""

    def opener(url, timeout):
        key = url.rsplit("/", 1)[1]
        if key == "404":
            raise urllib.error.HTTPError(url, 404, "none", None, io.BytesIO(b'{"exists":\r\n false}'))
        if key == "down":
            raise urllib.error.URLError("down")
        return Answer(200, b'{"exists": true}')

    monkeypatch.setattr(urllib.request, "urlopen", opener)
    call = http_caller("http://x")()
    assert call(1) == (200, '{"exists": true}')
    assert call(404) == (404, '{"exists": false}')
    with pytest.raises(urllib.error.URLError):
        call("down")


def test_calls_side_by_side(spark):
    def connect():
        import threading

        together = threading.Barrier(4, timeout=20)

        def call(key):
            together.wait()
            return 200, '{"exists": true}'

        return call

    records = spark.range(8).select(F.col("id").alias("k"))
    checked = lookup_external(records, "k", connect, tasks=1, calls_per_task=4)
    assert checked.where("exists").count() == 8


def test_prepared_lookup_measures_once(spark, records, entries, monkeypatch):
    from ledgerline.operators import lookup

    measured = []
    monkeypatch.setattr(lookup, "text_bytes", lambda df: measured.append(df) or 0)
    prepared = lookup.prepare_lookup(entries, "k", answers=["name"], keep=True)
    for _ in range(3):
        assert rows(prepared.check(records)) == expected(records, entries)
    assert len(measured) == 1
