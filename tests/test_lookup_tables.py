"""Lookup tables in buckets, in versions and as rules, and the counts that streams report."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F, types as T

from ledgerline.operators import joins
from ledgerline.operators.bucketed import BucketedLookup, bucket_lookup
from ledgerline.operators.lookup import lookup_exists
from ledgerline.operators.rules import FARTHEST, lookup_rules
from ledgerline.streaming.messages import arriving_messages, stream_checked, stream_messages
from ledgerline.streaming.progress import ProgressLog, read_progress
from ledgerline.streaming.versions import publish_lookup, read_checked, read_version, stream_lookup_versions

ONCE = {"availableNow": True}


@pytest.fixture
def known(spark):
    """Keys 0 to 1999, each even one twice, in a table of 16 buckets."""
    rows = spark.range(2000).selectExpr("id AS k", "concat('n', id) AS name", "id % 7 <> 0 AS found")
    rows = rows.union(spark.range(0, 2000, 2).selectExpr("id", "'later'", "false"))
    name = f"known_{random.randrange(10**12)}"
    without_key = spark.createDataFrame([(None, "none", True)], "k long, name string, found boolean")
    bucket_lookup(rows.union(without_key), name, "k", answers=["name"], exists_column="found", buckets=16)
    yield rows, BucketedLookup(spark, name, "k", ["name"])
    spark.sql(f"DROP TABLE {name}")


def test_a_batch_shuffles_only_itself(spark, known, plan_of, conf):
    rows, lookup = known
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    asked = spark.range(0, 4000, 3).withColumnRenamed("id", "k")
    plan = plan_of(lookup.check(asked))
    assert "SortMergeJoin" in plan and "SelectedBucketsCount: 16 out of 16" in plan
    # The one exchange is that of the records, into as many parts as there are buckets.
    assert plan.count("Exchange") == 1 and "Exchange hashpartitioning(_asked" in plan and ", 16)" in plan


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_buckets_answer_as_the_table(spark, known, kind):
    """Ordinary, hot, unknown and null keys; keys of another type than the table's."""
    rows, lookup = known
    asked = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN 8 WHEN id % 5 = 0 THEN NULL ELSE id END AS k", "id AS n")
    asked = asked.withColumn("k", F.col("k").cast(kind))
    if kind == "string":
        asked = asked.union(spark.createDataFrame([("no number", 1)], "k string, n long"))
    want = lookup_exists(asked.withColumn("k", F.col("k").try_cast("bigint")), rows, "k", answers=["name"], exists_column="found")
    found = lookup.check(asked)
    assert found.columns == ["k", "n", "exists", "name"]
    pick = lambda df: sorted((r.n, r.exists, r.name or "") for r in df.collect())
    assert pick(found) == pick(want)


def test_hot_rows_are_broadcast(spark, known, plan_of):
    _, lookup = known
    asked = spark.range(3000).selectExpr("CASE WHEN id % 2 = 0 THEN 8 ELSE id END AS k")
    plan = plan_of(lookup.check(asked))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    assert joins.hot_keys(asked, "k") == [8]


def test_a_stream_over_buckets(spark, known, tmp_path):
    _, lookup = known
    inbox, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    spark.range(3000).withColumnRenamed("id", "k").repartition(3).write.parquet(inbox)
    arriving = spark.readStream.schema("k long").option("maxFilesPerTrigger", 1).parquet(inbox)
    stream_checked(arriving, lookup.check, out, log, trigger=ONCE).awaitTermination()
    found = spark.read.parquet(out)
    assert found.count() == 3000 and found.where("name IS NOT NULL").count() == 2000
    assert found.select("batch_id").distinct().count() == 3


def callers(spark, folder, name, first, end):
    spark.range(first, end).withColumnRenamed("id", "k").coalesce(1).write.parquet(f"{folder}/{name}")


def run_versions(spark, folder, root, out, log):
    arriving = spark.readStream.schema("k long").option("recursiveFileLookup", "true").parquet(folder)
    stream_lookup_versions(arriving, root, "k", out, str(log), answers=["name"], trigger=ONCE).awaitTermination()
    return sorted((r.k, r.exists, r.name, r.version) for r in read_checked(spark, out).collect())


def table(spark, *keys, name):
    return spark.createDataFrame([(k, f"{name}{k}") for k in keys], "k long, name string")


def test_batches_take_the_newest_version(spark, tmp_path):
    folder, root, out, log = (str(tmp_path / n) for n in ("in", "root", "out", "log"))
    assert publish_lookup(table(spark, 1, 2, name="a"), root, "k", answers=["name"]) == 1
    callers(spark, folder, "first", 0, 3)
    first = [(0, False, None, 1), (1, True, "a1", 1), (2, True, "a2", 1)]
    assert run_versions(spark, folder, root, out, log) == first
    assert publish_lookup(table(spark, 3, name="b"), root, "k", answers=["name"]) == 2
    callers(spark, folder, "second", 2, 4)
    assert run_versions(spark, folder, root, out, log) == sorted([*first, (2, False, None, 2), (3, True, "b3", 2)], key=str)
    assert read_version(spark, root, 1).count() == 2


def test_a_repeated_batch_keeps_its_version(spark, tmp_path):
    folder, root, out, log = (str(tmp_path / n) for n in ("in", "root", "out", "log"))
    publish_lookup(table(spark, 1, name="a"), root, "k", answers=["name"])
    callers(spark, folder, "first", 0, 2)
    before = run_versions(spark, folder, root, out, log)
    for name in ("0", ".0.crc"):
        (tmp_path / "log" / "commits" / name).unlink()
    publish_lookup(table(spark, 0, name="b"), root, "k", answers=["name"])
    assert run_versions(spark, folder, root, out, log) == before == [(0, False, None, 1), (1, True, "a1", 1)]


def test_no_version_yet(spark, tmp_path):
    folder, root, out, log = (str(tmp_path / n) for n in ("in", "root", "out", "log"))
    callers(spark, folder, "first", 0, 2)
    with pytest.raises(Exception, match="no version"):
        run_versions(spark, folder, root, out, log)
    publish_lookup(table(spark, 1, name="a"), root, "k", answers=["name"])
    assert [r[1] for r in run_versions(spark, folder, root, out, log)] == [False, True]


RULES = "kind string, key string, low long, high long, priority int, exists boolean, answer string"
ORDER = ["exact", "prefix", "range", "any"]


def fits(rule, key):
    kind, name, low, high = rule[:4]
    if key is None:
        return False
    text = str(key)
    if kind == "exact":
        return text == name
    if kind == "prefix":
        return name is not None and text.startswith(name)
    if kind == "range":
        if not text.lstrip("-").isdigit() or abs(int(text)) > FARTHEST:
            return False
        return (low is None or int(text) >= low) and (high is None or int(text) <= high)
    return kind == "any"


def decided(rules, key):
    fitting = [r for r in rules if fits(r, key)]
    if not fitting:
        return False, None, None
    won = min(fitting, key=lambda r: (5 if r[4] is None else r[4], ORDER.index(r[0]), r[5] is not False, r[6]))
    return won[5] is not False, won[0], won[6]


def check_rules(spark, rules, keys, kind, **options):
    records = spark.createDataFrame([(k, n) for n, k in enumerate(keys)], f"k {kind}, n long")
    found = lookup_rules(records, spark.createDataFrame(rules, RULES), "k", ["answer"], **options)
    assert found.columns == ["k", "n", "exists", "rule", "answer"]
    got = {r.n: (r.exists, r.rule, r.answer) for r in found.collect()}
    assert got == {n: decided(rules, k) for n, k in enumerate(keys)}


def some_rules(seed, n):
    r = random.Random(seed)
    rules = []
    for i in range(n):
        low = r.randint(-300, 300)
        rules.append(
            r.choice(
                [
                    ("exact", str(r.randint(-50, 300)), None, None),
                    ("prefix", str(r.randint(0, 99)), None, None),
                    ("range", None, low, low + r.choice([0, 1, 5, 63, 64, 1000])),
                    ("range", None, None, low),
                    ("range", None, low, None),
                    ("range", None, low, low - 1),
                ]
            )
            + (r.choice([None, 1, 3, 5, 5, 9]), r.choice([None, True, False]), f"rule {i}")
        )
    return rules


@pytest.mark.parametrize("limit", [1 << 25, 0])
def test_rules_by_priority(spark, limit):
    rules = some_rules(1, 120) + [("any", None, None, None, 10, False, "nobody"), ("any", None, None, None, 12, True, "x")]
    rules += [("odd kind", "1", None, None, 0, True, "never")]
    keys = [*range(-320, 320, 3), None, 5, 5, 5, FARTHEST, FARTHEST + 1, -FARTHEST, -FARTHEST - 1, 2**63 - 1]
    check_rules(spark, rules, keys, "bigint", broadcast_bytes=limit)


def test_rules_of_text_keys(spark):
    rules = some_rules(2, 40) + [("exact", "é|x", None, None, 1, True, "é"), ("prefix", "", None, None, 9, True, "all")]
    rules += [("exact", None, 1, 2, 0, True, "no key"), ("prefix", None, None, None, 0, True, "no key")]
    check_rules(spark, rules, ["é|x", "é", "", "12", "-7", "007", "12x", None, "99999999999999999999"], "string")


def test_ranges_to_the_ends(spark):
    rules = [("range", None, None, None, 5, True, "all"), ("range", None, 2**63 - 1, None, 1, True, "none"),
             ("range", None, -(2**63), -FARTHEST, 1, True, "lowest")]
    check_rules(spark, rules, [0, FARTHEST, -FARTHEST, FARTHEST - 1, -1], "bigint")


def test_no_rules(spark):
    check_rules(spark, [], [1, None], "bigint")
    check_rules(spark, [("exact", "1", None, None, None, None, "one")], [], "bigint")


def test_rules_use_no_cross_join(spark, plan_of):
    records = spark.range(100).withColumnRenamed("id", "k")
    plan = plan_of(lookup_rules(records, spark.createDataFrame(some_rules(3, 30), RULES), "k", ["answer"]))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_counts_of_batches_are_kept(spark, tmp_path):
    inbox, out, log, kept = (tmp_path / n for n in ("in", "out", "log", "kept"))
    inbox.mkdir()
    fields = T.StructType.fromDDL("k long")
    listener = ProgressLog(spark, str(kept))
    spark.streams.addListener(listener)

    def run():
        arriving = arriving_messages(spark, str(inbox), max_files_per_trigger=1)
        query = stream_messages(arriving, str(out), str(log), fields, trigger=ONCE)
        query.awaitTermination()
        listener.await_batches(query)
        rows = read_progress(spark, str(kept)).collect()
        return {(r.batch_id, r["count"]): r.value for r in rows}

    try:
        (inbox / "1").write_text('{"k":1}\nbroken\n')
        (inbox / "2").write_text('{"k":1}\n{"k":2}\n{"k":3}\n')
        counts = {(0, "records"): 2, (0, "handled"): 1, (1, "records"): 3, (1, "handled"): 3}
        assert run() == counts
        for name in ("1", ".1.crc"):
            (log / "commits" / name).unlink()
        assert run() == counts  # batch 1 came again and counts once
    finally:
        spark.streams.removeListener(listener)
