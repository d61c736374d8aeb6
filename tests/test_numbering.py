from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.joins import has_many_copies, keyed_join, places_of
from ledgerline.operators.numbering import message_batches, number_rows, sort_rows


@pytest.fixture
def skewed(spark):
    """Two thirds of the rows are copies of one row; null is a group too."""
    group = F.when(F.col("id") % 3 < 2, F.lit("hot")).when(F.col("id") % 3 == 2, F.concat(F.lit("g"), F.col("id") % 11))
    group = F.when(F.col("id") % 50 == 2, F.lit(None)).otherwise(group)
    key = F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id"))
    return spark.range(5000).select(group.alias("g"), key.alias("k"))


def expected(df, batch=False):
    counts, out = {}, []
    for r in sorted(map(tuple, df.collect()), key=lambda r: (r[0] is not None, r)):
        counts[r[0]] = counts.get(r[0], 0) + 1
        out.append((*r, (counts[r[0]] - 1) // 10 if batch else counts[r[0]]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("unique", [True, False])
def test_numbers_per_group(skewed, conf, unique):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    numbered = number_rows(skewed, ["k"], ["g"], unique=unique)
    assert sorted(map(tuple, numbered.collect()), key=repr) == expected(skewed)


def test_dense_over_all(skewed, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    numbered = number_rows(skewed, ["k", "g"], name="n").orderBy("n").collect()
    assert [r.n for r in numbered] == list(range(1, 5001))
    assert [r.k for r in numbered] == sorted(r.k for r in skewed.collect())


def test_empty(spark):
    assert number_rows(spark.range(0), ["id"]).count() == 0


def test_batches(skewed):
    batches = message_batches(skewed, "g", ["k"])
    assert sorted(map(tuple, batches.collect()), key=repr) == expected(skewed, batch=True)
    assert batches.groupBy("g", "batch").count().agg(F.max("count")).first()[0] == 10


def test_copies_are_spread(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    same = spark.range(4000).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    out = sort_rows(same.repartition(8), ["k"])
    sizes = [n for n in out.rdd.glom().map(len).collect() if n]
    assert sum(sizes) == 4000 and max(sizes) < 2000


def test_order_over_partitions(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    mixed = spark.range(3000).select((F.col("id") * 7919 % 100).alias("k"), F.col("id").alias("v"))
    out = sort_rows(mixed, ["k"]).collect()
    assert [r.k for r in out] == sorted(r.k for r in mixed.collect())
    assert sorted(r.v for r in out) == list(range(3000))


def test_no_window_over_the_rows(spark, plan_of):
    """Rows are read back from the written table and joined with the few counts."""
    plan = plan_of(number_rows(spark.range(1000), ["id"], unique=True))
    assert "Window" not in plan and "BroadcastHashJoin" in plan


def test_values_stay_as_they_are(spark):
    rows = spark.createDataFrame([(-0.0, "a"), (0.0, "a"), (float("nan"), None)], "x double, t string")
    assert sorted(repr(r.x) for r in sort_rows(rows, ["t"]).collect()) == ["-0.0", "0.0", "nan"]


def test_one_shuffle(spark, plan_of):
    same = spark.range(100).select(F.lit(1).alias("k"))
    assert plan_of(sort_rows(same, ["k"])).count("Exchange") == 1


def test_places_do_not_depend_on_the_order_of_rows(spark):
    """What a task finds for its rows it finds again when they come in another order."""
    rows = spark.range(3000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"), F.lit(None).cast("string").alias("t"))
    where = []
    for order in ("v", F.desc("v"), F.rand(7)):
        df, place = places_of(rows.repartition(1).sortWithinPartitions(order), 64, False)
        where.append({r.v: r.p for r in df.select("v", place.alias("p")).collect()})
    assert where[0] == where[1] == where[2] and len(set(where[0].values())) == 64


def test_copies_are_dealt_from_written_rows(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    same = spark.range(4000).select(F.lit(1).alias("k"))
    assert has_many_copies(same) and not has_many_copies(spark.range(4000)) and not has_many_copies(spark.range(0))
    df, place = places_of(same, 16, True)
    counts = [r["count"] for r in df.select(place.alias("p")).groupBy("p").count().collect()]
    assert len(counts) == 16 and max(counts) < 500
    joined = keyed_join(same, spark.createDataFrame([(1, "x")], "k int, a string"), "k", broadcast_bytes=0)
    assert joined.count() == 4000 and joined.where("a = 'x'").count() == 4000
