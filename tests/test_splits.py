"""Splits of a read by an uneven key, with a reader whose database is this session."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.sources.extract import even_predicates, jdbc_extract


class Database:
    """Stands in for the JDBC reader: runs the SQL it is given over temporary views."""

    def __init__(self, spark):
        self.spark, self.read, self.asked, self.sizes = spark, self, [], []

    def format(self, kind):
        assert kind == "jdbc"
        return self

    def options(self, **given):
        self.query = given["query"]
        return self

    def load(self):
        self.asked.append(self.query)
        return self.spark.sql(self.query)

    def jdbc(self, url, table, predicates, properties):
        parts = [self.spark.sql(f"SELECT * FROM {table} WHERE {p}") for p in predicates]
        self.sizes = [p.count() for p in parts]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.union(part)
        return whole


def rows_of(spark, keys, kind="bigint"):
    spark.createDataFrame([(k,) for k in keys], f"k {kind}").createOrReplaceTempView("uneven")


def extract(spark, parts=8):
    database = Database(spark)
    found = jdbc_extract(database, "u", "me", "pw", "SELECT * FROM uneven", partition_column="k", num_partitions=parts, even=True)
    return sorted((r.k for r in found.collect()), key=lambda k: (k is not None, k)), database


@pytest.mark.parametrize("shape", ["squares", "powers", "two heaps", "one outlier"])
def test_uneven_keys_give_even_parts(spark, shape):
    r = random.Random(4)
    keys = {
        "squares": [k * k for k in range(4000)],
        "powers": [int(1.0095**k) + k for k in range(4000)],
        "two heaps": [r.randint(0, 2000) for _ in range(2000)] + [10**12 + r.randint(0, 2000) for _ in range(2000)],
        "one outlier": [*range(3999), 2**62],
    }[shape]
    rows_of(spark, keys)
    found, database = extract(spark)
    assert found == sorted(keys)
    assert len(database.sizes) == 8 and max(database.sizes) <= 1.5 * len(keys) / 8
    assert len(database.asked) <= 9


def test_hot_values_and_nulls(spark):
    keys = [7] * 3000 + list(range(1000)) + [None] * 50 + [-5] * 20
    rows_of(spark, keys)
    found, database = extract(spark)
    assert found == sorted(keys, key=lambda k: (k is not None, k or 0)) or sorted(map(str, found)) == sorted(map(str, keys))
    # The hot value is one part's; what is left is parted among the others.
    assert sorted(database.sizes)[-1] <= 3000 + 600 and len(database.sizes) >= 3


def test_few_or_no_rows(spark):
    for keys in ([], [None, None], [5, 5, 5]):
        rows_of(spark, keys)
        assert even_predicates(spark.sql, "SELECT * FROM uneven", "k", 4) == []
    rows_of(spark, [1, 2])
    parts = even_predicates(spark.sql, "SELECT * FROM uneven", "k", 4)
    assert [spark.sql(f"SELECT * FROM uneven WHERE {p}").count() for p in parts] == [1, 1]


def test_decimals(spark):
    spark.range(1000).select((F.col("id") * F.col("id") / 7).cast("decimal(20,4)").alias("k")).createOrReplaceTempView("uneven")
    parts = even_predicates(spark.sql, "SELECT * FROM uneven", "k", 4)
    sizes = [spark.sql(f"SELECT * FROM uneven WHERE {p}").count() for p in parts]
    assert sum(sizes) == 1000 and len(sizes) == 4 and max(sizes) < 400


def test_counts_that_come_back_are_bounded(spark):
    rows_of(spark, [k * k for k in range(3000)])
    most = []

    def ask(query):
        found = spark.sql(query)
        most.append(found.count())
        return found

    even_predicates(ask, "SELECT * FROM uneven", "k", 8, cells=100)
    assert max(most) <= 100


def test_text_keys_are_refused(spark):
    rows_of(spark, ["a", "b"], "string")
    with pytest.raises(ValueError):
        even_predicates(spark.sql, "SELECT * FROM uneven", "k", 4)
    with pytest.raises(ValueError):
        jdbc_extract(Database(spark), "u", "me", "pw", "SELECT 1 AS k", even=True)
