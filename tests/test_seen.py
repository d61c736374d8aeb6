"""The index of seen names: right whatever the filters say, and reading little."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from ledgerline.operators.files import unseen
from ledgerline.operators.seen import add_seen, bloom, merge_seen, perhaps, perhaps_seen, unseen_by_index


def names(spark, *values):
    return spark.createDataFrame([(v, n) for n, v in enumerate(values)], "path string, n int")


def test_filters():
    r = np.random.default_rng(1)
    for n in (1, 6, 7, 100, 20_000):
        h1, h2, other = (r.integers(-(2**63), 2**63 - 1, n) for _ in range(3))
        made = bloom(h1, h2)
        assert perhaps(made, h1, h2).all()
        if n > 1000:
            assert perhaps(made, other, h2[::-1]).mean() < 0.02
            assert len(made) <= 4 * 10 * n / 8


def test_as_the_plain_way(spark, tmp_path):
    r = random.Random(2)
    index = str(tmp_path / "index")
    seen = [f"data/é{r.randint(0, 600)}.csv" for _ in range(400)]
    files = names(spark, *[f"data/é{k}.csv" for k in range(600)], None, "", None, "data/é1.csv")
    everything = lambda df: sorted(((r.path or "", r.n) for r in df.collect()))
    assert everything(unseen_by_index(files, index, "path")) == everything(files)
    for k in range(3):
        add_seen(names(spark, *seen[: 200 * k + 1], None, ""), index, "path", parts=5)
        want = unseen(files, names(spark, *seen[: 200 * k + 1], ""), "path")
        assert everything(unseen_by_index(files, index, "path")) == everything(want)
    assert merge_seen(spark, index) == 4 and merge_seen(spark, index) == 4
    assert everything(unseen_by_index(files, index, "path")) == everything(want)
    assert everything(unseen_by_index(names(spark), index, "path")) == []


def test_other_parts_are_not_read(spark, tmp_path):
    """All files of the parts that no filter points at are made unreadable."""
    index = tmp_path / "index"
    add_seen(names(spark, *[f"old/{k}" for k in range(500)]), str(index), "path", parts=32)
    listing = names(spark, *[f"new/{k}" for k in range(20)], "old/7")
    hopeful = perhaps_seen(listing, str(index), "path")
    parts = {r.part for r in hopeful.collect()}
    assert "old/7" in {r.name for r in hopeful.collect()} and len(parts) < 8
    asked = {r.p for r in listing.select(F.pmod(F.xxhash64(F.lit("part"), "path"), F.lit(32)).alias("p")).collect()}
    spoilt = 0
    for kind, needed in (("names", parts), ("filters", asked)):
        for file in index.glob(f"{kind}/segment=1/part=*/*.parquet"):
            if int(file.parent.name.split("=")[1]) not in needed:
                file.write_bytes(b"not parquet")
                (file.parent / f".{file.name}.crc").unlink()
                spoilt += 1
    assert spoilt > 30
    left = unseen_by_index(listing, str(index), "path").collect()
    assert sorted(r.path for r in left) == sorted(f"new/{k}" for k in range(20))


def test_a_segment_counts_when_it_is_whole(spark, tmp_path):
    """Names of an addition that was cut short are not seen, and the next addition takes their place."""
    index = str(tmp_path / "index")
    add_seen(names(spark, "a"), index, "path", parts=2)
    names(spark, "b").selectExpr("path AS name", "0L h1", "0L h2", "0 part").write.partitionBy("part").parquet(f"{index}/names/segment=2")
    assert unseen_by_index(names(spark, "a", "b"), index, "path").first().path == "b"
    assert add_seen(names(spark, "c"), index, "path") == 2
    assert [r.path for r in unseen_by_index(names(spark, "a", "b", "c"), index, "path").collect()] == ["b"]
