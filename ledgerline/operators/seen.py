"""An index of seen names, so that telling what is new reads a small part of what was seen.

Names lie in ``parts`` by hash. Each addition is a segment, ``names/segment=S/part=P``, with a Bloom filter per part in
``filters/segment=S/part=P``; ``manifests`` says which segments count, and the newest entry holds. A new name is
looked for in the filters of its part only, and only the parts where a filter says "perhaps" are read. Merging
makes one segment of all. One writer at a time; readers see a segment when all of it is there.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.operators.joins import keyed_join
from ledgerline.session import materialize, ship_package

PARTS = 64
BITS = 10  # of a filter, for each name: one new name in about 120 looks as if it had been seen
HASHES = 7

_MANIFEST = "manifest long, segment long, parts int"


def _manifest(spark: SparkSession, path: str) -> tuple[int, list[int], int | None]:
    """Number of the newest manifest, the segments that count, and the number of parts; 0 and none before the first."""
    try:
        rows = spark.read.schema(_MANIFEST).parquet(f"{path}/manifests").collect()
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    newest = max((r["manifest"] for r in rows), default=0)
    live = sorted(r["segment"] for r in rows if r["manifest"] == newest)
    return newest, live, rows[0]["parts"] if rows else None


def _hashed(names: DataFrame, parts: int) -> DataFrame:
    """Two hashes of each ``name`` and its part."""
    first, second = F.xxhash64("name"), F.xxhash64(F.lit("second"), "name")
    return names.select("name", first.alias("h1"), second.alias("h2"), F.pmod(F.xxhash64(F.lit("part"), "name"), F.lit(parts)).cast("int").alias("part"))


def _positions(h1: np.ndarray, h2: np.ndarray, size: int) -> np.ndarray:
    """The bits of each name, a row each; ``size`` is a power of two."""
    with np.errstate(over="ignore"):
        steps = h1.astype(np.uint64)[:, None] + np.arange(HASHES, dtype=np.uint64) * (h2.astype(np.uint64) | np.uint64(1))[:, None]
    # High bits, since low bits of a step by an odd number repeat.
    return (steps >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def bloom(h1: np.ndarray, h2: np.ndarray) -> bytes:
    size = max(64, 1 << (BITS * len(h1) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[_positions(h1, h2, size).ravel()] = True
    return np.packbits(bits).tobytes()


def perhaps(filter_bits: bytes, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each name may be among those of the filter; true for all that are."""
    bits = np.frombuffer(filter_bits, np.uint8)
    at = _positions(h1, h2, 8 * len(bits))
    return (bits[at >> 3] >> (7 - (at & 7)) & 1).all(1)


def _write_segment(names: DataFrame, path: str, number: int, live: Sequence[int], parts: int) -> int:
    """Write distinct names as a segment; ``live`` are the segments that count beside it."""
    spark = names.sparkSession
    segment = f"{path}/names/segment={number}"
    hashed = _hashed(names.where(F.col("name").isNotNull()).distinct(), parts).repartition(parts, "part")
    hashed.select("name", "h1", "h2", "part").sortWithinPartitions("part", "name").write.partitionBy("part").mode(
        "overwrite"
    ).parquet(segment)

    # Runs on the executors, one part at a time: 16 bytes a name.
    def build(table: pa.Table) -> pa.Table:
        from ledgerline.operators.seen import bloom

        made = bloom(table.column("h1").to_numpy(), table.column("h2").to_numpy())
        return pa.table({"part": table.column("part").slice(0, 1), "bits": pa.array([made], pa.binary())})

    written = spark.read.schema("name string, h1 long, h2 long, part int").parquet(segment)
    filters = written.select("part", "h1", "h2").groupBy("part").applyInArrow(build, "part int, bits binary")
    filters.write.partitionBy("part").mode("overwrite").parquet(f"{path}/filters/segment={number}")
    rows = [(number, s, parts) for s in [*live, number]]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifests")
    return number


def add_seen(names: DataFrame, path: str, key: str, parts: int = PARTS) -> int:
    """Add the column ``key`` of ``names`` to the index at ``path`` and return its segment.

    ``parts`` counts when the index is new and then stays: choose it for some million names a part. Null is no
    name; names that were added before do no harm.
    """
    ship_package(names.sparkSession)
    newest, live, known = _manifest(names.sparkSession, path)
    return _write_segment(names.select(F.col(key).cast("string").alias("name")), path, newest + 1, live, known or parts)


def _read(spark: SparkSession, path: str, kind: str, live: Sequence[int], schema: str, parts: Sequence[int]) -> DataFrame:
    """Rows of the named parts of the segments that count; other parts are not opened."""
    folders = [f"{path}/{kind}/segment={s}" for s in live]
    return spark.read.schema(f"{schema}, part int").option("basePath", f"{path}/{kind}").parquet(*folders).where(F.col("part").isin(list(parts)))


def merge_seen(spark: SparkSession, path: str) -> int:
    """Make one segment of all that count; what they held stays for who still reads it. Returns the segment, 0 if there is none."""
    newest, live, parts = _manifest(spark, path)
    if len(live) < 2:
        return live[0] if live else 0
    ship_package(spark)
    names = _read(spark, path, "names", live, "name string", range(parts)).select("name")
    return _write_segment(names, path, newest + 1, [], parts)


def perhaps_seen(files: DataFrame, path: str, key: str) -> DataFrame | None:
    """``name`` and ``part`` of the distinct keys of ``files`` that a filter may hold, as a written table; None without an index."""
    spark = files.sparkSession
    _, live, parts = _manifest(spark, path)
    if not live:
        return None
    ship_package(spark)
    names = files.select(F.col(key).cast("string").alias("name")).where(F.col("name").isNotNull()).distinct()
    asked = materialize(_hashed(names, parts), "asked-names")
    touched = [r["part"] for r in asked.select("part").distinct().collect()]  # ``parts`` at most
    filters = _read(spark, path, "filters", live, "bits binary", touched)

    def test(left: pa.Table, right: pa.Table) -> pa.Table:
        from ledgerline.operators.seen import perhaps

        h1, h2 = left.column("h1").to_numpy(), left.column("h2").to_numpy()
        hit = np.zeros(len(h1), bool)
        for bits in right.column("bits").to_pylist() if len(h1) else ():
            hit |= perhaps(bits, h1, h2)
        return left.select(["name", "part"]).filter(pa.array(hit))

    met = asked.groupBy("part").cogroup(filters.groupBy("part")).applyInArrow(test, "name string, part int")
    return materialize(met, "perhaps-seen")


def unseen_by_index(files: DataFrame, path: str, key: str) -> DataFrame:
    """Rows of ``files`` whose ``key`` is not in the index at ``path``, as :func:`unseen` gives them.

    Without an index all rows are new. Rows with a null key always are.
    """
    spark = files.sparkSession
    hopeful = perhaps_seen(files, path, key)
    if hopeful is None:
        return files
    _, live, _ = _manifest(spark, path)
    parts = [r["part"] for r in hopeful.select("part").distinct().collect()]
    if not parts:
        return files
    names = _read(spark, path, "names", live, "name string", parts).select("name")
    known = keyed_join(hopeful.select("name"), names.distinct(), "name", "left_semi", measure=names)
    known = materialize(known, "seen-names").select(F.col("name").cast(files.schema[key].dataType).alias(key))
    return keyed_join(files, known, key, "left_anti")
