"""Where streams keep what they remember of each key."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = {
    _PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, unless the session names a provider itself.

    State then lies on the executors' disks instead of in their heaps, and a batch writes only what changed to
    the checkpoint. The settings are put back: a stream keeps those it was started with.
    """
    if spark.conf.get(_PROVIDER, None) is not None:
        yield
        return
    before = {name: spark.conf.get(name, None) for name in _ROCKSDB}
    for name, value in _ROCKSDB.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
