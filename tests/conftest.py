from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from ledgerline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    checkpoint = str(tmp_path_factory.mktemp("checkpoint"))
    conf = {"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": checkpoint}
    session = local_session(8, shuffle_partitions=8, **conf)
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Change session settings for one test."""
    before = {}

    def change(**settings):
        for name, value in settings.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def plan_of():
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
