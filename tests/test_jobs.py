"""The jobs of streams by their command lines, and what they leave behind."""

from __future__ import annotations

import json
import os

import pytest

from ledgerline.plans import jobs
from ledgerline.session import materialize, passing_tables
from ledgerline.streaming.events import read_events_table
from ledgerline.streaming.retry import read_receipts


def given(*arguments):
    return jobs.arguments_of().parse_args([str(a) for a in arguments])


@pytest.fixture
def listeners(spark, monkeypatch):
    """Takes the jobs' listeners off again."""
    added = []
    real = jobs.ProgressLog
    monkeypatch.setattr(jobs, "ProgressLog", lambda *a: added.append(real(*a)) or added[-1])
    yield added
    for one in added:
        spark.streams.removeListener(one)


def scratch(spark):
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def lines(folder, name, *rows):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text("\n".join(["header", *rows]) + "\n")


def test_files_job_archives_and_counts(spark, tmp_path, listeners):
    inbox, sent, done = tmp_path / "in", tmp_path / "sent", tmp_path / "done"
    before = scratch(spark)
    for n in range(2):
        lines(inbox, f"{n}.csv", f"{n}|A|B|2.0|d", "short")
        jobs.handle_files(
            spark,
            given("files", inbox, sent, tmp_path / "log", "--every", "once", "--archive", done, "--counts", tmp_path / "counts"),
        )
    assert spark.read.text(str(sent)).count() == 2
    assert scratch(spark) == before  # the batches took their tables away


def test_events_job(spark, tmp_path, listeners):
    data, inbox, out = tmp_path / "store" / "bucket", tmp_path / "in", tmp_path / "out"
    lines(data / "data", "a.csv", "1|A|B|2.0|d", "x|A|B|2.0|d", "3|A|B|2.0|d")
    lines(data / "data", "b.csv", "4|A|B|2.0|d")
    lines(data / "other", "c.csv", "5|A|B|2.0|d")
    records = [{"s3": {"bucket": {"name": "bucket"}, "object": {"key": k}}} for k in ("data/a.csv", "data/b.csv", "other/c.csv")]
    inbox.mkdir()
    (inbox / "1").write_text(json.dumps({"Records": records}) + "\n")
    place = f"{tmp_path}/store/{{bucket}}/{{key}}"
    jobs.handle_events(
        spark, given("events", inbox, out, tmp_path / "log", "--every", "once", "--place", place, "--prefix", "data/")
    )
    assert sorted(r.emp_id for r in read_events_table(spark, str(out), "records").collect()) == [1, 4]


def test_messages_job_tries_again(spark, tmp_path, monkeypatch, listeners):
    """Key 1 is not answered the first time, key 2 never; a text that is no record is given up as well."""
    marks = str(tmp_path)

    def service(endpoint):
        def connect():
            def call(key):
                import os

                mark = f"{marks}/asked-{key}"
                if key == 2 or key == 1 and not os.path.exists(mark):
                    open(mark, "w").close()
                    raise OSError("no answer")
                return 200, '{"exists": true}'

            return call

        return connect

    monkeypatch.setattr(jobs, "http_caller", service)
    inbox, out, counts = tmp_path / "in", tmp_path / "out", tmp_path / "counts"
    inbox.mkdir()
    texts = ['{"emp_id":%d,"emp_name":"n","department":"d","salary":1.0,"hire_date":"x"}' % k for k in (0, 1, 2, 3)]
    (inbox / "1").write_text("\n".join([*texts, "broken"]) + "\n")
    before = scratch(spark)
    jobs.handle_messages(
        spark,
        given("messages", inbox, out, tmp_path / "log", "--endpoint", "http://x", "--attempts", 2, "--retry-after", 0.1,
              "--every", "once", "--counts", counts),
    )
    found = sorted((r.status, r.attempts, r.error) for r in read_receipts(spark, str(out)).collect())
    assert found == [
        ("acknowledged", 1, None), ("acknowledged", 1, None), ("acknowledged", 2, None),
        ("given_up", 2, "bad_json"), ("given_up", 2, "no answer"),
    ]
    assert scratch(spark) == before


def test_attempts_need_an_endpoint(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(ValueError):
        jobs.handle_messages(spark, given("messages", tmp_path / "in", "out", "log", "--attempts", 2, "--every", "once"))


def test_passing_tables_go(spark):
    kept = materialize(spark.range(3), "kept")
    before = scratch(spark)
    with passing_tables(spark):
        outer = materialize(spark.range(3), "outer")
        with passing_tables(spark):
            assert materialize(spark.range(4), "inner").count() == 4
            assert len(scratch(spark)) == len(before) + 2
        assert outer.count() == 3
    assert scratch(spark) == before and kept.count() == 3
    with pytest.raises(ZeroDivisionError):
        with passing_tables(spark):
            materialize(spark.range(3), "failed")
            raise ZeroDivisionError
    assert scratch(spark) == before
