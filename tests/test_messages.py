from __future__ import annotations

import json

from pyspark.sql import functions as F, types as T

from ledgerline.operators.messages import decode_messages, message_rejects, parse_messages, to_messages
from ledgerline.schemas import EMPLOYEE

GOOD = '{"emp_id":1,"emp_name":"a","department":"d","salary":2.5,"hire_date":"2020-01-01"}'
BODIES = {
    GOOD: (None, None, None),
    "nope": ("bad_json", "bad_json", "bad_json"),
    '{"emp_id":1,"extra":2}': (None, "unknown_field", "unknown_field"),
    '{"emp_id":1}': (None, None, None),
    '{"emp_id":null,"salary":null}': (None, None, None),
    '{"emp_id":"many"}': ("bad_json", "bad_json", "bad_json"),
    '{"emp_id":1.5}': ("bad_json", "bad_json", "bad_json"),
    '[{"emp_id":1}]': ("bad_json", "bad_json", "bad_json"),
    "null": ("bad_json", "bad_json", "bad_json"),
    "": ("bad_json", "bad_json", "bad_json"),
    '{"emp_id":1': ("bad_json", "bad_json", "bad_json"),
    "{}": (None, None, None),
}


def as_messages(spark, *bodies):
    return spark.createDataFrame([(b,) for b in bodies], "value string")


def test_reasons(spark):
    messages = as_messages(spark, *BODIES)
    for i, options in enumerate([{}, {"strict_fields": True}, {"compat": True}]):
        found = {r.value: r.reject_reason for r in decode_messages(messages, EMPLOYEE, **options).collect()}
        assert found == {body: reasons[i] for body, reasons in BODIES.items()}


def test_missing_numbers(spark):
    messages = as_messages(spark, "{}", '{"emp_id":null,"salary":null}')
    assert {tuple(r) for r in parse_messages(messages, EMPLOYEE).collect()} == {(None,) * 5}
    assert {tuple(r) for r in parse_messages(messages, EMPLOYEE, compat=True).collect()} == {(0, None, None, 0.0, None)}


def test_compat_types(spark):
    row = parse_messages(as_messages(spark, GOOD), EMPLOYEE, compat=True).first()
    assert tuple(row) == (1, "a", "d", 2.5, "2020-01-01")


def test_message_text(spark):
    rows = spark.createDataFrame([(1, 'a"|\n', None, None, None)], EMPLOYEE)
    body = to_messages(rows).first()["value"]
    assert list(json.loads(body)) == EMPLOYEE.names and "\n" not in body
    assert json.loads(body)["emp_name"] == 'a"|\n' and json.loads(body)["salary"] is None


def test_duplicates_and_carried_columns_stay(spark):
    messages = as_messages(spark, GOOD, GOOD, "nope").withColumn("origin", F.lit("q"))
    assert [tuple(r) for r in parse_messages(messages, EMPLOYEE).select("origin", "emp_id").collect()] == [("q", 1)] * 2
    assert message_rejects(messages, EMPLOYEE).first().asDict() == {
        "value": "nope", "reject_reason": "bad_json", "origin": "q",
    }


def test_long_keys(spark):
    schema = T.StructType([T.StructField("emp_id", T.LongType())])
    messages = as_messages(spark, '{"emp_id":3000000000}')
    assert parse_messages(messages, schema).first()["emp_id"] == 3_000_000_000
    assert message_rejects(messages, schema, compat=True).count() == 1
