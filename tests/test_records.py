"""Lines to records: every edge line, both rule sets, all error policies."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from ledgerline.functions.text import clean, parse_double, split_fields, split_lines, to_line
from ledgerline.operators.records import parse_files, parse_lines, parse_records, parse_rejects
from ledgerline.schemas import EMPLOYEE, compat_schema
from ledgerline.sources.delimited import read_lines, write_lines

DAY = datetime.date(2020, 1, 1)
TWO = Decimal("2.00")
SCHEMA = T.StructType([T.StructField("emp_id", T.LongType()), *EMPLOYEE.fields[1:]])

# line, reason and record by default, reason and record in compat
EDGES = [
    ("1|A|B|2.0|2020-01-01", None, (1, "A", "B", TWO, DAY), None, (1, "A", "B", 2.0, "2020-01-01")),
    ("1|A|B", "short", None, "short", None),
    ("1|A|B|2.0|", None, (1, "A", "B", TWO, None), "short", None),
    ("1|A||2.0|2020-01-01", None, (1, "A", None, TWO, DAY), None, (1, "A", "", 2.0, "2020-01-01")),
    ("1|A|B|2.0|2020-01-01|extra", None, (1, "A", "B", TWO, DAY), None, (1, "A", "B", 2.0, "2020-01-01")),
    ("\t 1 | A\t|B |\t2.0| 2020-01-01 \t", None, (1, "A", "B", TWO, DAY), None, (1, "A", "B", 2.0, "2020-01-01")),
    ("x|A|B|2.0|2020-01-01", "bad_emp_id", None, "bad_emp_id", None),
    ("1|A|B||2020-01-01", "bad_salary", None, "bad_salary", None),
    ("2147483648|A|B|2.0|2020-01-01", None, (2147483648, "A", "B", TWO, DAY), "bad_emp_id", None),
    ('1|"a|b"|B|2.0|d', "bad_salary", None, "bad_salary", None),
    ("1|A|B|2.0|d", "bad_hire_date", None, None, (1, "A", "B", 2.0, "d")),
    ("+7|A|B|-1e2|2020-01-01", None, (7, "A", "B", Decimal("-100.00"), DAY), None, (7, "A", "B", -100.0, "2020-01-01")),
    ("1.0|A|B|2.0|2020-01-01", "bad_emp_id", None, "bad_emp_id", None),
    ("|||||", "bad_emp_id", None, "short", None),
    ("1|A|B|1d|2020-01-01", "bad_salary", None, None, (1, "A", "B", 1.0, "2020-01-01")),
    ("1|A|B|inf|2020-01-01", "bad_salary", None, "bad_salary", None),
    ("1|A|B|2.0|2020", "bad_hire_date", None, None, (1, "A", "B", 2.0, "2020")),
    ("1|A|B|2.0|2020-1-01", "bad_hire_date", None, None, (1, "A", "B", 2.0, "2020-1-01")),
    ("1|A|B|2.0|2020-01-01Tjunk", "bad_hire_date", None, None, (1, "A", "B", 2.0, "2020-01-01Tjunk")),
    ("1|A|B|2.0|2020-01-01 zz", "bad_hire_date", None, None, (1, "A", "B", 2.0, "2020-01-01 zz")),
    ("1|A|B|2.0|2020-02-30", "bad_hire_date", None, None, (1, "A", "B", 2.0, "2020-02-30")),
    ("1|A|B|1.239|2020-01-01", "bad_salary", None, None, (1, "A", "B", 1.239, "2020-01-01")),
    ("1|A|B|1e-3|2020-01-01", "bad_salary", None, None, (1, "A", "B", 0.001, "2020-01-01")),
    ("1|A|B|2.00000|2020-01-01", None, (1, "A", "B", TWO, DAY), None, (1, "A", "B", 2.0, "2020-01-01")),
    ("1|é|ß|2.0|2020-01-01", None, (1, "é", "ß", TWO, DAY), None, (1, "é", "ß", 2.0, "2020-01-01")),
]


def as_lines(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "line string")


@pytest.mark.parametrize("compat", [False, True])
def test_edge_lines(spark, compat):
    names = SCHEMA.names
    rows = parse_lines(as_lines(spark, *[e[0] for e in EDGES]), SCHEMA, compat).collect()
    found = {r["line"]: (r["reject_reason"], tuple(r[n] for n in names)) for r in rows}
    assert len(found) == len(EDGES)
    for edge in EDGES:
        reason, record = edge[3:5] if compat else edge[1:3]
        assert found[edge[0]][0] == reason, edge[0]
        if reason is None:
            assert found[edge[0]][1] == record, edge[0]


def test_blank_lines_are_neither_records_nor_rejects(spark):
    lines = as_lines(spark, "", "   ", "\t \x01 ", "1|A|B|2.0|2020-01-01")
    assert parse_records(lines, SCHEMA).count() == 1
    assert parse_rejects(lines, SCHEMA).count() == 0


def test_compat_types():
    kinds = [f.dataType.simpleString() for f in compat_schema(SCHEMA)]
    assert kinds == ["int", "string", "string", "double", "string"]


def test_number_words(spark):
    words = ["NaN", "-NaN", "Infinity", "-Infinity", "nan", "inf", "-inf", "INFINITY", "1f", "0x1p3", "1e400", "", "1,5"]
    df = spark.createDataFrame([(w,) for w in words], "w string").select("w", parse_double(F.col("w")).alias("v"))
    found = {r.w: r.v for r in df.collect()}
    assert found["Infinity"] == float("inf") and found["-Infinity"] == float("-inf")
    assert found["NaN"] != found["NaN"] and found["-NaN"] != found["-NaN"]
    assert found["1f"] == 1.0 and found["0x1p3"] == 8.0 and found["1e400"] == float("inf")
    assert [found[w] for w in ("nan", "inf", "-inf", "INFINITY", "", "1,5")] == [None] * 6


def test_text_functions(spark):
    df = spark.createDataFrame([("\x00\t a b \r", "a||b||", "x\r\ny\rz\n\nw", None)], "t string, p string, l string, n string")
    row = df.select(
        clean(F.col("t")).alias("t"),
        split_fields(F.col("p")).alias("p"),
        split_fields(F.col("p"), compat=True).alias("c"),
        split_lines(F.col("l")).alias("l"),
        to_line("n", "p", "n").alias("j"),
    ).first()
    assert tuple(row) == ("a b", ["a", "", "b", "", ""], ["a", "", "b"], ["x", "y", "z", "", "w"], "|a||b|||")


def test_on_error_fail(spark):
    good = as_lines(spark, "1|A|B|2.0|2020-01-01", "short|line")
    assert parse_records(good, SCHEMA, on_error="fail").count() == 1
    with pytest.raises(PySparkException, match="bad_emp_id"):
        parse_records(as_lines(spark, "x|A|B|2.0|2020-01-01"), SCHEMA, on_error="fail").collect()


def test_on_error_unknown(spark):
    with pytest.raises(ValueError):
        parse_records(as_lines(spark, ""), SCHEMA, on_error="ignore")


def test_stop_file_needs_position(spark):
    with pytest.raises(ValueError):
        parse_records(as_lines(spark, ""), SCHEMA, on_error="stop_file")


def line(i, salary="2.0"):
    return f"{i}|A|B|{salary}|2020-01-01"


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_stop_file_over_split_files(spark, conf, tmp_path, broadcast_bytes):
    """Files are read in many pieces; one holds most of the lines; lines after a bad one are lost."""
    conf(spark__sql__files__maxPartitionBytes="2000", spark__sql__files__openCostInBytes="10")
    bad = {"a": [1700, 1900], "b": [], "c": [0], "d": [299]}
    sizes = {"a": 3000, "b": 200, "c": 100, "d": 300}
    for name, size in sizes.items():
        body = [line(i, "x" if i in bad[name] else "2.0") for i in range(size)]
        body[5:5] = ["", "too|short", " \t"]
        (tmp_path / f"{name}.csv").write_text("\n".join(["header", *body]) + "\n")
    lines = read_lines(spark, str(tmp_path), position=True)
    assert lines.rdd.getNumPartitions() > 8
    kept = parse_records(lines, SCHEMA, "stop_file", broadcast_bytes=broadcast_bytes)
    ids = sorted(r.emp_id for r in kept.collect())
    assert ids == sorted([*range(1700), *range(200), *range(299)])


def test_reading_positions_leaves_the_session_alone(spark, tmp_path):
    (tmp_path / "f.csv").write_text("header\n" + line(1) + "\n")
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    assert read_lines(spark, str(tmp_path), position=True).count() == 1
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) == before


def test_rejects_of_a_stopped_file(spark):
    lines = [("a", 0, 1, line(1)), ("a", 0, 2, "short"), ("a", 0, 3, "x|A|B|2.0|2020-01-01"), ("a", 0, 4, "y"), ("b", 0, 1, "y")]
    lines = spark.createDataFrame(lines, "file string, block long, seq long, line string")
    good, bad = parse_files(lines, SCHEMA, "stop_file")
    assert [r.emp_id for r in good.collect()] == [1]
    assert sorted((r.file, r.seq, r.reject_reason) for r in bad.collect()) == [
        ("a", 2, "short"), ("a", 3, "bad_emp_id"), ("b", 1, "short"),
    ]
    good, bad = parse_files(lines, SCHEMA)
    assert good.count() == 1 and bad.count() == 4


def test_nested_files_are_read(spark, tmp_path):
    (tmp_path / "sub" / "subsub").mkdir(parents=True)
    for folder, i in ((tmp_path, 1), (tmp_path / "sub", 2), (tmp_path / "sub" / "subsub", 3)):
        (folder / "f.csv").write_text("header\n" + line(i) + "\n")
    assert sorted(r.emp_id for r in parse_records(read_lines(spark, str(tmp_path)), SCHEMA).collect()) == [1, 2, 3]


def test_reader_keeps_lines_as_they_are(spark, conf, tmp_path):
    conf(spark__sql__files__maxPartitionBytes="16", spark__sql__files__openCostInBytes="1")
    lines = ['a,b;"c', '"', "\\", "'", "  pad  ", "#c", "\x00nul", "\x01a", "\uffff", "\ufffe", "é\u2028ü", "x" * 2000]
    (tmp_path / "f.csv").write_bytes(("header\n" + "\n".join(lines) + "\n\n \t\n").encode())
    (tmp_path / "other.txt").write_text("header\nnot read\n")
    assert sorted(r.line for r in read_lines(spark, str(tmp_path)).collect()) == sorted(lines)


def test_reader_line_ends(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b"header\r\n1\r2\n3\r\n4")
    assert sorted(r.line for r in read_lines(spark, str(tmp_path)).collect()) == ["1", "2", "3", "4"]


def test_header_only_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("emp_id|emp_name\n")
    (tmp_path / "b.csv").write_text("")
    assert read_lines(spark, str(tmp_path)).count() == 0


def test_lines_written_and_read(spark, tmp_path):
    texts = ["", " a ", '"q"', "b|c", "\\"]
    write_lines(as_lines(spark, *texts), str(tmp_path / "out"), "the|header")
    assert sorted(r.line for r in read_lines(spark, str(tmp_path / "out")).collect()) == sorted(texts[1:])
    assert "the|header" in {r.line for r in read_lines(spark, str(tmp_path / "out"), header=False).collect()}


def test_parser_stays_in_the_jvm(spark, plan_of, tmp_path):
    (tmp_path / "f.csv").write_text("header\n" + line(1) + "\n")
    plan = plan_of(parse_records(read_lines(spark, str(tmp_path)), SCHEMA, compat=True))
    assert "Python" not in plan and "Exchange" not in plan and plan.count("FileScan") == 1
