from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from samples import CLASHING, SF, sentences  # noqa: E402


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text): null, empty and long texts, copies, ties, shared passages, odd characters."""
    shared, long_text = sentences(1, 60), sentences(2, 30_000)
    texts = [
        None,
        "",
        " \t\n\x0b ",
        "a",
        "Ünïcode — 日本語 text \U0001f600 \U0001f600 end",
        "a " * 300,
        "b" * 500,
        shared,
        f"{sentences(3, 50)} {shared} {sentences(4, 20)}",
        f"{sentences(5, 10)}\n\n{shared}\t{sentences(6, 40)}",
        shared[7:],
        long_text,
        f"{sentences(8, 30)} {long_text[5_000:90_000]}",
        "!!! 123 ???",
        f"x{long_text[200:700]}é{long_text[200:700]}",
        " leading and trailing ",
    ]
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(7, shared), (40, sentences(9, 80)), (40, sentences(10, 80)), (None, shared), (None, "no id at all, twice")]
    rows += [(None, "no id at all, twice"), (41, sentences(11, 70)), (42, sentences(11, 70)), (42, sentences(11, 70))]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The edge rows as documents, with null columns and clashing names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, "
    schema += ", ".join(f"`{c}` string" for c in CLASHING)
    langs = ["en", None, "fr"]
    rows = [(i, t, langs[k % 3], None, None, *["odd"] * len(CLASHING)) for k, (i, t) in enumerate(edge_rows)]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def sf_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return [tuple(r) for r in docs.where("doc_id < 300").collect()]


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
