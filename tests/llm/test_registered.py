"""The registered queries against their SQL, and those without SQL for shape."""

from __future__ import annotations

import pytest
from compare import connect, mismatch

import __spark_entry__
from ledgerline.llm.oracles import ORACLES
from ledgerline.llm.queries import QUERIES

COLUMNS = {
    "op3_vp_trees": ["query_id", "rank", "vec_id", "score"],
    "op4_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op5_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op6_mixing": ["doc_id", "n_tokens", "p_clean", "p_poor", "p_toxic", "rate"],
    "op8_simhash": ["doc_id", "fingerprint", "component_id"],
    "op9_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
}


def test_names():
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(QUERIES) == set(ORACLES) | set(COLUMNS)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_against_sql(spark, sf, name):
    sf_dir = f"/root/testdata/{sf}"
    assert mismatch(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_shape(spark, name):
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert df.columns == COLUMNS[name]
    assert df.count() == (200 if "vec" not in " ".join(df.columns) else df.select("query_id").distinct().count() * 20)
