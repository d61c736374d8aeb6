from __future__ import annotations

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from samples import SF, sentences
from test_jaccard import expected

from ledgerline.session import scratch_path


def stages(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_contract(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "suffix_array_dedup", "mixing", "byte_bpe",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_on_its_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400")
    known, distinct, cut, mixture, coded = stages(spark, docs)
    assert known.count() == docs.count()  # every text here has a language
    rows = [tuple(r) for r in known.select("doc_id", "text").collect()]
    label, _ = expected([t for _, t in rows])
    least = {min(i for (i, _), other in zip(rows, label) if other == c) for c in label}
    assert {r.doc_id for r in distinct.collect()} == least and distinct.count() == len(least)
    rows = [tuple(r) for r in distinct.select("doc_id", "text").collect()]
    cleaned = {r.doc_id: r.text for r in cut.collect()}
    for i, _, _, spans, kept in brute.repeated_bytes(rows, 50):
        if not spans:
            assert cleaned[i].encode() == kept
        elif i in cleaned:  # a character stays whole if a part of it does
            assert len(kept) <= len(cleaned[i].encode()) <= len(kept) + 6 * len(spans)
    assert {r.doc_id for r in mixture.collect()} <= set(cleaned)
    assert coded.count() == mixture.count() and coded.where("not decodes").count() == 0
    for step in (known, distinct, cut, mixture):
        assert step.columns == docs.columns


def test_edges(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for step in stages(spark, docs)[:-1]:
            assert step.columns == edge_docs.columns
    assert {r.doc_id for r in stages(spark, edge_docs)[0].collect()}.isdisjoint({0, 1, 2, 13})


def test_groups_of_copies_and_repeats(spark):
    """One of many copies stays, shared passages go from later documents, other text stays."""
    passage = sentences(100, 60)
    rows = [(k, sentences(200 + k, 120), "en") for k in range(20)]
    rows += [(50 + k, rows[3][1], "en") for k in range(30)]
    rows += [(100 + k, f"{sentences(300 + k, 40)} {passage} {sentences(400 + k, 40)}", "en") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known, distinct, cut, _, _ = stages(spark, docs)
    assert {r.doc_id for r in distinct.collect()} == {*range(20), *range(100, 105)}
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert all(texts[k] == t for k, t, _ in rows[:20])
    assert [passage in texts[100 + k] for k in range(5)] == [True, False, False, False, False]
    assert all(texts[100 + k].startswith(sentences(300 + k, 40)[:-1]) for k in range(5))


@pytest.mark.parametrize("missing", ["source", "n_chars"])
def test_other_columns_may_be_absent(spark, missing):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60").drop(missing)
    assert stages(spark, docs)[3].columns == docs.columns


def test_junk_and_unlearned_languages_go(spark):
    """Letters without a language, and Spanish texts in a table that teaches none; the others stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang <> 'es' OR doc_id % 2 = 0")
    docs = docs.withColumn("lang", docs.lang.substr(1, 2)).withColumn("lang", F.when(F.col("lang") != "es", F.col("lang")))
    docs = docs.withColumn("_spanish", F.col("lang").isNull())
    junk = docs.limit(30).withColumn("doc_id", F.col("doc_id") + 100_000)
    letters = F.translate(F.repeat(F.sha2(F.col("text"), 256), 10), "0123456789abcdef", "qzxjvkwpbgmfyhuc")
    junk = junk.withColumn("text", letters).withColumn("lang", F.lit(None).cast("string"))
    docs = docs.union(junk)
    kept = corpus_pipeline.identify_language(spark, docs, SF)
    assert kept.columns == docs.columns
    assert kept.where("doc_id >= 100000").count() == 0
    clean = docs.where("doc_id < 100000 AND NOT _spanish")
    assert kept.where("doc_id < 100000 AND NOT _spanish").count() >= 0.995 * clean.count()
    assert kept.where("_spanish").count() <= 0.1 * docs.where("_spanish AND doc_id < 100000").count()


def test_columns_named_like_the_verdict_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    docs = docs.withColumn("score", F.lit(0.1)).withColumn("Lang_Pred", F.lit("x")).withColumn("fit", F.lit(-9.0))
    kept = corpus_pipeline.identify_language(spark, docs, SF)
    assert kept.columns == docs.columns and kept.where("score = 0.1 AND fit = -9.0").count() == docs.count()
