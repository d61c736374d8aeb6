from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
from samples import SF

from ledgerline.llm.language import FEATURES, SMOOTHING, held_out, identify, language_id, ngrams, train
from ledgerline.llm.repeats import text_bytes
import pyarrow as pa


def plain_text(text: str) -> str:
    """What the n-grams see: letters in lower case, each run of other characters one space."""
    out = [" "]
    for c in text:
        if c.isalpha():
            out.append(c.lower() if len(c.lower()) == 1 else c)
        elif len(out) > 1 and out[-1] != " ":
            out.append(" ")
    return "".join(out)


def test_ngrams_are_those_of_the_plain_text():
    texts = ["Ab, çÉ!", "", "1 2", "  a  b ", "日本 x", "ab"]
    data, offsets = text_bytes(pa.array(texts))
    found, letters = ngrams(data, offsets)
    assert letters.tolist() == [any(c.isalpha() for c in t) for t in texts]
    seen: dict[str, int] = {}
    for order, (feature, edges) in zip((1, 2, 3), found):
        for k, text in enumerate(texts):
            plain = plain_text(text)
            grams = [plain[i : i + order] for i in range(len(plain) - order + 1)]
            mine = feature[edges[k] : edges[k + 1]].tolist()
            assert len(mine) == len(grams)
            for gram, f in zip(grams, mine):
                assert seen.setdefault(gram, f) == f
    assert len(set(seen.values())) == len(seen)


def test_scores_are_the_posterior(spark):
    rows = [("ab ab", "x"), ("ba", "x"), ("cc a", "y"), (None, "y"), ("zz", None)]
    model = train(spark.createDataFrame(rows, "text string, lang string"), "text", "lang")
    assert model.languages == ["x", "y"]
    assert np.allclose(np.exp(model.priors), [2 / 3, 1 / 3])
    counts = {lang: Counter() for lang in "xy"}
    for text, lang in rows[:3]:
        data, offsets = text_bytes(pa.array([text]))
        counts[lang].update(f for feature, _ in ngrams(data, offsets)[0] for f in feature.tolist())
    asked = spark.createDataFrame([("abc",), ("",), (None,), ("12",)], "text string")
    got = [(r.lang_pred, r.score) for r in identify(asked.coalesce(1), model).collect()]
    data, offsets = text_bytes(pa.array(["abc"]))
    features = [f for feature, _ in ngrams(data, offsets)[0] for f in feature.tolist()]
    total = {}
    for lang, prior in (("x", 2 / 3), ("y", 1 / 3)):
        size = sum(counts[lang].values()) + SMOOTHING * FEATURES
        total[lang] = math.log(prior) + sum(math.log((counts[lang][f] + SMOOTHING) / size) for f in features)
    odds = math.exp(total["y"] - total["x"])
    assert got[0][0] == ("x" if odds <= 1 else "y")
    assert math.isclose(got[0][1], max(1, odds) / (1 + odds), rel_tol=1e-9)
    assert got[1:] == [("und", 0.0)] * 3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language_id(docs).where("held_out").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_rows_teach_nothing(spark):
    docs = [(k, "abc", "x") for k in range(30) if zlib.crc32(str(k).encode()) % 3 == 1]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in language_id(df).collect()} == {("und", 0.0)}
    assert df.select(held_out()).distinct().count() == 1


def test_edges(edge_docs, edge_rows, no_docs):
    out = language_id(edge_docs)
    assert out.count() == len(edge_rows)
    rows = {r.doc_id: r for r in out.collect()}
    assert [rows[k].lang_pred for k in (0, 1, 2, 13)] == ["und"] * 4
    assert not any(r.held_out for r in out.collect() if r.doc_id is None)
    assert language_id(no_docs).count() == 0


def test_texts_in_no_learned_language_do_not_fit(spark):
    """One language is not learned, and junk is none: both fall short, clean texts of the others do not."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    junk = spark.range(20).selectExpr("10000 + id", "translate(repeat(sha2(cast(id as string), 256), 8), '0123456789abcdef', 'qzxjvkwpbgmfyhuc')", "'junk'")
    model = train(docs.where(~held_out() & (docs.lang != "es")), "text", "lang")
    assert "es" not in model.languages
    rows = identify(docs.union(junk.toDF(*docs.columns)), model, fit_name="fit").collect()
    assert all(r.fit <= 0 for r in rows)
    gone = [r for r in rows if r.fit < -1.0]
    learned = [r for r in rows if r.lang in model.languages]
    assert sum(r.lang in model.languages for r in gone) <= 0.002 * len(learned)
    assert sum(r.lang == "es" for r in gone) >= 0.95 * sum(r.lang == "es" for r in rows)
    assert sum(r.lang == "junk" for r in gone) == 20
    # The probability among the learned languages does not tell them.
    assert np.mean([r.score > 0.99 for r in gone]) > 0.9
