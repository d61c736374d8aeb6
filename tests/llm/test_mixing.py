from __future__ import annotations

import random

import numpy as np
import pytest
from samples import SF

from ledgerline.llm.mixing import (
    DOMAINS,
    WEIGHTS,
    domain_targets,
    fit_rates,
    label_domain,
    learn,
    memberships,
    mixed,
    mixing_rates,
    rates_after,
)


def table_of(spark, tokens, p):
    rows = [(int(t), q.tolist()) for t, q in zip(tokens, p)]
    return spark.createDataFrame(rows, "n_tokens long, posteriors array<double>").repartition(3)


def test_rates_meet_the_targets(spark):
    r = np.random.default_rng(1)
    p = r.dirichlet([0.3, 0.3, 0.3], 400)
    tokens = r.integers(0, 500, 400)
    now = tokens @ p
    for targets in (now, now * [1.0, 2.0, 0.5], now * [0.2, 1.0, 3.0]):
        rate = rates_after(p, fit_rates(table_of(spark, tokens, p), targets))
        assert (rate >= 0).all()
        assert np.abs((rate * tokens) @ p - targets).max() <= 1e-5 * targets.sum()


def test_targets_out_of_reach_come_nearer(spark):
    p = np.array([[0.8, 0.2], [0.6, 0.4], [0.9, 0.1]])
    tokens = np.array([100, 100, 100])
    targets = np.array([230.0, 0.0])
    rate = rates_after(p, fit_rates(table_of(spark, tokens, p), targets))
    off = np.linalg.norm((rate * tokens) @ p - targets)
    assert (rate >= 0).all() and off < np.linalg.norm(tokens @ p - targets)


def test_no_tokens(spark):
    assert fit_rates(table_of(spark, np.zeros(2), np.full((2, 2), 0.5)), np.zeros(2)) == []


def test_held_out_labels_are_predicted(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    classifier = learn(docs, labels.where("doc_id % 2 = 0"), label_domain(), 3)
    found = memberships(docs, classifier)
    rows = found.join(labels.where("doc_id % 2 = 1").withColumn("domain", label_domain()), found.id == labels.doc_id)
    rows = rows.collect()
    right = [int(np.argmax(r.posteriors)) == r.domain for r in rows]
    assert len(rows) > 100 and np.mean(right) > 0.9
    assert all(abs(sum(r.posteriors) - 1) < 1e-9 for r in rows)


def test_mixture(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = mixing_rates(docs, labels).collect()
    tokens, p, rate = (np.array([r[c] for r in rows]) for c in ("n_tokens", "posteriors", "rate"))
    before, after = tokens @ p, (rate * tokens) @ p
    targets = domain_targets(before, WEIGHTS)
    assert np.linalg.norm(after - targets) < 0.1 * np.linalg.norm(before - targets)
    kept = mixed(docs, labels)
    assert kept.columns == docs.columns
    by_domain = labels.withColumn("domain", label_domain())
    counts = {r["domain"]: r for r in by_domain.join(kept, "doc_id").groupBy("domain").agg({"doc_id": "approx_count_distinct"}).collect()}
    clean = by_domain.where("domain = 0").select("doc_id").distinct()
    assert kept.join(clean, "doc_id").select("doc_id").distinct().count() >= 0.98 * clean.join(docs, "doc_id").count()
    toxic = by_domain.where("domain = 2").join(docs, "doc_id").count()
    assert 2 not in counts or kept.join(by_domain.where("domain = 2"), "doc_id").count() <= 0.2 * toxic  # learned from a few hundred labels


def test_a_handful_of_toxic_documents_goes(spark):
    """Their tokens are fewer than the target share, so that the fit raises their rates above one."""
    r = random.Random(3)
    words = {0: ["alpha", "bread", "cloud"], 1: ["dummy", "empty", "fuzzy"], 2: ["grime", "havoc", "idiot"]}
    domains = [0] * 3_000 + [1] * 150 + [2] * 6
    texts = [" ".join(r.choice(words[d]) for _ in range(40)) for d in domains]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    flags = [(k, int(d == 0), int(d == 2)) for k, d in enumerate(domains)]
    labels = spark.createDataFrame(flags, "doc_id long, quality int, toxic int")
    rates = {x.id: x.rate for x in mixing_rates(docs, labels).collect()}
    assert np.mean([rates[k] for k, d in enumerate(domains) if d == 2]) > 1
    kept = [domains[x.doc_id] for x in mixed(docs, labels).collect()]
    assert 2 not in kept and 0 in kept and 1 in kept


@pytest.mark.parametrize("labelled", [True, False])
def test_edges(spark, edge_docs, edge_rows, no_docs, labelled):
    rows = [(8, 1, 0), (9, 0, 0), (14, 0, 1), (14, 1, 1), (None, 1, 0), (12, None, None), (99, 1, 1)] if labelled else []
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    found = mixing_rates(edge_docs, labels).collect()
    assert len(found) == len(edge_rows)
    assert all(r.rate >= 0 and len(r.posteriors) == len(DOMAINS) for r in found)
    assert {r.n_tokens for r in found if r.id in (0, 1, 2)} == {0}
    assert mixed(edge_docs, labels).columns == edge_docs.columns
    assert mixed(no_docs, labels).count() == 0


def test_rows_of_one_id_teach_once(spark):
    """Whatever order the rows come in, the classifier is the same."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    twice = docs.union(docs.withColumn("text", docs.text.substr(1, 300))).union(docs)
    one = learn(twice, labels, label_domain(), 3, sample=200)
    other = learn(twice.repartition(7, "text"), labels, label_domain(), 3, sample=200)
    assert np.array_equal(one.codes, other.codes) and np.allclose(one.words, other.words) and np.allclose(one.bytes, other.bytes)
