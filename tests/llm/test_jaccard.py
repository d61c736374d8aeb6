from __future__ import annotations

import random

import brute
import corpus_pipeline
import numpy as np
from samples import SF, sentences

from ledgerline.llm import jaccard
from ledgerline.llm.jaccard import _similar, reach, similar_documents
from ledgerline.llm.simhash import near_pairs


def shingles(text):
    words = [w.lower() for w in brute.words(text)]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else frozenset()


def similar(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def expected(texts):
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if similar(a, b)]
    return brute.components(len(sets), links), links


def changed(text, r, share):
    return " ".join("new" + str(r.random()) if r.random() < share else w for w in text.split(" "))


def made():
    """Copies with words changed at random, of similarities on both sides of 0.8."""
    r = random.Random(5)
    texts = [None, "", " ", "one two", "one two", "One  two"]
    for k in range(60):
        base = sentences(1_000 + k, 150)
        texts += [base, changed(base, r, 0.01), changed(base, r, 0.03), changed(base, r, 0.05)]
    return texts + [changed(texts[-4], r, 0.01) for _ in range(150)]


def grouping(labels):
    seen = {}
    return [seen.setdefault(x, len(seen)) for x in labels]


def test_groups_are_those_of_brute_force(spark):
    for texts in (made(), [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]):
        label, links = expected(texts)
        assert len(links) > 10
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
        found = {r.id: r.group for r in similar_documents(docs).collect()}
        assert grouping(found[k] for k in range(len(texts))) == grouping(label)


def test_stage_drops_what_is_similar_and_no_more(spark):
    texts = made()
    label, _ = expected(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()}
    assert kept == {label.index(c) for c in set(label)}


def test_fingerprints_find_what_is_similar(spark, monkeypatch):
    """The search by fingerprint is no ornament: without the keys of minhashes it joins nine of ten similar pairs."""
    none = np.zeros(0, np.uint64)
    monkeypatch.setattr(jaccard, "_candidates", lambda key, node, fp: (none, none))
    for texts in (made(), [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]):
        label, links = expected(texts)
        links = [(a, b) for a, b in links if shingles(texts[a]) != shingles(texts[b])]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
        found = {r.id: r.group for r in similar_documents(docs).collect()}
        assert len(links) > 10 and sum(found[a] == found[b] for a, b in links) >= 0.9 * len(links)
        assert all(label[a] == label[b] for a in found for b in found if found[a] == found[b])


def test_fingerprints_meet_over_blocks(spark, monkeypatch):
    """Small blocks: each pair of them meets, so the groups are the same."""
    none = np.zeros(0, np.uint64)
    monkeypatch.setattr(jaccard, "_candidates", lambda key, node, fp: (none, none))
    docs = spark.createDataFrame(list(enumerate(made())), "doc_id long, text string").repartition(3)
    whole = {r.id: r.group for r in similar_documents(docs).collect()}
    monkeypatch.setattr(jaccard, "BLOCK_NODES", 20)
    assert {r.id: r.group for r in similar_documents(docs).collect()} == whole


def test_near_pairs_are_all_pairs():
    r = np.random.default_rng(3)
    own = r.integers(0, 2**63, 700).astype(np.uint64) * np.uint64(2)
    own[:200] = own[0]  # many of one kind
    asking = np.concatenate([own[r.integers(0, 700, 500)], own[:300]])
    for _ in range(9):
        asking ^= np.uint64(1) << r.integers(0, 64, 800).astype(np.uint64)
    for distance in (4, 9, 14):
        found = {(a, b) for blocks in near_pairs(own, asking, distance) for a, b in zip(*(x.tolist() for x in blocks))}
        apart = np.bitwise_count(asking[:, None] ^ own)
        assert found == set(zip(*(x.tolist() for x in np.nonzero(apart <= distance)))) and found
    assert not list(near_pairs(own[:0], asking, 4))


def test_reach():
    r = np.random.default_rng(1)
    links = np.triu(r.random((200, 200)) < 0.006, 1)
    links |= links.T
    label = brute.components(200, list(zip(*np.nonzero(links))))
    assert grouping(reach(200, lambda k, others: links[k, others]).tolist()) == grouping(label)


def test_similarity_at_the_bound():
    sets = [np.arange(9, dtype=np.uint64), np.arange(1, 10, dtype=np.uint64), np.arange(2, 11, dtype=np.uint64)]
    assert _similar(sets, 0.8).tolist() == [0, 0, 0]  # 8 of 10, twice
    assert _similar([sets[0], sets[2]], 0.8).tolist() == [0, 1]
