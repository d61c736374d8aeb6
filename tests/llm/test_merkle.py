"""The Merkle manifest against one that is built by hand."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F
from samples import CLASHING

from ledgerline.llm.merkle import FIELDS, check_documents, manifest, prove



def tampered():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 0


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, more: int = 0) -> str:
    n_chars = None if row["n_chars"] is None else row["n_chars"] + more
    values = (row["doc_id"], row["source"], row["lang"], n_chars, row["text"])
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(leaves, arity):
    grown = [leaves]
    while len(grown[-1]) > 1:
        below = grown[-1]
        grown.append([digest("".join(below[i : i + arity])) for i in range(0, len(below), arity)])
    return grown


def expected(rows, arity: int = 2):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for lang in langs:
        groups[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    trees = [levels([leaf_of(r) for r in groups[g]], arity) for g in langs]
    over = levels([t[-1][0] for t in trees], arity)
    found = []
    for g, lang in enumerate(langs):
        for k, row in enumerate(groups[lang]):
            hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            folded, siblings = leaf_of(row, int(hit)), []
            for tree, place in ((trees[g], k), (over, g)):
                for nodes in tree[:-1]:
                    first, at = place - place % arity, place % arity
                    run = nodes[first : first + arity]
                    siblings += run[:at] + run[at + 1 :]
                    folded = digest("".join([*run[:at], folded, *run[at + 1 :]]))
                    place //= arity
            root = over[-1][0]
            found.append(
                (row["doc_id"], leaf_of(row), trees[g][-1][0], root, digest("".join(siblings)), folded, folded == root)
            )
    return sorted(found, key=str)


def rows_of(docs):
    return [r.asDict() for r in docs.select(*FIELDS).collect()]


@pytest.mark.parametrize("arity", [2, 3])
def test_edges(spark, edge_docs, arity):
    docs = edge_docs.withColumn("n_chars", F.when(F.col("text") != "a", F.length("text").cast("long")))
    docs = docs.union(docs.withColumn("n_chars", F.lit(2**63 - 1)))
    found = check_documents(docs, tampered(), arity=arity)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(rows_of(docs), arity)


@pytest.mark.parametrize("n, block", [(1, 4), (2, 4), (4, 4), (5, 4), (16, 4), (17, 4), (70, 4), (1025, 1024), (300, 1)])
def test_sizes(spark, monkeypatch, n, block):
    """One group alone, up to and beyond the blocks of some stored levels."""
    monkeypatch.setattr("ledgerline.llm.merkle.BLOCK", block)
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"),
        F.col("id").alias("n_chars"), F.col("id").cast("string").alias("text"),
    )
    found = check_documents(docs, tampered())
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(rows_of(docs))


@pytest.mark.parametrize("block, limit", [(1024, 1 << 25), (4, 0)])
def test_many_groups(spark, monkeypatch, block, limit):
    monkeypatch.setattr("ledgerline.llm.merkle.BLOCK", block)
    monkeypatch.setattr("ledgerline.llm.merkle.BROADCAST_BYTES", limit)
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("source"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("é."), (F.col("id") % 150).cast("string"))).alias("lang"),
        F.lit(None).cast("long").alias("n_chars"), F.lit("").alias("text"),
    )
    rows = [tuple(r) for r in check_documents(docs, tampered()).collect()]
    assert sorted(rows, key=str) == expected(rows_of(docs))
    assert all(r[-1] for r in rows)  # a null n_chars cannot be tampered with


def test_empty(spark, no_docs):
    found = check_documents(no_docs, tampered())
    assert found.count() == 0
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_setting_is_put_back(spark, edge_docs, conf):
    conf(**{"spark__sql__cteRecursionRowLimit": "5"})
    tree = manifest(edge_docs.drop(*CLASHING))
    assert prove(tree).count() == edge_docs.count()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "5"
    # Links lead from every node but the root to one parent.
    nodes = tree.nodes.collect()
    assert len({(r.node, r.spot) for r in nodes}) == len(nodes)
    assert {r.parent for r in nodes} - {r.node for r in nodes} == {tree.root_node}
