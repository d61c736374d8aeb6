from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from dataclasses import replace

from ledgerline.llm import repeats
from ledgerline.llm.suffix_array import byte_task, clean_repeated_bytes, drop_repeated_bytes, radix_groups
from ledgerline.llm.suffix_trees import deep_nodes, drop_repeated_words, prefix_groups


def by_bytes(df):
    return sorted(
        ((r[0], r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in df.collect()), key=repr
    )


def by_words(df):
    return sorted(((r[0], r.n_words, r.n_removed, r.kept.encode()) for r in df.collect()), key=repr)


@pytest.fixture(params=["plain", "hot", "tiny chunks"])
def layout(request, monkeypatch):
    """Few runs already make an anchor hot; many chunks share them."""
    if request.param == "hot":
        monkeypatch.setattr(repeats.Task, "__init__", _hot(repeats.Task.__init__))
    if request.param == "tiny chunks":
        monkeypatch.setattr(repeats.packer, "__defaults__", (2_000,))


def _hot(make):
    def init(self, *args, **kwargs):
        make(self, *args, **{**kwargs, "hot": 1})

    return init


def test_bytes_on_edges(edge_docs, edge_rows, layout):
    assert by_bytes(drop_repeated_bytes(edge_docs)) == sorted(brute.repeated_bytes(edge_rows, 50), key=repr)


def test_words_on_edges(edge_docs, edge_rows, layout):
    assert by_words(drop_repeated_words(edge_docs)) == sorted(brute.repeated_words(edge_rows, 35), key=repr)


def test_small_alphabet(spark):
    """Periodic texts, where many windows are equal and anchors tie."""
    r = random.Random(5)
    rows = [(k % 25, "".join(r.choice("ab ") for _ in range(r.randint(0, 400)))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert by_bytes(drop_repeated_bytes(docs, length=12, gram=8)) == sorted(brute.repeated_bytes(rows, 12), key=repr)
    assert by_words(drop_repeated_words(docs, length=5, gram=2)) == sorted(brute.repeated_words(rows, 5), key=repr)


def test_documents(spark, sf_rows):
    docs = spark.createDataFrame(sf_rows, "doc_id long, text string")
    assert by_bytes(drop_repeated_bytes(docs)) == sorted(brute.repeated_bytes(sf_rows, 50), key=repr)
    assert by_words(drop_repeated_words(docs)) == sorted(brute.repeated_words(sf_rows, 35), key=repr)


def test_empty(no_docs):
    assert drop_repeated_bytes(no_docs).count() == 0
    assert drop_repeated_words(no_docs).count() == 0
    assert clean_repeated_bytes(no_docs).count() == 0


def test_clean_keeps_columns_and_characters(edge_docs, edge_rows):
    out = clean_repeated_bytes(edge_docs)
    assert out.columns == edge_docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    expected = []
    for (i, text), (_, _, _, spans, _) in zip(edge_rows, brute.repeated_bytes(edge_rows, 50)):
        gone = {b for lo, hi in spans for b in range(lo, hi)}
        at, left = 0, []
        for char in text or "":
            size = len(char.encode())
            if not all(b in gone for b in range(at, at + size)):
                left.append(char)
            at += size
        if left or not text:
            expected.append((i, None if text is None else "".join(left)))
    assert got == sorted(expected, key=repr)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect())


def test_radix_groups_and_trees_agree_with_sorting():
    r = np.random.default_rng(3)
    data = r.integers(97, 99, 600).astype(np.uint8)
    starts = np.arange(560)
    keys = [data[s : s + 20].tobytes() for s in starts]
    several = {k for k in keys if keys.count(k) > 1}
    alive, group = radix_groups(data, starts, 20)
    assert sorted(alive.tolist()) == [s for s in starts if keys[s] in several]
    assert len(set(group.tolist())) == len(several)
    covered = []
    for some in prefix_groups(data.astype(np.int64), starts, 20, 15):
        alive, node = deep_nodes(data.astype(np.int64), starts[some], 20)
        assert len({keys[s] for s in some[alive]}) == len(set(node.tolist()))
        covered.extend(some[alive].tolist())
    assert sorted(covered) == [s for s in starts if keys[s] in several]


def test_gram_must_fit():
    with pytest.raises(ValueError):
        byte_task("doc_id", "text", 50, 4)


def test_task_is_replaceable():
    assert replace(byte_task("doc_id", "text", 50, 16), buckets=7).buckets == 7


def test_words_made_to_have_equal_sums(spark):
    """Two words of 1,024 characters by the Thue-Morse rule, whose sums modulo 2**64 are equal in any base."""
    bits = [bin(k).count("1") % 2 for k in range(1_024)]
    one, other = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    start = " ".join(f"w{k}" for k in range(34))
    rows = [(1, f"{start} {one}"), (2, f"{start} {other}"), (3, f"{start} {one} x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_words(drop_repeated_words(docs)) == sorted(brute.repeated_words(rows, 35), key=repr)
    assert [r.n_removed for r in drop_repeated_words(docs).orderBy("doc_id").collect()] == [35, 0, 35]
