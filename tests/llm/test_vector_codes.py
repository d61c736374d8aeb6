"""Codes and codebooks against plain loops over Python's integers."""

from __future__ import annotations

import collections
import math
import random

import numpy as np
import pytest

from ledgerline.llm.vector_codes import Slices, codebooks_digest, cuts, integers, vector_codes

MOST = 2**63 - 1


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def nearest(part, book):
    gaps = [sum((a - b) ** 2 for a, b in zip(part, entry)) for entry in book]
    return gaps.index(min(gaps)), min(gaps)


def expected(rows, entries=256, rounds=4):
    """(id, vector, label) rows."""
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    kept = sorted((r for r in rows if usable(r[1])), key=key)
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return [], []
    exact = [[int(v) * 1024 if abs(v) >= 2**53 else math.floor(v * 1024) for v in r[1]] for r in kept]
    where = cuts(len(exact[0]), 4)
    books = [[v[part] for v in exact[:entries]] for part in where]
    for _ in range(rounds):
        for book, part in zip(books, where):
            members = collections.defaultdict(list)
            for v in exact:
                members[nearest(v[part], book)[0]].append(v[part])
            for e, given in members.items():
                book[e] = [sum(column) // len(given) for column in zip(*given)]
    found = []
    for (i, _, label), v in zip(kept, exact):
        best = [nearest(v[part], book) for book, part in zip(books, where)]
        found.append((i, label, "".join(f"{e:02x}" for e, _ in best), min(MOST, sum(d for _, d in best))))
    by_label = collections.Counter()
    for _, label, _, error in found:
        by_label[label] += error
    return [(*f, min(MOST, by_label[f[1]])) for f in found], books


def run(spark, rows, **options):
    table = spark.createDataFrame(
        [(i, v, label, "odd", 1.0) for i, v, label in rows],
        "vec_id long, embedding array<float>, label int, code string, error double",
    )
    coded, books = vector_codes(table.repartition(3), **options)
    return sorted((tuple(r) for r in coded.collect()), key=str), books


def check(spark, rows, **options):
    want, books = expected(rows, **options)
    found, ours = run(spark, rows, **options)
    assert found == sorted(want, key=str)
    if books:
        assert [b.tolist() for b in ours] == books
        assert codebooks_digest(ours) == codebooks_digest([np.array(b, object) for b in books])


def vectors(seed, n, dims, spread=1.0):
    r = np.random.default_rng(seed)
    return (r.normal(size=(n, dims)) * spread).astype(np.float32).tolist()


def test_edges(spark):
    """Unusable rows, null and repeated ids, ties, copies, other lengths."""
    good = vectors(1, 60, 8)
    rows = [(i, v, i % 3 if i % 5 else None) for i, v in enumerate(good)]
    rows += [(70, None, 1), (0, [1.0] * 7 + [None], 1), (71, [float("nan")] * 8, 1), (72, [float("inf")] + [0.0] * 7, 2)]
    rows += [(73, [0.0] * 8, None), (None, good[3], 7), (5, good[6], 7), (5, good[6], 7), (80, [1.0] * 9, 1), (81, [], 1)]
    rows += [(90 + k, [0.5, -0.5] * 4, 9) for k in range(40)]
    check(spark, rows, entries=7)
    check(spark, rows)


@pytest.mark.parametrize("dims", [1, 3, 5])
def test_parts_that_do_not_divide(spark, dims):
    check(spark, [(i, v, 0) for i, v in enumerate(vectors(dims, 40, dims))], entries=9)


def test_large_components(spark):
    """Beyond what squares leave room for in 64 bits, and beyond 64 bits."""
    rows = [(i, v, i % 2) for i, v in enumerate(vectors(2, 40, 8))]
    rows += [(100 + i, v, i % 2) for i, v in enumerate(vectors(3, 10, 8, 1e7))]
    rows += [(200 + i, v, 5) for i, v in enumerate(vectors(4, 5, 8, 1e37))]
    check(spark, rows, entries=6)
    check(spark, [(-1, [float(np.float32(1e30))] * 8, 0), *rows], entries=6)


def test_one_row_and_none(spark):
    check(spark, [(1, [0.25, -0.25, 0.1], 1)])
    check(spark, [(1, [], 1), (2, [], None)])
    assert run(spark, [])[0] == []
    assert run(spark, [(1, None, 1)])[0] == []


def test_search_is_exact():
    r = random.Random(3)
    for n, dims, span in ((1, 2, 5), (2, 1, 3), (64, 3, 4), (65, 4, 50), (256, 16, 2000)):
        entries = np.array([[r.randint(-span, span) for _ in range(dims)] for _ in range(n)])
        x = np.array([[r.randint(-2 * span, 2 * span) for _ in range(dims)] for _ in range(300)])
        for kind in (np.int64, object):
            entry, distance = Slices(entries.astype(kind)).nearest(x.astype(kind))
            want = [nearest(a, entries.tolist()) for a in x.tolist()]
            assert list(zip(entry.tolist(), distance.tolist())) == want


def test_floors_go_down():
    values = np.array([[0.0009765, -0.0009765, -0.0, -1e-45, 3.4e38, 1e308]])
    assert integers(values).tolist() == [[0, -1, 0, -1, int(3.4e38) * 1024, int(1e308) * 1024]]
    assert integers(values[:, :4]).dtype == np.int64
