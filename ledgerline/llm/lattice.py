"""Near-duplicate vectors by lattice hashing.

Unit vectors within a small angle are close points. In each table they are projected at random onto
eight dimensions and scaled, and the nearest point of the E8 lattice names their cell. A vector is
filed under its own cell and asks for its own and the nearest other cells, since a close vector may
lie just across a wall. Every pair that meets is checked by its exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerline.llm.graph import components, spanning_stars
from ledgerline.llm.repeats import mix, ranges, slices
from ledgerline.session import materialize, ship_package

COSINE = 0.93
TABLES = 2
PROBES = 8
CELL = 0.6  # side of the lattice, on unit vectors projected by orthonormal rows times sqrt(dim / 8)
SEED = 20_240_817
BLOCK = 1_000
CELL_ROWS = 2_000  # a cell with more vectors, and more than
CELL_SHARE = 10_000  # one in so many of all, is dealt over several places

_U = np.uint64


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Twice the nearest lattice point of each row: E8 is D8 and D8 moved by a half."""

    def nearest_d8(y: np.ndarray) -> np.ndarray:
        whole = np.rint(y)
        gap = y - whole
        worst = np.abs(gap).argmax(1)
        at = np.arange(len(y))
        other = whole.copy()
        other[at, worst] += np.where(gap[at, worst] >= 0, 1, -1)
        odd = whole.sum(1) % 2 != 0
        return np.where(odd[:, None], other, whole)

    plain, moved = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    nearer = ((x - moved) ** 2).sum(1) < ((x - plain) ** 2).sum(1)
    return (2 * np.where(nearer[:, None], moved, plain)).astype(np.int64)


@lru_cache(maxsize=1)
def shortest_e8() -> np.ndarray:
    """Twice the 240 shortest vectors of E8: steps to the neighbouring cells."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (2, -2):
                for b in (2, -2):
                    v = [0] * 8
                    v[i], v[j] = a, b
                    out.append(v)
    out += [[1 - 2 * (n >> k & 1) for k in range(8)] for n in range(256) if bin(n).count("1") % 2 == 0]
    return np.array(out, np.int64)


def cell_hash(points: np.ndarray, table: int) -> np.ndarray:
    """64 bits that name a cell of a table."""
    code = np.full(points.shape[:-1], table + 1, _U)
    for k in range(8):
        code = mix(code * _U(31) + points[..., k].astype(_U))
    return code


@lru_cache(maxsize=4)
def projections(dim: int, tables: int) -> np.ndarray:
    """Random orthonormal rows per table, the same in every task."""
    rng = np.random.default_rng(SEED)
    out = []
    for _ in range(tables):
        q, _ = np.linalg.qr(rng.standard_normal((max(dim, 8), 8)))
        out.append(q[:dim] * np.sqrt(max(dim, 8) / 8))
    return np.stack(out)


class Cells:
    """Per table: the own cell of each vector and the cells that it asks for besides, labels and lengths included.

    Nothing here depends on the other vectors at hand, so every task finds the same cells for a vector:
    lengths are taken one by one, without padding, and products are summed row by row.
    """

    def __init__(
        self, vector: np.ndarray, size: np.ndarray, label: np.ndarray, tables: int, probes: int, cell: float
    ) -> None:
        n, steps = len(vector), shortest_e8()
        salt = mix(mix(label.astype(_U) + _U(7)) + size.astype(_U))
        self.own = [np.zeros(n, _U) for _ in range(tables)]
        self.near = [np.zeros((n, probes), _U) for _ in range(tables)]
        for dim in np.unique(size):
            rows = np.nonzero(size == dim)[0]
            unit = np.ascontiguousarray(vector[rows, :dim])
            unit /= np.sqrt((unit * unit).sum(1))[:, None]
            for table, matrix in enumerate(projections(int(dim), tables)):
                x = np.einsum("ij,jk->ik", unit, matrix) / cell
                own = nearest_e8(x)
                # |gap - step|^2 = |gap|^2 - 2 gap.step + 8: the nearest cells have the largest product.
                closest = np.argsort(-np.einsum("ij,kj->ik", 2 * x - own, steps), axis=1, kind="stable")[:, :probes]
                self.own[table][rows] = cell_hash(own, table) ^ salt[rows]
                self.near[table][rows] = cell_hash(own[:, None, :] + steps[closest], table) ^ salt[rows, None]

    def meet(self, table: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a asks for the cell of b or b for the cell of a."""
        return (self.own[table][a] == self.own[table][b]) | self.asks(table, a, b) | self.asks(table, b, a)

    def asks(self, table: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.near[table][a] == self.own[table][b][:, None]).any(1)


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of one length in double precision, and which rows are usable: no null, all finite, not zero."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    dim = int(sizes.max(initial=0))
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes NaN
    row = np.repeat(np.arange(len(sizes)), sizes)
    out = np.full((len(sizes), dim), 0.0)
    out[row, ranges(np.zeros(len(sizes), np.int64), sizes)] = values
    usable = np.isfinite(out).all(1) & (out != 0).any(1)
    out[~usable] = 0
    return out, usable


def _sizes(column: pa.Array) -> np.ndarray:
    return column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def usable_vector(name: str) -> Column:
    """Whether a vector can be compared: not null, not zero, all components there and finite."""
    finite = ~F.exists(name, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(finite & F.exists(name, lambda v: v != 0), F.lit(False))


def near_duplicate_vectors(
    table: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str | None = "label",
    cosine: float = COSINE,
    tables: int = TABLES,
    probes: int = PROBES,
    cell: float = CELL,
) -> DataFrame:
    """``id``, ``n_links``, ``component`` and ``kept`` of each row.

    Rows of one label (not null) link if their vectors have a cosine of at least ``cosine``; never a pair
    below it. Equal vectors count once in the search and with their number in ``n_links``. A vector
    that is null, zero, or holds a null or a value that is not finite links with nothing, also if
    its length differs from the other's. A null id is nobody's component; a row without links has
    its own id.
    """
    spark = table.sparkSession
    ship_package(spark)
    label = F.col(label_column) if label_column else F.lit(0)
    if label_column and not isinstance(table.schema[label_column].dataType, T.IntegralType):
        label = F.when(label.isNotNull(), F.xxhash64(label))
    rows = table.select(
        F.col(id_column).cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    usable = usable_vector("vector") & F.col("label").isNotNull()
    # Adding zero makes -0.0 and 0.0 one value.
    rows = rows.withColumn("vector", F.when(usable, F.transform("vector", lambda v: v + F.lit(0.0))))
    folded = rows.where("vector is not null").groupBy("label", "vector")
    classes = folded.agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    met = materialize(_compared(classes, cosine, tables, probes, cell), "met")
    degree = met.where("root is null").groupBy("node").agg(F.sum("others").alias("others"))
    links = met.where("root is not null").select(F.col("node").alias("a"), F.col("root").alias("b"))
    named = classes.join(degree, "node", "left").join(components(links), "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("least").alias("smallest"))
    n_links = F.col("copies") - 1 + F.coalesce("others", F.lit(0))
    found = named.join(smallest, "component").select("label", "vector", n_links.alias("n_links"), "smallest")
    return (
        rows.join(found, ["label", "vector"], "left")
        .withColumn("component", F.coalesce("smallest", "id"))
        .select(
            "id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            "component",
            F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"),
        )
    )


def _compared(classes: DataFrame, cosine: float, tables: int, probes: int, cell: float) -> DataFrame:
    """Rows (node, others): how many vectors a node links to; and rows (node, root): links between them.

    Entries go to places by the hash of their cell, and a place compares those that meet, in blocks.
    No pair leaves it: a pair counts where it first meets (the lowest table, and of two cells of one table
    the one that the smaller node asks for), which each place can tell from the vectors alone, and
    the links are thinned to a spanning forest. A cell with many entries is dealt over several
    places by the node, and whoever asks for it asks in all of them.
    """
    spark = classes.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = Cells(*_filed(batch), tables, 0, cell)
            code, n = np.unique(np.concatenate(at.own), return_counts=True)
            yield pa.RecordBatch.from_pydict({"cell": code.view(np.int64), "n": n})

    total = classes.count()
    limit = max(CELL_ROWS, total // CELL_SHARE)
    filled = classes.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    full = filled.where(F.col("n") > limit).collect()  # CELL_SHARE per table at most
    hot = np.array(sorted(r["cell"] % (1 << 64) for r in full), _U)
    sizes = {r["cell"] % (1 << 64): r["n"] for r in full}
    shares = np.array([-(-sizes[int(c)] // limit) for c in hot], np.int64)
    places = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // 500_000 + 1)

    def share_of(code: np.ndarray) -> np.ndarray:
        out = np.ones(len(code), np.int64)
        if len(hot):
            at = np.minimum(np.searchsorted(hot, code), len(hot) - 1)
            out = np.where(hot[at] == code, shares[at], 1)
        return out

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node").to_numpy()
            at = Cells(*_filed(batch), tables, probes, cell)
            own = np.concatenate(at.own)
            who = np.tile(np.arange(len(node)), tables)
            asked = np.concatenate([own, *(n.ravel() for n in at.near)])
            asker = np.concatenate([who, *(np.repeat(np.arange(len(node)), n.shape[1]) for n in at.near)])
            dealt = mix(node.astype(_U))[who] % share_of(own).astype(_U)
            several = share_of(asked)
            code = np.concatenate([own, np.repeat(asked, several)])
            share = np.concatenate([dealt, ranges(np.zeros(len(several), np.int64), several).astype(_U)])
            entry = np.concatenate([who, np.repeat(asker, several)])
            place = (mix(code ^ mix(share)) % _U(places)).astype(np.int64)
            asks = np.arange(len(code)) >= len(own)
            order = np.argsort(place, kind="stable")
            for p, lo, hi in slices(place[order]):
                some = order[lo:hi]
                yield _entries(p, batch, code[some], asks[some], entry[some])

    def compare(table: pa.Table) -> pa.Table:
        return _met(table, cosine, tables, probes, cell)

    sent = classes.mapInArrow(file, "place long, cells binary, asks binary, at binary, " + _CARRIED_SQL)
    return sent.groupBy("place").applyInArrow(compare, "node long, others long, root long")


_CARRIED = ("node", "label", "copies", "vector")
_CARRIED_SQL = "node array<long>, label array<long>, copies array<long>, vector array<array<double>>"


def _entries(place: int, batch: pa.RecordBatch, code: np.ndarray, asks: np.ndarray, entry: np.ndarray) -> pa.RecordBatch:
    """One row: entries as packed arrays, and each vector that they name once."""
    used, at = np.unique(entry, return_inverse=True)
    columns = {"place": [place], "cells": [code.tobytes()], "asks": [asks.tobytes()], "at": [at.astype(np.int64).tobytes()]}
    for name in _CARRIED:
        values = batch.column(name).take(pa.array(used))
        columns[name] = pa.ListArray.from_arrays(np.array([0, len(used)], np.int32), values)
    return pa.RecordBatch.from_pydict(columns)


def _met(table: pa.Table, cosine: float, tables: int, probes: int, cell: float) -> pa.Table:
    counts = [len(x) for x in table.column("node").to_pylist()]
    node, label, copies = (np.concatenate([c.values.to_numpy() for c in table.column(n).chunks]) for n in _CARRIED[:3])
    vectors = pa.concat_arrays([c.values for c in table.column("vector").chunks])
    vector, size = _vectors(vectors)[0], _sizes(vectors)
    code, asks, at = (
        np.concatenate([np.frombuffer(b, kind) for b in table.column(name).to_pylist()])
        for name, kind in (("cells", _U), ("asks", bool), ("at", np.int64))
    )
    sizes = [len(b) // 8 for b in table.column("cells").to_pylist()]
    at = at + np.repeat(np.cumsum(counts) - counts, sizes)
    norm = (vector * vector).sum(1)
    where = Cells(vector, size, label, tables, probes, cell)
    others = np.zeros(len(node), np.int64)
    stars: list[tuple[np.ndarray, np.ndarray]] = []
    order = np.lexsort((asks, code))
    for _, lo, hi in slices(_groups(code[order])):
        some = order[lo:hi]
        filed, asking = at[some[~asks[some]]], at[some[asks[some]]]
        for a0 in range(0, len(asking) if len(filed) else 0, BLOCK):
            for b0 in range(0, len(filed), BLOCK):
                a, b = asking[a0 : a0 + BLOCK], filed[b0 : b0 + BLOCK]
                cosines = (vector[a] @ vector[b].T) / np.sqrt(norm[a][:, None] * norm[b][None, :])
                alike = (label[a][:, None] == label[b][None, :]) & (size[a][:, None] == size[b][None, :])
                i, j = np.nonzero((cosines >= cosine) & alike)
                a, b = a[i], b[j]
                first = _first_meeting(where, a, b, node, code[some[0]])
                a, b = a[first], b[first]
                np.add.at(others, a, copies[b])
                np.add.at(others, b, copies[a])
                stars.append(spanning_stars(node[a], node[b]))
    linked = np.nonzero(others)[0]
    member = np.concatenate([s[0] for s in stars] or [np.zeros(0, np.int64)])
    root = np.concatenate([s[1] for s in stars] or [np.zeros(0, np.int64)])
    none = np.full(len(linked), -1)
    out = {
        "node": pa.array(np.concatenate([node[linked], member])),
        "others": pa.array(np.concatenate([others[linked], np.zeros(len(member), np.int64)])),
        "root": pa.array(np.concatenate([none, root]), mask=np.arange(len(linked) + len(member)) < len(linked)),
    }
    return pa.table(out)


def _groups(codes: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([[0], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)


def _first_meeting(where: Cells, a: np.ndarray, b: np.ndarray, node: np.ndarray, code: np.uint64) -> np.ndarray:
    """Of pairs (a asks, b is filed) in the cell ``code``, those that count here."""
    counts = node[a] != node[b]
    if not len(a):
        return counts
    table = next(t for t in range(len(where.own)) if where.own[t][b[0]] == code)
    for earlier in range(table):
        counts &= ~where.meet(earlier, a, b)
    same = where.own[table][a] == where.own[table][b]
    return counts & ((node[a] < node[b]) | ~same & ~where.asks(table, b, a))


def _filed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = batch.column("vector")
    return _vectors(vectors)[0], _sizes(vectors), batch.column("label").to_numpy()
