"""Vectors as short codes: one codebook entry for each part, found by intersecting bitmasks of slices.

Components are taken as the integers floor(1024 x), and a vector is cut into equal consecutive parts. Each
part has a codebook of up to 256 entries, which starts as that part of the rows with the smallest ids and
goes through rounds of assigning every part to its nearest entry and replacing entries by the mean, rounded
down, of what they were given. Entries that got nothing stay.

Nearest entries are found exactly (:class:`Slices`): for each dimension the entries' coordinates are
sorted, and for each place in that order a bitmask tells which entries come before it. The entries whose
coordinate lies within a radius are the difference of two such masks, and the masks of all dimensions
ANDed leave the entries of a box. If the nearest of them is no farther than the radius, nothing outside can
be nearer; else the box is taken again with a radius that a known entry's distance gives.

Distances are squared and exact: 64-bit integers where they cannot overflow, else integers of any size.
What a task sends per round is a sum per entry it used, whatever its rows; those are added per entry, and
the codebooks, whose size the parameters fix, are what the driver holds.

Rows whose vector is null or has null or non-finite components are dropped, and so are vectors that are not
as long as that of the smallest id left. A length that the parts do not divide gives the first parts one
component more. Null ids come last; rows of one id are told apart by their vectors, and all are coded.
Errors beyond 64 bits count as the largest such integer.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerline.operators.joins import keyed_join
from ledgerline.session import materialize, ship_package

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK = 1_024  # vectors compared at a time

_MOST = 2**63 - 1
_WIDE = 2**62  # sums are kept below this in 64 bits


class Slices:
    """Entries of one codebook, for exact nearest search."""

    def __init__(self, entries: np.ndarray) -> None:
        n, self.dims = entries.shape
        self.entries, self.n = entries, n
        words = -(-n // 64)
        bits = np.zeros((n, words), np.uint64)
        bits[np.arange(n), np.arange(n) // 64] = np.uint64(1) << (np.arange(n, dtype=np.uint64) % np.uint64(64))
        self.everything = np.bitwise_or.reduce(bits, 0)
        self.sorted, self.masks = [], []
        for j in range(self.dims):
            order = np.argsort(entries[:, j], kind="stable")
            masks = np.zeros((n + 1, words), np.uint64)
            np.bitwise_or.accumulate(bits[order], 0, out=masks[1:])
            self.sorted.append(entries[order, j])
            self.masks.append(masks)
        self.radius = self._usual_gap()
        spread = [s[-1] - s[0] for s in self.sorted]
        self.widest = int(np.argmax(spread)) if spread else 0
        if spread:
            self.order = np.argsort(entries[:, self.widest], kind="stable")

    def _usual_gap(self):
        """The median distance of an entry to the nearest other one."""
        gaps = [np.sort(((self.entries - e) ** 2).sum(1))[1:2] for e in self.entries]
        return np.sort(_roots(np.concatenate(gaps)))[len(gaps) // 2] if self.n > 1 else 0

    def box(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Bitmasks of the entries that differ from each row by at most ``radius`` in every dimension."""
        found = np.repeat(self.everything[None], len(x), 0)
        for j in range(self.dims):
            low = np.searchsorted(self.sorted[j], x[:, j] - radius, "left")
            high = np.searchsorted(self.sorted[j], x[:, j] + radius, "right")
            found &= self.masks[j][high] ^ self.masks[j][low]
        return found

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry of each row, the smaller on ties, and the squared distance."""
        if not self.dims:
            return np.zeros(len(x), np.int64), np.zeros(len(x), x.dtype)
        entry, distance = self._least(x, self.box(x, np.full(len(x), self.radius, x.dtype)))
        open_rows = np.nonzero((entry < 0) | (distance > self.radius * self.radius))[0]
        if len(open_rows):
            rest, known = x[open_rows], distance[open_rows].copy()
            none = entry[open_rows] < 0
            near = np.searchsorted(self.sorted[self.widest], rest[none, self.widest]).clip(max=self.n - 1)
            known[none] = ((rest[none] - self.entries[self.order[near]]) ** 2).sum(1)
            entry[open_rows], distance[open_rows] = self._least(rest, self.box(rest, _roots(known)))
        return entry, distance

    def _least(self, x: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bits = np.unpackbits(masks.astype("<u8").view(np.uint8), axis=1, bitorder="little")
        row, candidate = np.nonzero(bits[:, : self.n])
        entry, distance = np.full(len(x), -1), np.zeros(len(x), x.dtype)
        if len(row):
            gap = ((x[row] - self.entries[candidate]) ** 2).sum(1)
            first = np.nonzero(np.diff(row, prepend=-1))[0]
            least = np.minimum.reduceat(gap, first)
            at = np.nonzero(gap == np.repeat(least, np.diff(first, append=len(row))))[0]
            rows, firsts = np.unique(row[at], return_index=True)
            entry[rows], distance[rows] = candidate[at[firsts]], least
        return entry, distance


def _roots(squares: np.ndarray) -> np.ndarray:
    """Integers not below the square roots."""
    if squares.dtype == object:
        return np.array([math.isqrt(int(s)) + 1 for s in squares], object)
    return np.sqrt(squares.astype(np.float64)).astype(np.int64) + 1


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale x) of finite doubles, ``scale`` a power of two: 64-bit where all fit, else Python's integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if (np.abs(scaled) < _WIDE).all():
        return scaled.astype(np.int64)
    flat = [int(v) * scale if abs(v) >= 2**53 else math.floor(v * scale) for v in values.ravel().tolist()]
    return np.array(flat, object).reshape(values.shape)


def cuts(dims: int, parts: int) -> list[slice]:
    """Equal consecutive parts; the first ones have a component more if need be."""
    edges = [k * (dims // parts) + min(k, dims % parts) for k in range(parts + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


class Codebooks:
    """The codebooks of all parts, ready to search."""

    def __init__(self, books: list[np.ndarray], scale: int) -> None:
        self.scale = scale
        self.parts = cuts(sum(b.shape[1] for b in books), len(books))
        # Differences within this bound keep a sum of their squares in 64 bits.
        self.bound = math.isqrt(_WIDE // max(1, *(b.shape[1] for b in books))) // 2
        exact = [b.astype(object) for b in books]
        small = all(abs(v) <= self.bound for b in exact for v in b.ravel().tolist())
        self.small = [Slices(b.astype(np.int64)) for b in books] if small else None
        self.exact = exact
        self.large: list[Slices] | None = None

    def assign(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For some rows at a time: their numbers, components, entry of each part, and squared distance of each part."""
        for lo in range(0, len(vectors), BLOCK):
            block = integers(vectors[lo : lo + BLOCK], self.scale)
            rows = np.arange(lo, lo + len(block))
            fits = np.zeros(len(block), bool)
            if self.small:
                fits = (np.abs(block) <= self.bound).all(1).astype(bool)
            if fits.any():
                yield self._found(rows[fits], block[fits].astype(np.int64), self.small)
            if not fits.all():
                self.large = self.large or [Slices(b) for b in self.exact]
                yield self._found(rows[~fits], block[~fits].astype(object), self.large)

    def _found(self, rows: np.ndarray, x: np.ndarray, books: list[Slices]):
        found = [book.nearest(x[:, part]) for book, part in zip(books, self.parts)]
        return rows, x, np.stack([e for e, _ in found], 1), np.stack([d for _, d in found], 1)


class Sums:
    """Sum and number of the rows that each entry of each part got."""

    def __init__(self, books: Codebooks, entries: int, dims: int) -> None:
        self.books = books
        self.count = np.zeros((len(books.parts), entries), np.int64)
        self.total = np.zeros((entries, dims), np.int64)
        self.reach = 0  # no sum is larger

    def add(self, vectors: np.ndarray) -> None:
        for _, x, entry, _ in self.books.assign(vectors):
            self.reach += int(np.abs(x).max(initial=0)) * len(x)
            if x.dtype == object or self.reach >= _WIDE:
                self.total, x = self.total.astype(object), x.astype(object)
            for p, part in enumerate(self.books.parts):
                order = np.argsort(entry[:, p], kind="stable")
                used, first = np.unique(entry[order, p], return_index=True)
                self.count[p, used] += np.diff(first, append=len(x))
                if part.stop > part.start:
                    self.total[used, part] += np.add.reduceat(x[order, part], first, 0)

    def rows(self) -> pa.RecordBatch:
        p, entry = np.nonzero(self.count)
        sums = [self.total[e, self.books.parts[k]].tolist() for k, e in zip(p.tolist(), entry.tolist())]
        wide = self.total.dtype == object
        small = [None] * len(sums) if wide else sums
        large = [[str(v) for v in s] for s in sums] if wide else [None] * len(sums)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(p, pa.int32()),
                pa.array(entry, pa.int32()),
                pa.array(self.count[p, entry], pa.int64()),
                pa.array(small, pa.list_(pa.int64())),
                pa.array(large, pa.list_(pa.string())),
            ],
            ["part", "entry", "n", "sums", "large"],
        )


def _means(table: pa.Table) -> pa.Table:
    """The mean of one entry, rounded down, from the sums of all tasks."""
    n = sum(table.column("n").to_pylist())
    total = None
    for small, large in zip(table.column("sums").to_pylist(), table.column("large").to_pylist()):
        values = np.array(small if small is not None else [int(v) for v in large], object)
        total = values if total is None else total + values
    means = [str(int(v) // n) for v in total.tolist()]
    return pa.table(
        {
            "part": table.column("part").slice(0, 1),
            "entry": table.column("entry").slice(0, 1),
            "means": pa.array([means], pa.list_(pa.string())),
        }
    )


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(column), dims)


def fit_codebooks(
    kept: DataFrame,
    id: str,
    vector: str,
    dims: int,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> list[np.ndarray]:
    """The entries of each part after all rounds; every round is one pass over ``kept``."""
    first = kept.orderBy(F.col(id).asc_nulls_last(), vector).limit(entries).select(vector).collect()
    start = integers(np.array([r[0] for r in first], np.float64).reshape(len(first), dims), scale)
    books = [start[:, part].astype(object) for part in cuts(dims, parts)]
    for _ in range(rounds):
        means = kept.select(vector).mapInArrow(_adder(books, scale, dims), _SUMS)
        means = means.groupBy("part", "entry").applyInArrow(_means, "part int, entry int, means array<string>")
        for row in means.collect():  # parts times entries at most
            books[row["part"]][row["entry"]] = [int(v) for v in row["means"]]
    return books


_SUMS = "part int, entry int, n bigint, sums array<bigint>, large array<string>"


def _adder(books: list[np.ndarray], scale: int, dims: int):
    books = [b.copy() for b in books]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(Codebooks(books, scale), len(books[0]), dims)
        for batch in batches:
            sums.add(_matrix(batch.column(0), dims))
        yield sums.rows()

    return add


def _coder(books: list[np.ndarray], scale: int, dims: int):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Codebooks(books, scale)
        for batch in batches:
            codes = np.zeros((batch.num_rows, len(books)), np.uint8)
            errors = np.zeros(batch.num_rows, np.int64)
            for rows, _, entry, distance in search.assign(_matrix(batch.column(2), dims)):
                codes[rows] = entry
                errors[rows] = [min(sum(d), _MOST) for d in distance.tolist()]
            texts = pa.array([c.tobytes().hex() for c in codes], pa.string())
            columns = [batch.column(0), batch.column(1), texts, pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "code", "error"])

    return code


def vector_codes(
    table: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``id``, ``label``, ``code``, ``error`` and ``label_error`` of each row that is kept, and the codebooks.

    ``code`` has two hex digits a part, ``error`` is the sum of its parts' squared distances, and ``label_error``
    the sum of errors over equal labels, nulls being equal.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry must have two hex digits")
    ship_package(table.sparkSession)
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    kept = table.select(id, label, vector).where(F.coalesce(~bad, F.lit(False)))
    first = kept.orderBy(F.col(id).asc_nulls_last(), vector).select(F.size(vector)).first()
    dims = first[0] if first else 0
    kept = kept.where(F.size(vector) == dims)
    books = fit_codebooks(kept, id, vector, dims, parts, entries, rounds, scale) if first else []
    kinds = [table.schema[c].dataType.simpleString() for c in (id, label)]
    schema = f"id {kinds[0]}, label {kinds[1]}, code string, error bigint"
    books = books or [np.zeros((1, 0), object)] * parts
    coded = materialize(kept.select(id, label, vector).mapInArrow(_coder(books, scale, dims), schema), "codes")
    group = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("none")).alias("_label")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_MOST).cast("decimal(38,0)"))
    sums = materialize(coded.groupBy(group).agg(total.cast("long").alias("label_error")), "label-errors")
    return keyed_join(coded.withColumn("_label", group), sums, "_label").drop("_label"), books


def codebooks_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and place, as decimal numbers joined by commas."""
    numbers = (str(v) for book in books for v in book.ravel().tolist())
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()
