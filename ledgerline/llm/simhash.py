"""Near-duplicate documents by SimHash fingerprints that differ in few bits.

The search for close fingerprints is the generalised pigeonhole: the bits are dealt into m parts; if
two fingerprints differ in at most t bits and the thresholds of the parts sum to t - m + 1, then in
some part they differ by no more than its threshold. Bits that agree often go in one part, and
each fingerprint gets its own thresholds, by dynamic programming over the number of candidates
that each part would bring at each threshold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.graph import components, spanning_stars
from ledgerline.llm.repeats import mix, ranges, slices, split_words, text_bytes
from ledgerline.session import materialize, ship_package

SHINGLE = 4
SEED = 42
BITS = 64
DISTANCE = 4
SLICE_BYTES = 500_000
COUNTED_BITS = 16  # of a part, in the table of counts
KEY_ROWS = 1_000  # fingerprints of one key that are compared in one place
PAIR_BLOCK = 2_000_000
ASKING = 1_000  # fingerprints that ask at a time in one place
LONGEST = 256

_U = np.uint64
# The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (
    _U(0x9E3779B185EBCA87),
    _U(0xC2B2AE3D27D4EB4F),
    _U(0x165667B19E3779F9),
    _U(0x85EBCA77C2B2AE63),
    _U(0x27D4EB2F165667C5),
)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << _U(n)) | (x >> _U(64 - n))


def _round(state: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(state + lane * _P2, 31) * _P1


def xxh64_spans(data: np.ndarray, first: np.ndarray, size: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of each span of ``data``; spans of one size are hashed together."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(_U)
    wide = padded
    for step in (1, 2, 4):
        wide = wide[:-step] | (wide[step:] << _U(8 * step))
        if step == 2:
            narrow = wide
    out = np.empty(len(first), _U)
    order = np.argsort(np.minimum(size, LONGEST + 1).astype(np.uint16), kind="stable")
    start = _U(seed)
    with np.errstate(over="ignore"):
        for n, lo, hi in slices(np.minimum(size, LONGEST + 1)[order]):
            which = order[lo:hi]
            at = first[which]
            if n > LONGEST:
                out[which] = [xxhash.xxh64_intdigest(data[i : i + k].tobytes(), seed) for i, k in zip(at, size[which])]
                continue
            done = 0
            if n >= 32:
                lanes = [np.full(len(at), s, _U) for s in (start + _P1 + _P2, start + _P2, start, start - _P1)]
                while done + 32 <= n:
                    lanes = [_round(s, wide[at + done + 8 * k]) for k, s in enumerate(lanes)]
                    done += 32
                h = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
                for s in lanes:
                    h = (h ^ _round(np.zeros_like(s), s)) * _P1 + _P4
            else:
                h = np.full(len(at), start + _P5, _U)
            h = h + _U(n)
            while done + 8 <= n:
                h = _turn(h ^ _round(np.zeros_like(h), wide[at + done]), 27) * _P1 + _P4
                done += 8
            if done + 4 <= n:
                h = _turn(h ^ (narrow[at + done] * _P1), 23) * _P2 + _P3
                done += 4
            for i in range(done, n):
                h = _turn(h ^ (padded[at + i] * _P5), 11) * _P1
            h = (h ^ (h >> _U(33))) * _P2
            h = (h ^ (h >> _U(29))) * _P3
            out[which] = h ^ (h >> _U(32))
    return out


def majority(hashes: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Per row, the bits that are set in over half of its hashes; ``row`` ascends."""
    total = np.bincount(row, minlength=rows)
    out = np.zeros(rows, _U)
    if not len(hashes):
        return out
    inside = np.arange(len(row)) - (np.cumsum(total) - total)[row]
    cut = np.nonzero(inside % 255 == 0)[0]  # a byte counts up to 255
    owner = row[cut]
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> _U(shift)) & _U(0x0101010101010101), cut)
        for byte in range(8):
            count = np.bincount(owner, ((lanes >> _U(8 * byte)) & _U(255)).astype(np.int64), rows)
            out |= (2 * count > total).astype(_U) << _U(8 * byte + shift)
    return out


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of words of each text, repeats included, and the rows that they are of."""
    rows = len(offsets) - 1
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    words = split_words(data, offsets)
    size = words.end - words.first + 1
    end = np.cumsum(size)
    joined = np.full(int(size.sum()), 32, np.uint8)
    joined[ranges(end - size, size - 1)] = data[ranges(words.first, size - 1)]
    n_words = np.diff(words.offsets)
    n = np.where(n_words > 0, np.maximum(n_words - shingle + 1, 1), 0)
    start = ranges(words.offsets[:-1], n)
    row = np.repeat(np.arange(rows), n)
    last = np.minimum(start + shingle, words.offsets[1:][row]) - 1
    first = (end - size)[start]
    return xxh64_spans(joined, first, end[last] - 1 - first), row


def fingerprint(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of each text, over hashes of its shingles of words, repeats included."""
    return majority(*shingle_hashes(data, offsets, shingle), len(offsets) - 1)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id``, ``copy`` (hash of the text) and ``fp`` of each row; a null text has no words."""
    ship_package(docs.sparkSession)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            found = np.zeros(len(offsets) - 1, _U)
            for _, lo, hi in slices(offsets[:-1] // SLICE_BYTES):
                part = offsets[lo : hi + 1]
                found[lo:hi] = fingerprint(data[part[0] : part[-1]], part - part[0])
            columns = [batch.column("id"), batch.column("copy"), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "copy", "fp"])

    text = F.col(text_column)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("copy"), text.alias("text"))
    return rows.mapInArrow(apply, "id long, copy long, fp long")


class Parts:
    """Which bits make a part, how often each value of a part occurs, and the thresholds to choose from."""

    def __init__(self, bits: list[list[int]], distance: int) -> None:
        self.bits, self.distance = bits, distance
        self.counts = [np.zeros(1 << min(len(b), COUNTED_BITS), np.int64) for b in bits]
        self.near: list[np.ndarray] = []

    def key(self, part: int, fp: np.ndarray) -> np.ndarray:
        """The bits of a part, side by side, the first lowest."""
        out = np.zeros(len(fp), _U)
        for to, bit in enumerate(self.bits[part]):
            out |= ((fp >> _U(bit)) & _U(1)) << _U(to)
        return out

    def cell(self, part: int, key: np.ndarray) -> np.ndarray:
        return (key & _U(len(self.counts[part]) - 1)).astype(np.int64)

    def estimate(self) -> None:
        """Per part, threshold and counted value: candidates, and one more per key that is asked."""
        most = self.distance - len(self.bits) + 1
        for bits, counts in zip(self.bits, self.counts):
            at, free = np.arange(len(counts)), len(bits) - min(len(bits), COUNTED_BITS)
            rings = [counts.astype(float)]
            for r in range(1, most + len(self.bits)):
                # Ring r from ring r - 1: flip one more bit, and take out those that flip back.
                ring = sum(rings[r - 1][at ^ (1 << b)] for b in range(len(bits) - free))
                ring = ring + free * rings[r - 1]
                if r > 1:
                    ring = ring - (len(bits) - r + 2) * rings[r - 2]
                rings.append(np.maximum(ring / r, 0))
            asked = [_choose(len(bits), r) for r in range(len(rings))]
            total = np.cumsum(rings, 0) / (1 << free) + np.cumsum(asked)[:, None]
            self.near.append(np.vstack([np.zeros(len(counts)), total]))

    def thresholds(self, fp: np.ndarray) -> np.ndarray:
        """For each fingerprint a threshold per part (-1: not asked) that sum to distance - parts + 1."""
        parts = len(self.bits)
        budget = self.distance + 1  # each threshold counts one more, so that none is negative
        best = np.full((budget + 1, len(fp)), np.inf)
        best[0] = 0
        choice = np.zeros((parts, budget + 1, len(fp)), np.int8)
        for part in range(parts):
            cost = self.near[part][:, self.cell(part, self.key(part, fp))]
            now = np.full_like(best, np.inf)
            for used in range(budget + 1):
                for take in range(min(used, len(cost) - 1) + 1):
                    total = best[used - take] + cost[take]
                    better = total < now[used]
                    now[used][better] = total[better]
                    choice[part, used][better] = take
            best = now
        left, out = np.full(len(fp), budget), np.empty((parts, len(fp)), np.int64)
        for part in reversed(range(parts)):
            take = choice[part][left, np.arange(len(fp))]
            out[part], left = take - 1, left - take
        return out

    def shares(self, part: int, key: np.ndarray) -> np.ndarray:
        return self.counts[part][self.cell(part, key)] // KEY_ROWS + 1


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def group_bits(joint: np.ndarray, rows: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of like size, each filled with the bits that correlate most with it."""
    share = joint / max(rows, 1)
    mean = np.diag(share)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    related = np.abs((share - np.outer(mean, mean)) / np.outer(spread, spread))
    free, groups = list(range(len(mean))), []
    for k in range(parts):
        size = -(-len(free) // (parts - k))
        group = [max(free, key=lambda b: related[b, free].sum() - related[b, b])]
        free.remove(group[0])
        while len(group) < size:
            group.append(max(free, key=lambda b: related[b, group].sum()))
            free.remove(group[-1])
        groups.append(sorted(group))
    return groups


def _parts_for(rows: int) -> int:
    """Fewer and wider parts for more fingerprints, so that a key stays with few of them."""
    return next((m for m in (4, 3) if rows >> (BITS // m) < 64), 2)


def close_pairs(distinct: DataFrame, distance: int = DISTANCE, parts: int | None = None) -> DataFrame:
    """Links (a, b) that join all fingerprints of ``distinct`` (fp) within ``distance`` bits.

    Not every pair is a row: in each place that compares, links are thinned to a spanning forest, which
    leaves the components as they are. All fingerprints are asked; none is left out for being common:
    a common key is dealt over as many places as it needs.
    """
    spark = distinct.sparkSession
    ship_package(spark)

    def joint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            raw = batch.column("fp").to_numpy().view(np.uint8).reshape(-1, 8)
            x = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
            total, rows = total + (x.T @ x).astype(np.int64), rows + len(x)
        at = np.arange(BITS * BITS + 1)
        yield pa.RecordBatch.from_pydict({"at": at, "n": np.append(total.ravel(), rows)})

    sums = distinct.mapInArrow(joint, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1, np.int64)
    for row in sums:
        flat[row["at"]] = row["n"]
    rows = int(flat[-1])
    plan = Parts(group_bits(flat[:-1].reshape(BITS, BITS), rows, parts or _parts_for(rows)), distance)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(_U)
            for part in range(len(plan.bits)):
                cell, n = np.unique(plan.cell(part, plan.key(part, fp)), return_counts=True)
                yield pa.RecordBatch.from_pydict({"part": np.full(len(cell), part), "cell": cell, "n": n})

    counted = distinct.mapInArrow(count, "part long, cell long, n long").groupBy("part", "cell").agg(F.sum("n").alias("n"))
    for batch in counted.toArrow().to_batches():
        part, cell, n = (batch.column(c).to_numpy() for c in ("part", "cell", "n"))
        for k in range(len(plan.bits)):
            plan.counts[k][cell[part == k]] = n[part == k]
    plan.estimate()
    shared = spark.sparkContext.broadcast(plan)
    places = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // 1_000_000 + 1)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(_U)
            for lo in range(0, len(fp), 20_000):
                yield from _asked(fp[lo : lo + 20_000], plan, places)

    def compare(table: pa.Table) -> pa.Table:
        kept = [np.concatenate(x) for x in zip(*(_read(b) for b in table.column("blob").to_pylist()))]
        a, b = _verified(*kept, distance)
        member, root = spanning_stars(a, b)
        return pa.table({"a": member.view(np.int64), "b": root.view(np.int64)})

    asked = distinct.mapInArrow(ask, "place long, blob binary")
    return asked.groupBy("place").applyInArrow(compare, "a long, b long")


def _asked(fp: np.ndarray, plan: Parts, places: int) -> Iterator[pa.RecordBatch]:
    """Each fingerprint under its own keys, and under all keys near enough for its thresholds."""
    limit = plan.thresholds(fp)
    where, which, asks = [], [], []
    for part, bits in enumerate(plan.bits):
        own = plan.key(part, fp)
        share = plan.shares(part, own)
        where.append(_place(part, own, (mix(fp) % share.astype(_U)).astype(np.int64)))
        which.append(fp)
        asks.append(np.zeros(len(fp), np.uint8))
        for radius in range(len(bits) + 1):
            some = np.nonzero(limit[part] >= radius)[0]
            if not len(some):
                break
            flips = np.array([sum(1 << b for b in c) for c in combinations(range(len(bits)), radius)], _U)
            keys = (own[some][:, None] ^ flips).ravel()
            askers = np.repeat(fp[some], len(flips))
            share = plan.shares(part, keys)
            found = plan.counts[part][plan.cell(part, keys)] > 0
            keys, askers, share = keys[found], askers[found], share[found]
            where.append(_place(part, np.repeat(keys, share), ranges(np.zeros(len(share), np.int64), share)))
            which.append(np.repeat(askers, share))
            asks.append(np.ones(int(share.sum()), np.uint8))
    where, which, asks = np.concatenate(where), np.concatenate(which), np.concatenate(asks)
    place = (where % _U(places)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    rows = [
        (p, where[order[lo:hi]].tobytes() + which[order[lo:hi]].tobytes() + asks[order[lo:hi]].tobytes())
        for p, lo, hi in slices(place[order])
    ]
    yield pa.RecordBatch.from_pydict({"place": [r[0] for r in rows], "blob": [r[1] for r in rows]})


def _place(part: int, key: np.ndarray, share: np.ndarray) -> np.ndarray:
    return mix(mix(key + _U(part + 1)) ^ share.astype(_U))


def _read(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(raw) // 17
    return np.frombuffer(raw, _U, n), np.frombuffer(raw, _U, n, 8 * n), np.frombuffer(raw, np.uint8, n, 16 * n)


def _verified(where: np.ndarray, fp: np.ndarray, asks: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of an asking and an indexed fingerprint at one place that are close, in blocks."""
    own, asking = np.nonzero(asks == 0)[0], np.nonzero(asks)[0]
    own = own[np.argsort(where[own], kind="stable")]
    low = np.searchsorted(where[own], where[asking], "left")
    n = np.searchsorted(where[own], where[asking], "right") - low
    a, b = [np.zeros(0, _U)], [np.zeros(0, _U)]
    for _, lo, hi in slices((np.cumsum(n) - n) // PAIR_BLOCK):
        left = np.repeat(fp[asking[lo:hi]], n[lo:hi])
        right = fp[own[ranges(low[lo:hi], n[lo:hi])]]
        near = (left < right) & (np.bitwise_count(left ^ right) <= distance)
        member, root = spanning_stars(left[near], right[near])
        a.append(member)
        b.append(root)
    return np.concatenate(a), np.concatenate(b)


def near_pairs(own: np.ndarray, asking: np.ndarray, distance: int, parts: int = 4) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``asking`` and ``own`` of all their pairs within ``distance`` bits, in blocks; a pair may come more than once.

    The same search in one place: the parts and the counts are those of ``own``, and no key is sent anywhere.
    """
    if not len(own):
        return
    x = np.unpackbits(np.ascontiguousarray(own).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
    plan = Parts(group_bits(x.T @ x, len(own), parts), distance)
    by_cell, first = [], []
    for part in range(parts):
        cell = plan.cell(part, plan.key(part, own))
        plan.counts[part] += np.bincount(cell, minlength=len(plan.counts[part]))
        by_cell.append(np.argsort(cell, kind="stable"))
        first.append(np.cumsum(plan.counts[part]) - plan.counts[part])
    plan.estimate()
    flips = {}
    for lo in range(0, len(asking), ASKING):
        fp = asking[lo : lo + ASKING]
        limit = plan.thresholds(fp)
        for part, bits in enumerate(plan.bits):
            key = plan.key(part, fp)
            for radius in range(limit[part].max(initial=-1) + 1):
                some = np.nonzero(limit[part] >= radius)[0]
                shape = len(bits), radius
                if shape not in flips:
                    flips[shape] = np.array([sum(1 << b for b in c) for c in combinations(range(len(bits)), radius)], _U)
                cells = plan.cell(part, (key[some][:, None] ^ flips[shape]).ravel())
                askers, n = np.repeat(some, len(flips[shape])), plan.counts[part][cells]
                cells, askers, n = cells[n > 0], askers[n > 0], n[n > 0]
                for _, a, b in slices((np.cumsum(n) - n) // PAIR_BLOCK):
                    mine = np.repeat(askers[a:b], n[a:b])
                    theirs = by_cell[part][ranges(first[part][cells[a:b]], n[a:b])]
                    near = np.bitwise_count(fp[mine] ^ own[theirs]) <= distance
                    yield lo + mine[near], theirs[near]


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    distance: int = DISTANCE,
    parts: int | None = None,
) -> DataFrame:
    """``id``, ``copy``, ``fp``, ``group`` and ``component`` (smallest id that links reach) of each row.

    Fingerprints link at ``distance`` or fewer differing bits. Rows with one fingerprint, the empty
    texts among them, are one node, so copies are never paired. A null id takes part but is no
    component's id unless all of its rows lack one. An empty table gives an empty result.
    """
    rows = materialize(fingerprints(docs, id_column, text_column), "fingerprints")
    classes = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    reached = components(close_pairs(classes.select("fp"), distance, parts))
    named = classes.join(reached.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("fp", "least", F.coalesce("component", "fp").alias("group"))
    smallest = named.groupBy("group").agg(F.min("least").alias("component"))
    by_class = named.join(smallest, "group").select("fp", "group", "component")
    return rows.join(by_class, "fp").select("id", "copy", "fp", "group", "component")


def one_of_each(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    find: Callable[[DataFrame, str, str], DataFrame] = near_duplicates,
) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the smallest id stays.

    ``find`` gives ``id``, ``copy`` and ``group`` of each row. Of rows that share that id the one with the smallest text hash stays; rows with the same id and
    text count once. If no row of a component has an id, the smallest text hash decides.
    """
    columns = docs.columns
    found = find(docs, id_column, text_column)
    order = F.struct(F.col("id").isNull().alias("_absent"), "id", "copy")
    best = found.groupBy("group").agg(F.min(order).alias("s"))
    # One key for id and text: the join and the removal of repeated rows share its shuffle.
    stays = best.select(row_key(F.col("s.id"), F.col("s.copy")).alias("__key"))
    keyed = docs.withColumn("__key", row_key(F.col(id_column).cast("long"), F.xxhash64(text_column)))
    return keyed.join(stays, "__key", "left_semi").dropDuplicates(["__key"]).select(*columns)


def row_key(row_id: Column, copy: Column) -> Column:
    return F.concat(F.coalesce(row_id.cast("string"), F.lit("none")), F.lit("/"), copy.cast("string"))
