"""Near-duplicate documents by the Jaccard similarity of their sets of shingles.

Texts with one set are one node. Nodes whose SimHashes differ in ``FAR_BITS`` bits at most are found by the generalised
pigeonhole (``simhash.near_pairs``), all of them, among the sets whose sizes allow the similarity. Of sets of similarity
0.8, 95 % lie within these bits; for the others nodes also meet under ``BANDS`` keys made of ``BAND_ROWS`` minhashes,
of which two such sets share none once in 14,000 times. The components of these links are clusters of
candidates, each with all that its members may be similar to. The sets of
a cluster then come to one place, where similarities are counted exactly, and its components are the groups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.graph import components, spanning_stars
from ledgerline.llm.repeats import mix, ranges, slices, text_bytes
from ledgerline.llm.simhash import majority, near_pairs, row_key, shingle_hashes
from ledgerline.operators.joins import keyed_join
from ledgerline.session import materialize, ship_package

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 24
BAND_ROWS = 5
NEAR_BITS = 24  # at 0.8 about 10 bits differ, and 24 are five standard deviations off
FAR_BITS = 14  # radius of the search by fingerprint
WIDE = 3  # more SimHashes of a node, which tell chance from similarity
WIDE_BITS = 54  # of all of them: at 0.8 about 29 bits differ, of unlike sets 96
BLOCK_NODES = 100_000  # fingerprints on one side of a place
SLICE_BYTES = 500_000
PLACE_NODES = 20_000  # nodes whose sets meet in one place, about

_U = np.uint64
_FLIP = mix(np.arange(BANDS * BAND_ROWS, dtype=_U) + _U(1))
_TIMES = mix(_FLIP) | _U(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the shingles of each text, ascending, and their rows."""
    hashes, row = shingle_hashes(data, offsets, shingle)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[new], row[new]


def sketches(hashes: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, ...]:
    """Per row a hash of its set (0 if empty), its SimHash, its keys (all 0 if empty), and ``WIDE`` more SimHashes."""
    node, keys = np.zeros(rows, _U), np.zeros((rows, BANDS), _U)
    full, first = np.unique(row, return_index=True)
    if len(full):
        node[full] = np.add.reduceat(mix(hashes), first)
        for k, (flip, times) in enumerate(zip(_FLIP, _TIMES)):
            least = np.minimum.reduceat((hashes ^ flip) * times, first)
            keys[full, k // BAND_ROWS] = mix(keys[full, k // BAND_ROWS] ^ least) + _U(k // BAND_ROWS)
    wide = [majority(mix(hashes ^ flip), row, rows) for flip in _FLIP[:WIDE]]
    return node, majority(hashes, row, rows), keys, np.stack(wide, axis=1)


def reach(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """Components of 0 to n - 1, by their smallest; ``near`` says which of some others are linked to one.

    One that has a component is not compared again, so a group of like ones takes one pass.
    """
    label, left = np.arange(n), np.arange(n)
    while len(left) > 1:
        seed, left = left[0], left[1:]
        waiting = [seed]
        while waiting and len(left):
            found = near(waiting.pop(), left)
            label[left[found]] = seed
            waiting.extend(left[found].tolist())
            left = left[~found]
    return label


def similar_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``id``, ``copy`` (hash of the text) and ``group`` of each row: texts that chains of similar texts join.

    Similar are texts whose sets of ``shingle`` words have a Jaccard similarity of ``similarity`` or more; a text of
    fewer words is one shingle, and texts without words (null is one) are one group. A pair is only
    missed if it never meets, and then only if no others join it. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship_package(spark)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for _, lo, hi in slices(offsets[:-1] // SLICE_BYTES):
                part = offsets[lo : hi + 1]
                found = shingle_sets(data[part[0] : part[-1]], part - part[0], shingle)
                node, fp, keys, wide = sketches(*found, hi - lo)
                columns = [batch.column(c).slice(lo, hi - lo) for c in ("id", "copy")]
                columns += [pa.array(x.view(np.int64)) for x in (node, fp)]
                columns += [pa.array([k.tobytes() for k in x], pa.binary()) for x in (keys, wide)]
                columns.append(pa.array(np.bincount(found[1], minlength=hi - lo)))
                yield pa.RecordBatch.from_arrays(columns, ["id", "copy", "node", "fp", "keys", "wide", "size"])

    text = F.col(text_column)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("copy"), text.alias("text"))
    shape = "id long, copy long, node long, fp long, keys binary, wide binary, size long"
    rows = materialize(rows.mapInArrow(sketch, shape), "sketches")
    same = [F.min(c).alias(c) for c in ("fp", "keys", "wide", "size")]
    nodes = materialize(rows.where("node <> 0").groupBy("node").agg(*same), "nodes")
    places = max(int(spark.conf.get("spark.sql.shuffle.partitions")), nodes.count() // PLACE_NODES + 1)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column("keys").to_pylist()), _U)
            sides = [np.repeat(batch.column(c).to_numpy().view(_U), BANDS) for c in ("node", "fp")]
            place = (mix(keys) % _U(places)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            found = [(p, b"".join(x[order[lo:hi]].tobytes() for x in (keys, *sides))) for p, lo, hi in slices(place[order])]
            yield pa.RecordBatch.from_pydict({"place": [r[0] for r in found], "blob": [r[1] for r in found]})

    def meet(table: pa.Table) -> pa.Table:
        read = [np.frombuffer(b, _U).reshape(3, -1) for b in table.column("blob").to_pylist()]
        a, b = spanning_stars(*_candidates(*np.concatenate(read, axis=1)))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    met = nodes.mapInArrow(ask, "place long, blob binary").groupBy("place").applyInArrow(meet, "a long, b long")
    met = met.union(_near_by_fingerprint(nodes, similarity))
    clusters = materialize(components(met), "clusters")

    # One text of each node of a cluster is read again; of most nodes none.
    order = F.struct(F.col("id").isNull().alias("_absent"), "id", "copy")
    chosen = rows.join(clusters, "node").groupBy("node", "component").agg(F.min(order).alias("s"))
    chosen = chosen.select(row_key(F.col("s.id"), F.col("s.copy")).alias("__key"), "node", "component")
    texts = docs.select(row_key(F.col(id_column).cast("long"), F.xxhash64(text)).alias("__key"), text.alias("text"))
    texts = keyed_join(texts, materialize(chosen, "chosen"), "__key").where("node IS NOT NULL")
    place = F.pmod(F.xxhash64("component"), F.lit(places)).alias("place")
    kept = ["place", "component", "node"]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for _, lo, hi in slices(offsets[:-1] // SLICE_BYTES):
                part = offsets[lo : hi + 1]
                hashes, row = shingle_sets(data[part[0] : part[-1]], part - part[0], shingle)
                at = np.searchsorted(row, np.arange(hi - lo + 1)).tolist()
                blobs = pa.array([hashes[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())
                columns = [batch.column(c).slice(lo, hi - lo) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, blobs], [*kept, "blob"])

    def settle(table: pa.Table) -> pa.Table:
        component, node = (table.column(c).to_numpy() for c in ("component", "node"))
        blobs, out = table.column("blob"), [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        order = np.lexsort((node, component))
        for _, lo, hi in slices(component[order]):
            members, first = np.unique(node[order[lo:hi]], return_index=True)
            found = [np.frombuffer(blobs[int(k)].as_py(), _U) for k in order[lo:hi][first]]
            out.append((members, members[_similar(found, similarity)]))
        members, group = (np.concatenate(x) for x in zip(*out))
        return pa.table({"node": members, "group": group})

    told = texts.select(place, "component", "node", "text").mapInArrow(sets, "place long, component long, node long, blob binary")
    groups = materialize(told.groupBy("place").applyInArrow(settle, "node long, group long"), "groups")
    return rows.join(groups, "node", "left").select("id", "copy", F.coalesce("group", "node").alias("group"))


def _near_by_fingerprint(nodes: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join all nodes within ``FAR_BITS`` whose other SimHashes and sizes do not speak against it.

    Nodes are classed by the size of their set, so that similar ones lie in one class or in two next to each other;
    each class in blocks, and each block meets those of its class and of the next. Links are thinned to a
    spanning forest in each place.
    """
    step = float(np.log(max(1 / similarity, 1.25)))
    classed = nodes.select("node", "fp", "wide", F.floor(F.log("size") / step).cast("int").alias("class"))
    blocks = {r["class"]: r["count"] // BLOCK_NODES + 1 for r in classed.groupBy("class").count().collect()}

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, fp = (batch.column(c).to_numpy().view(_U) for c in ("node", "fp"))
            wide = np.frombuffer(b"".join(batch.column("wide").to_pylist()), _U).reshape(-1, WIDE)
            packed = np.column_stack([node, fp, wide])
            kind = batch.column("class").to_numpy().astype(np.int64)
            block = (mix(node) % np.array([blocks[k] for k in kind.tolist()], _U)).astype(np.int64)
            order = np.lexsort((block, kind))
            out = []
            for _, lo, hi in slices((kind * (1 << 32) + block)[order]):
                c, b, blob = int(kind[order[lo]]), int(block[order[lo]]), packed[order[lo:hi]].tobytes()
                # What is asked: blocks of the class from this one on, and all of the next class.
                out += [(f"{c} {other} {c} {b}", 1, blob) for other in range(b, blocks[c])]
                out += [(f"{c + 1} {other} {c} {b}", 1, blob) for other in range(blocks.get(c + 1, 0))]
                out += [(f"{c} {b} {c} {other}", 0, blob) for other in range(b + 1)]
                out += [(f"{c} {b} {c - 1} {other}", 0, blob) for other in range(blocks.get(c - 1, 0))]
            yield pa.RecordBatch.from_pydict(
                {"place": [r[0] for r in out], "asks": pa.array([r[1] for r in out], pa.int32()), "blob": [r[2] for r in out]}
            )

    def meet(table: pa.Table) -> pa.Table:
        asks, sides = table.column("asks").to_numpy(), []
        for side in (0, 1):
            some = [table.column("blob")[int(k)].as_py() for k in np.nonzero(asks == side)[0]]
            sides.append(np.frombuffer(b"".join(some), _U).reshape(-1, 2 + WIDE))
        own, asking = sides
        a, b = [np.zeros(0, _U)], [np.zeros(0, _U)]
        for mine, theirs in near_pairs(np.ascontiguousarray(own[:, 1]), np.ascontiguousarray(asking[:, 1]), FAR_BITS):
            apart = np.bitwise_count(asking[mine, 2:] ^ own[theirs, 2:]).sum(1)
            near = (apart <= WIDE_BITS) & (asking[mine, 0] != own[theirs, 0])
            member, root = spanning_stars(asking[mine[near], 0], own[theirs[near], 0])
            a.append(member)
            b.append(root)
        member, root = spanning_stars(np.concatenate(a), np.concatenate(b))
        return pa.table({"a": member.view(np.int64), "b": root.view(np.int64)})

    asked = classed.mapInArrow(ask, "place string, asks int, blob binary")
    return asked.groupBy("place").applyInArrow(meet, "a long, b long")


def _candidates(key: np.ndarray, node: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all nodes of a key that are near by SimHash: to its first node, or to others."""
    order = np.lexsort((node, key))
    key, node, fp = key[order], node[order], fp[order]
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    head = np.repeat(first, count)
    near = np.bitwise_count(fp ^ fp[head]) <= NEAR_BITS
    a, b = [node[near]], [node[head[near]]]
    for lo in np.unique(head[~near]).tolist():
        some = slice(lo, lo + int(count[np.searchsorted(first, lo)]))
        mine = fp[some]
        label = reach(len(mine), lambda k, others: np.bitwise_count(mine[k] ^ mine[others]) <= NEAR_BITS)
        a.append(node[some])
        b.append(node[some][label])
    return np.concatenate(a), np.concatenate(b)


def _similar(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Components of the links between sets of at least that similarity, which is exact."""
    size = np.array([len(s) for s in sets])
    codes, code = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(code, kind="stable")
    holder = np.repeat(np.arange(len(sets)), size)[order]
    edges = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(codes)))])
    mine = np.split(code, np.cumsum(size)[:-1])

    def near(k: int, others: np.ndarray) -> np.ndarray:
        held = ranges(edges[mine[k]], edges[mine[k] + 1] - edges[mine[k]])
        both = np.bincount(holder[held], minlength=len(sets))[others]
        return both >= similarity * (size[k] + size[others] - both) - 1e-9

    return reach(len(sets), near)
