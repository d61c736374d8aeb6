"""Merkle manifest of a table: a tree per group, one tree over their roots, and a proof per row.

A leaf is the hash of the row's fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its
value. Leaves ascend by id within their group (ties by hash, so rows that are copies of each other are
interchangeable); every run of ``arity`` nodes becomes the hash of their hex digests until one is left.
The subroots, by group (null first), give the root in the same way.

A stored level spans several hash levels, at most ``BLOCK`` nodes to a parent: its rows link a node to
its parent and hold the siblings on the way there. Blocks are cut by place, so a group of any size is
never held in one place. The climb is a recursive query: a leaf starts with its own row, and each step joins
the row of the node it stands on, appends that row's siblings, folds the hash through them and goes on from the
parent. Nodes that more than a block of leaves come by are few; each lies in ``LANES`` places, and a leaf has
its lane.

Null ids come first. An empty table has no root and gives no rows. Texts of any length are hashed
where they are read and go no further.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.operators.joins import BROADCAST_BYTES, text_bytes
from ledgerline.operators.numbering import number_rows
from ledgerline.session import materialize

ARITY = 2
BLOCK = 1024  # nodes that share a stored parent, at most
LANES = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"
_PATH = "array<struct<before: array<binary>, after: array<binary>>>"


@dataclass
class Manifest:
    """The tree as tables, and its root.

    ``leaves``: ``id``, ``leaf``, ``changed``, ``lane``, the ``node`` above and the ``path`` there. ``nodes``: ``node``
    and ``spot``, ``parent`` and the ``path`` there, and the ``subroot`` if the node is one. ``root`` is hex, None if empty.
    """

    leaves: DataFrame
    nodes: DataFrame
    root_node: str | None
    root: str | None


def field_text(value: Column) -> Column:
    """How a field enters the hash of its row."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field_text(v) for v in values]), 256))


def manifest(
    rows: DataFrame,
    id: str = "doc_id",
    group: str = "lang",
    fields: Sequence[str] = FIELDS,
    changed: Sequence[Column] | None = None,
    arity: int = ARITY,
) -> Manifest:
    """The tree over ``rows``, as tables in the shared folder.

    ``changed`` gives the field values of another version of each row, whose leaf is kept beside the
    true one and takes no part in the tree.
    """
    leaf = leaf_hash([F.col(f) for f in fields]).alias("hash")
    other = (leaf_hash(changed) if changed is not None else leaf).alias("changed")
    hashed = rows.select(F.col(id).alias("id"), F.col(group).cast("string").alias("tree"), leaf, other)
    # Written first: what follows sorts and numbers these few bytes a row.
    hashed = materialize(hashed, "merkle-leaves")
    numbered = number_rows(hashed, ["id", "hash", "changed"], ["tree"], "place").withColumn("place", F.col("place") - 1)
    sizes = hashed.groupBy("tree").agg(F.count(F.lit(1)).alias("size"))
    if text_bytes(sizes) <= BROADCAST_BYTES:
        sizes = F.broadcast(sizes)
    sized = numbered.alias("n").join(sizes.alias("s"), F.col("n.tree").eqNullSafe(F.col("s.tree")))
    kept = F.struct("id", "changed", F.pmod("place", F.lit(LANES)).cast("int").alias("lane")).alias("kept")
    rows = sized.select("n.tree", "place", "hash", "size", _node("g", 0, F.col("place"), F.col("n.tree")), kept)
    below, nodes, subroots = _levels(rows, "g", arity)
    leaves = below.select("kept.id", F.col("hash").alias("leaf"), "kept.changed", "kept.lane", "node", "path")
    if subroots is None:
        return Manifest(leaves, nodes, None, None)
    subroots = materialize(number_rows(subroots, ["tree"], name="place", unique=True), "merkle-subroots")
    over = subroots.select(
        F.lit(None).cast("string").alias("tree"),
        (F.col("place") - 1).alias("place"),
        "hash",
        F.lit(subroots.count()).alias("size"),
        "node",
        F.struct("node", "dealt").alias("kept"),
    )
    first, above, last = _levels(over, "t", arity)
    first = first.where("kept.node <> node").select(
        "kept.node", "kept.dealt", F.col("node").alias("parent"), "path", F.col("hash").alias("subroot")
    )
    linked = nodes.unionByName(above).withColumn("subroot", F.lit(None).cast("binary")).unionByName(first)
    lanes = F.when(F.col("dealt"), F.sequence(F.lit(1), F.lit(LANES))).otherwise(F.array(F.lit(0)))
    linked = linked.select("node", F.explode(lanes).alias("spot"), "parent", "path", "subroot")
    top = last.first()  # one row
    return Manifest(leaves, materialize(linked, "merkle-nodes"), top["node"], bytes(top["hash"]).hex())


def prove(tree: Manifest) -> DataFrame:
    """Per leaf: ``id``, ``leaf``, ``subroot``, ``root``, its ``siblings`` from below, and the hash that the changed leaf folds to.

    Digests are binary. The recursive query is run here and its result written, since its limit of rows
    is a setting of the session, which is put back.
    """
    spark = tree.leaves.sparkSession
    if tree.root is None:
        return tree.leaves.selectExpr(
            "id", "leaf", "leaf AS subroot", "leaf AS root", "array(leaf) AS siblings", "changed AS folded"
        )
    leaves, nodes = (f"merkle_{name}_{uuid.uuid4().hex}" for name in ("leaves", "nodes"))
    tree.leaves.createOrReplaceTempView(leaves)
    tree.nodes.createOrReplaceTempView(nodes)
    hint = "/*+ BROADCAST(n) */" if text_bytes(tree.nodes) <= BROADCAST_BYTES else ""
    siblings = "flatten(transform({0}, s -> concat(s.before, s.after)))"
    folded = "aggregate({0}, {1}, (h, s) -> " + _joined("concat(s.before, array(h), s.after)") + ")"
    before = spark.conf.get(_ROW_LIMIT, None)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        climbed = spark.sql(
            f"""
            WITH RECURSIVE climb (id, leaf, lane, node, spot, subroot, siblings, folded) AS (
                SELECT id, leaf, lane, node, 0, cast(NULL AS binary),
                       {siblings.format("path")}, {folded.format("path", "changed")}
                FROM {leaves}
                UNION ALL
                SELECT {hint} c.id, c.leaf, c.lane, n.parent, c.lane + 1, coalesce(c.subroot, n.subroot),
                       concat(c.siblings, {siblings.format("n.path")}), {folded.format("n.path", "c.folded")}
                FROM climb c JOIN {nodes} n ON c.node = n.node AND c.spot = n.spot
            )
            SELECT id, leaf, coalesce(subroot, unhex('{tree.root}')) AS subroot, unhex('{tree.root}') AS root, siblings, folded
            FROM climb WHERE node = {_quoted(tree.root_node)}
            """
        )
        return materialize(climbed, "merkle-proofs")
    finally:
        spark.conf.unset(_ROW_LIMIT) if before is None else spark.conf.set(_ROW_LIMIT, before)
        spark.catalog.dropTempView(leaves)
        spark.catalog.dropTempView(nodes)


def check_documents(docs: DataFrame, tampered: Column, arity: int = ARITY) -> DataFrame:
    """The manifest of ``docs`` and whether each row, ``n_chars`` one more where ``tampered``, still leads to the root."""
    more = F.when(F.coalesce(tampered, F.lit(False)), F.col("n_chars").cast("decimal(20,0)") + 1)
    n_chars = F.coalesce(more, F.col("n_chars").cast("decimal(20,0)"))
    changed = [n_chars if f == "n_chars" else F.col(f) for f in FIELDS]
    proofs = prove(manifest(docs.select(*FIELDS), changed=changed, arity=arity))
    hexed = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "folded")}
    return proofs.select(
        F.col("id").alias("doc_id"),
        hexed["leaf"].alias("leaf"),
        hexed["subroot"].alias("subroot"),
        hexed["root"].alias("root"),
        F.sha2(F.array_join(F.transform("siblings", lambda h: F.lower(F.hex(h))), ""), 256).alias("proof_sha256"),
        hexed["folded"].alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def _node(kind: str, level: int, place: Column, tree: Column) -> Column:
    """The name of a node: no two have the same, since its numbers come first."""
    name = F.concat(F.lit(f"{kind}{level}."), place.cast("string"))
    return F.coalesce(F.concat(name, F.lit("."), tree.cast("string")), name).alias("node")


def _quoted(text: str) -> str:
    return f"decode(unhex('{text.encode().hex()}'), 'UTF-8')"


def _joined(hashes: str) -> str:
    """SQL for the hash of an array of digests, written as hex one after the other."""
    return f"unhex(sha2(array_join(transform({hashes}, x -> lower(hex(x))), ''), 256))"


def _levels(rows: DataFrame, kind: str, arity: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The tree over ``rows`` (tree, place, hash, size, node, kept).

    The rows again, with the ``path`` up and ``node`` as the node it leads to; the linked nodes above them (``dealt``:
    more than a block of rows come by); and the last node of each tree. As many rounds as the largest
    tree has stored levels; each is written and an ``arity``-to-``BLOCK`` part of the one below.
    """
    steps = max(1, next(n for n in range(64) if arity ** (n + 1) > BLOCK))
    block = arity**steps
    # Trees of one row: no path, and the row is the last node.
    lone = rows.where("size = 1").withColumn("path", F.expr(f"cast(array() AS {_PATH})"))
    start, links, tops = [lone.select("hash", "kept", "node", "path")], [], []
    tops.append(lone.select("tree", "node", "hash", F.lit(False).alias("dealt")))
    largest = rows.agg(F.max("size")).first()[0]
    level = 0
    while largest is not None and largest > 1:
        level += 1
        built = materialize(_blocks(rows.where("size > 1"), kind, level, arity, steps), "merkle-level")
        if level == 1:
            start.append(built.select("hash", "kept", F.col("parent").alias("node"), "path"))
        else:
            links.append(built.select("node", "parent", "path", F.lit(kind == "t" or level > 2).alias("dealt")))
        rows = built.where(F.col("place") % block == 0).select(
            "tree",
            F.floor(F.col("place") / block).cast("long").alias("place"),
            F.col("up").alias("hash"),
            F.ceil(F.col("size") / block).cast("long").alias("size"),
            F.col("parent").alias("node"),
            F.lit(None).alias("kept"),
        )
        tops.append(rows.where("size = 1").select("tree", "node", "hash", F.lit(level > 1).alias("dealt")))
        largest = -(-largest // block)
    if not links:
        links = [lone.where("false").select("node", F.col("node").alias("parent"), "path", F.lit(False).alias("dealt"))]
    nodes = reduce(DataFrame.union, links)
    return reduce(DataFrame.union, start), nodes, reduce(DataFrame.union, tops) if largest is not None else None


def _blocks(rows: DataFrame, kind: str, level: int, arity: int, steps: int) -> DataFrame:
    """Each node with its parent ``steps`` hash levels up (fewer where the tree ends), that hash, and the path there."""
    block = arity**steps
    above = F.floor(F.col("place") / block).cast("long")
    grouped = rows.groupBy("tree", above.alias("above")).agg(
        F.max("size").alias("size"),
        F.sort_array(F.collect_list(F.struct("place", F.struct("node", "hash", "kept").alias("is")))).alias("members"),
    )
    held = grouped.withColumn("l0", F.col("members.is.hash"))
    path = []
    for j in range(steps):
        fold = _joined(f"slice(l{j}, cast(i * {arity} + 1 AS int), {arity})")
        there = f"size > {arity**j}"  # else one node is left, and it is the parent
        up = f"transform(sequence(0, (size(l{j}) - 1) div {arity}), i -> {fold})"
        held = held.withColumn(f"l{j + 1}", F.expr(f"CASE WHEN {there} THEN {up} ELSE l{j} END"))
        at = f"cast(k div {arity**j} AS int)"
        first = f"({at} - {at} % {arity})"
        step = (
            f"named_struct('before', slice(l{j}, {first} + 1, {at} - {first}), "
            f"'after', slice(l{j}, {at} + 2, {first} + {arity} - 1 - {at}))"
        )
        path.append(f"CASE WHEN {there} THEN {step} END")
    member = (
        "transform(members, (m, k) -> named_struct('place', m.place, 'is', m.is, 'path', "
        f"filter(array({', '.join(path)}), s -> s IS NOT NULL)))"
    )
    each = held.select("tree", "above", "size", F.col(f"l{steps}")[0].alias("up"), F.explode(F.expr(member)).alias("m"))
    parent = _node(kind, level, F.col("above"), F.col("tree")).alias("parent")
    return each.select("tree", "m.place", "size", "m.is.node", "m.is.hash", "m.is.kept", parent, "up", "m.path")
