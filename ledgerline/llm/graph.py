"""Connected components of links, by joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ledgerline.session import materialize


def spanning_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components: each node but the smallest of its component, and that smallest."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], least)
        np.minimum.at(label, label[right], least)
        np.minimum.at(label, left, least)
        np.minimum.at(label, right, least)
        label = label[label]
        if (label == before).all():
            break
    member = np.nonzero(label != np.arange(len(nodes)))[0]
    return nodes[member], nodes[label[member]]


def components(links: DataFrame) -> DataFrame:
    """Columns ``node`` and ``component`` (the smallest node reached) for every node of ``links`` (a, b).

    Large-star and small-star rounds: links are turned towards the smallest neighbour until each
    node has one link, to the smallest of its component. A round takes minima by partial
    aggregation and joins them back, so a node with any number of links is never held as a group.
    Each round is written. Self-links, repeated and reversed links do no harm.
    """
    turned = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links, state = _written(turned.distinct())
    while True:
        links, after = _written(_small_star(_large_star(links)))
        if after == state:
            break
        state = after
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _written(links: DataFrame) -> tuple[DataFrame, tuple]:
    links = materialize(links, "links")
    total = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return links, tuple(total)


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest neighbour instead."""
    both = links.union(links.select("b", "a")).toDF("node", "other")
    least = both.groupBy("node").agg(F.least("node", F.min("other")).alias("least"))
    turned = both.where("other > node").join(least, "node")
    return turned.select(F.col("other").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them; in ``links`` a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    others = links.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.union(least).toDF("a", "b").distinct()
