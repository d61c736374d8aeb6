"""Nearest neighbours by largest inner product, with vantage-point trees per shard.

Inner products become distances by one more component: with M the largest norm, (x, sqrt(M^2 - |x|^2))
and (q, 0) are closest where q.x is largest. Each shard builds a tree: a node has a vantage point,
halves its points by their distance to it, and knows the least and largest distance of each half.
By the triangle inequality a half holds nothing nearer than the gap between the query's
distance and that interval. A half is skipped if ``factor`` times the gap reaches the distance of
the best so far: factor one never loses a neighbour and is the default. A larger one skips more and may,
by far too many where norms differ, since distances grow with M.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.llm.lattice import _vectors, usable_vector
from ledgerline.session import materialize, ship_package

K = 20
FACTOR = 1.0
SHARD_ROWS = 8_192
QUERY_ROWS = 32_768  # queries that one task answers
LEAF = 64
QUERY_BLOCK = 2_048


class Tree:
    """A vantage-point tree over rows of ``points``; leaves hold row numbers."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> int:
        if len(rows) <= LEAF:
            self.nodes.append((None, rows))
            return len(self.nodes) - 1
        points = self.points[rows]
        # The point farthest from another is a good vantage point, and the same in every run.
        vantage = points[((points - points[0]) ** 2).sum(1).argmax()]
        distance = np.sqrt(((points - vantage) ** 2).sum(1))
        order = np.argsort(distance, kind="stable")
        halves = order[: len(rows) // 2], order[len(rows) // 2 :]
        bounds = [(distance[h].min(), distance[h].max()) for h in halves]
        children = [self._build(rows[h]) for h in halves]
        self.nodes.append((vantage, children, bounds))
        return len(self.nodes) - 1


class Search:
    """Best ``k`` rows of a tree for each query, by inner product, ties to the smaller ``rank``."""

    def __init__(self, tree: Tree, vectors: np.ndarray, rank: np.ndarray, largest: float, k: int, factor: float) -> None:
        self.tree, self.vectors, self.rank, self.factor = tree, vectors, rank, factor
        self.largest, self.k = largest, k

    def run(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and rows, best first; row -1 where there are fewer than k."""
        self.queries = queries
        self.norm = (queries * queries).sum(1)
        self.flat = np.hstack([queries, np.zeros((len(queries), 1))])
        self.scores = np.full((len(queries), self.k), -np.inf)
        self.rows = np.full((len(queries), self.k), -1)
        self.home = np.full(len(queries), -1)
        everyone = np.arange(len(queries))
        self._descend(self.tree.root, everyone)
        self._visit(self.tree.root, everyone)
        return self.scores, self.rows

    def _distance(self, active: np.ndarray, vantage: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.norm[active] + vantage @ vantage - 2 * self.flat[active] @ vantage, 0))

    def _gaps(self, node: tuple, active: np.ndarray) -> list[np.ndarray]:
        d = self._distance(active, node[0])
        return [np.maximum(np.maximum(lo - d, d - hi), 0) for lo, hi in node[2]]

    def _descend(self, at: int, active: np.ndarray) -> None:
        """Each query goes to the leaf it would be in, for a first bound."""
        node = self.tree.nodes[at]
        if node[0] is None:
            self.home[active] = at
            self._improve(active, node[1])
            return
        inner, outer = self._gaps(node, active)
        for child, some in zip(node[1], (active[inner <= outer], active[inner > outer])):
            if len(some):
                self._descend(child, some)

    def _visit(self, at: int, active: np.ndarray) -> None:
        node = self.tree.nodes[at]
        if node[0] is None:
            active = active[self.home[active] != at]
            if len(active):
                self._improve(active, node[1])
            return
        for child, gap in zip(node[1], self._gaps(node, active)):
            worst = self.norm[active] + self.largest**2 - 2 * self.scores[active, -1]
            # A little more than the bound, since both sides are rounded and ties must be seen.
            some = active[(gap * self.factor) ** 2 <= np.maximum(worst, 0) * (1 + 1e-9) + 1e-12]
            if len(some):
                self._visit(child, some)

    def _improve(self, active: np.ndarray, rows: np.ndarray) -> None:
        found = self.queries[active] @ self.vectors[rows].T
        hopeful = (found >= self.scores[active, -1][:, None]).any(1)
        active, found = active[hopeful], found[hopeful]
        scores = np.hstack([self.scores[active], found])
        names = np.hstack([self.rows[active], np.broadcast_to(rows, found.shape)])
        rank = np.where(names < 0, np.iinfo(np.int64).max, self.rank[names])
        best = np.lexsort((rank, -scores), axis=1)[:, : self.k]
        self.scores[active] = np.take_along_axis(scores, best, 1)
        self.rows[active] = np.take_along_axis(names, best, 1)


def nearest(
    table: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = K,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the k nearest rows of each query.

    Queries are the rows where ``is_query``, candidates all rows but the query's own. Every row is
    indexed; with factor one the answer is exact. Vectors that are null, zero or hold a null or a value
    that is not finite take no part, nor do rows without id; vectors of another length are no
    candidates. Equal vectors are indexed once, with as many of their ids as an answer can hold.
    Ties go to the smaller id. Rows that share an id are candidates once each, but not their own.
    """
    spark = table.sparkSession
    ship_package(spark)
    vector = F.col(vector_column).cast("array<double>")
    rows = table.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector"), is_query.alias("asks"))
    rows = rows.where(usable_vector("vector") & F.col("id").isNotNull())
    rows = rows.withColumn("vector", F.transform("vector", lambda v: v + F.lit(0.0))).withColumn("dim", F.size("vector"))
    first = Window.partitionBy("dim", "vector").orderBy("id")
    copies = rows.withColumn("copy", F.row_number().over(first)).where(F.col("copy") <= k + 1)
    classes = copies.groupBy("dim", "vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = materialize(classes, "classes")
    norm = F.aggregate("vector", F.lit(0.0), lambda a, v: a + v * v)
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("square")).first()
    queries = materialize(rows.where(F.col("asks")).select("id", "dim", "vector"), "queries")
    shards = (size["n"] or 0) // shard_rows + 1
    groups = queries.count() // QUERY_ROWS + 1
    largest = float(size["square"] or 0.0) ** 0.5

    def spread(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    indexed = classes.select(
        "dim", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"), spread(groups).alias("group"), "vector", "ids"
    )
    asked = queries.select(
        "dim", spread(shards).alias("shard"), F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("group"), "id", "vector"
    )
    keys = ("dim", "shard", "group")

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        return _answers(left, right, largest, k, factor)

    met = indexed.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(answer, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _answers(left: pa.Table, right: pa.Table, largest: float, k: int, factor: float) -> pa.Table:
    found: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if left.num_rows and right.num_rows:
        left, right = left.combine_chunks(), right.combine_chunks()
        vectors, _ = _vectors(_whole(left.column("vector")))
        lists = _whole(left.column("ids"))
        counts = lists.value_lengths().to_numpy()
        ids, starts = lists.flatten().to_numpy(), np.cumsum(counts) - counts
        rest = np.sqrt(np.maximum(largest**2 - (vectors * vectors).sum(1), 0))
        tree = Tree(np.hstack([vectors, rest[:, None]]))
        search = Search(tree, vectors, ids[starts], largest, k + 1, factor)
        asked, _ = _vectors(_whole(right.column("vector")))
        askers = _whole(right.column("id")).to_numpy()
        for lo in range(0, len(asked), QUERY_BLOCK):
            found.append(_expand(search, asked[lo : lo + QUERY_BLOCK], askers[lo : lo + QUERY_BLOCK], ids, starts, counts, k))
    query, vec, score = (np.concatenate(x) for x in zip(*found))
    return pa.table({"query_id": query, "vec_id": vec, "score": score})


def _expand(search: Search, queries, askers, ids, starts, counts, k: int) -> tuple[np.ndarray, ...]:
    """The found vectors as rows with their ids, the k best of each query."""
    _, rows = search.run(queries)
    query, place = np.nonzero(rows >= 0)
    row = rows[query, place]
    score = (queries[query] * search.vectors[row]).sum(1)
    n = counts[row]
    query, score = np.repeat(query, n), np.repeat(score, n)
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    vec = ids[np.repeat(starts[row], n) + inside]
    other = vec != askers[query]
    query, score, vec = query[other], score[other], vec[other]
    order = np.lexsort((vec, -score, query))
    query, score, vec = query[order], score[order], vec[order]
    begin = np.searchsorted(query, query)
    best = np.arange(len(query)) - begin < k
    return askers[query[best]], vec[best], score[best]


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks)
