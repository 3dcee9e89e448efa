"""Nearest vectors by inner product: a vantage-point tree for each shard.

Largest inner product becomes smallest distance by one more component: with ``M`` the longest
length of all, a vector ``x`` becomes ``(x, sqrt(M² - |x|²))`` and a query ``(q, 0)``; then
``|q - x|² = |q|² + M² - 2 q·x``. Distances obey the triangle inequality, so a tree that
splits vectors by their distance to a vantage point can leave out a side when the query is
further from the split than from its worst neighbour so far. ``factor`` relaxes that test:
with 1 the search is exact, with less it leaves out more.

A shard (a hash of the id) grows with the square root of the table, and so does the number
of shards: neither a tree nor the number of times the queries are sent gets out of hand. The
trees are stored; queries come by in blocks, and a block walks a tree as one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knockwatch.llm.store import cut

NEIGHBOURS = 20
FACTOR = 1.0
LEAF = 128
#: A shard has about so many times the square root of the number of vectors.
SHARD_ROOTS = 16
QUERY_BLOCK = 1024
_ROOM = 1e-9  # relative; a bound is a sum in another order than the distance it bounds


# ---------------------------------------------------------------- one tree


@dataclass
class Tree:
    """Vectors in the order of a vantage-point tree. Node ``i`` covers ``low[i]`` to ``high[i]``
    and has its vantage point first; ``near[i]`` and ``far[i]`` are its sides (-1: a leaf)."""

    ids: np.ndarray  # of the distinct vectors' copies, each list ascending
    copies: np.ndarray  # where each vector's ids begin, and the end
    vectors: np.ndarray  # (vector, component) doubles, the lifting component last
    split: np.ndarray
    nodes: np.ndarray  # (node, [low, high, near, far])

    def candidates(self, queries: np.ndarray, k: int, factor: float = FACTOR) -> tuple[list[np.ndarray], int]:
        """For each query (lifted) the vectors that may be among its ``k`` nearest, and how many distances that took."""
        search = _Search(self, queries, k, factor)
        if len(self.nodes):
            search.visit(0, np.arange(len(queries)))
        return search.found(), search.looked


class _Search:
    def __init__(self, tree: Tree, queries: np.ndarray, k: int, factor: float):
        self.tree, self.queries, self.k, self.factor = tree, queries, k, factor
        self.squares = (queries**2).sum(axis=1)
        self.points = (tree.vectors**2).sum(axis=1)
        # squared distances of the k nearest so far, the worst last, and their vectors
        self.best = np.full((len(queries), k), np.inf)
        self.which = np.full((len(queries), k), -1, dtype=np.int64)
        self.looked = 0
        self.weights = np.diff(tree.copies)

    def _squared(self, which: np.ndarray, low: int, high: int) -> np.ndarray:
        self.looked += len(which) * (high - low)
        inner = self.queries[which] @ self.tree.vectors[low:high].T
        return np.maximum(self.squares[which, None] + self.points[None, low:high] - 2 * inner, 0)

    def _keep(self, which: np.ndarray, low: int, distances: np.ndarray) -> None:
        every = np.concatenate((self.best[which], distances), axis=1)
        numbers = np.concatenate((self.which[which], np.broadcast_to(np.arange(low, low + distances.shape[1]), distances.shape)), axis=1)
        order = np.argpartition(every, self.k - 1, axis=1)[:, : self.k]
        kept = np.take_along_axis(every, order, axis=1)
        inner = np.argsort(kept, axis=1, kind="stable")
        self.best[which] = np.take_along_axis(kept, inner, axis=1)
        self.which[which] = np.take_along_axis(np.take_along_axis(numbers, order, axis=1), inner, axis=1)

    def visit(self, node: int, which: np.ndarray) -> None:
        """All of ``which`` (queries) look into a node; each takes the nearer side first."""
        if not len(which):
            return
        low, high, near, far = self.tree.nodes[node]
        if near < 0:
            self._keep(which, low, self._squared(which, low, high))
            return
        squared = self._squared(which, low, low + 1)
        self._keep(which, low, squared)
        away = np.sqrt(squared[:, 0]) - self.tree.split[node]
        inside = away <= 0
        self.visit(near, which[inside])
        self.visit(far, which[~inside])
        reach = self.factor * np.sqrt(self.best[which, -1]) * (1 + _ROOM) + _ROOM
        cross = np.abs(away) <= reach
        self.visit(far, which[inside & cross])
        self.visit(near, which[~inside & cross])

    def found(self) -> list[np.ndarray]:
        return [w[w >= 0] for w in self.which]


def distinct_vectors(ids: np.ndarray, vectors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct vectors, and of each the ids of its first ``most`` copies: further copies lose every tie."""
    vectors = vectors + 0.0  # no negative zeros
    order = np.lexsort((ids, *vectors.T[::-1]))
    ids, vectors = ids[order], vectors[order]
    new = np.concatenate(([True], (vectors[1:] != vectors[:-1]).any(axis=1)))
    first = np.flatnonzero(new)
    place = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
    kept = place < most
    starts = np.append(np.flatnonzero(new[kept]), kept.sum())
    return vectors[first], ids[kept], starts


def build(ids: np.ndarray, vectors: np.ndarray, longest: float, most_copies: int) -> Tree:
    """The tree of a shard; ``longest`` is the greatest length of any vector of the table."""
    if not len(ids):
        return Tree(ids, np.zeros(1, dtype=np.int64), np.zeros((0, 1)), np.zeros(0), np.zeros((0, 4), dtype=np.int64))
    plain, ids, starts = distinct_vectors(ids, vectors.astype(np.float64), most_copies)
    lift = np.sqrt(np.maximum(longest**2 - (plain**2).sum(axis=1), 0))
    lifted = np.concatenate((plain, lift[:, None]), axis=1)
    order = np.arange(len(lifted))
    rng = np.random.default_rng(13)
    nodes, splits = [], []

    def grow(low: int, high: int) -> int:
        number = len(nodes)
        nodes.append([low, high, -1, -1])
        splits.append(0.0)
        if high - low <= LEAF:
            return number
        at = low + int(rng.integers(high - low))
        order[[low, at]] = order[[at, low]]
        rest = order[low + 1 : high]
        away = np.sqrt(((lifted[rest] - lifted[order[low]]) ** 2).sum(axis=1))
        half = len(rest) // 2
        inner = np.argpartition(away, half)
        order[low + 1 : high] = rest[inner]
        splits[number] = float(away[inner[half]])
        # the near side has distances up to the split, the far side from the split on
        middle = low + 1 + half
        nodes[number][2] = grow(low + 1, middle)
        nodes[number][3] = grow(middle, high)
        return number

    grow(0, len(order))
    sizes = np.diff(starts)[order]
    picked = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in order])
    return Tree(ids[picked], np.concatenate(([0], np.cumsum(sizes))), lifted[order], np.array(splits), np.array(nodes, dtype=np.int64))


# ---------------------------------------------------------------- trees and queries as tables

TREES = "shard int, ids binary, copies binary, vectors binary, split binary, nodes binary"


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles), one row for each id: without null ids, and without vectors that are null,
    empty, zero or hold a null or a number that is not finite. Of several vectors with one id the smallest counts."""
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    valid = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    kept = vectors.filter(F.col("vec_id").isNotNull() & valid & some)
    return kept.groupBy("vec_id").agg(F.min(numbers).alias("embedding"))


def _stacked(values: pd.Series, size: int) -> np.ndarray:
    return np.concatenate([np.asarray(v, dtype=np.float64) for v in values]).reshape(-1, size) if len(values) else np.zeros((0, size))


def trees(vectors: DataFrame, shards: int, longest: float, size: int, most_copies: int) -> DataFrame:
    """One row for each shard of ``usable`` vectors with ``size`` components: its tree, as bytes."""

    def grown(table: pd.DataFrame) -> pd.DataFrame:
        tree = build(table["vec_id"].to_numpy(), _stacked(table["embedding"], size), longest, most_copies)
        row = {
            "shard": [table["shard"].iloc[0]], "ids": [tree.ids.astype("<i8").tobytes()],
            "copies": [tree.copies.astype("<i8").tobytes()], "vectors": [tree.vectors.astype("<f8").tobytes()],
            "split": [tree.split.astype("<f8").tobytes()], "nodes": [tree.nodes.astype("<i8").tobytes()],
        }
        return pd.DataFrame(row)

    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard")
    return vectors.select(shard, "vec_id", "embedding").groupBy("shard").applyInPandas(grown, TREES)


def _tree(row, size: int) -> Tree:
    return Tree(
        np.frombuffer(row.ids, dtype="<i8"),
        np.frombuffer(row.copies, dtype="<i8"),
        np.frombuffer(row.vectors, dtype="<f8").reshape(-1, size + 1),
        np.frombuffer(row.split, dtype="<f8"),
        np.frombuffer(row.nodes, dtype="<i8").reshape(-1, 4),
    )


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of rows, added up component by component, as a plain loop would."""
    total = np.zeros(len(queries))
    for i in range(queries.shape[1]):
        total += queries[:, i] * vectors[:, i]
    return total


def search_tree(tree: Tree, ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """``query_id, vec_id, score`` of the ``k`` nearest in one tree to each query (its own id left out), and the distances looked at."""
    lifted = np.concatenate((queries, np.zeros((len(queries), 1))), axis=1)
    # one more, for the query itself
    found, looked = tree.candidates(lifted, k + 1, factor)
    rows = np.repeat(np.arange(len(queries)), [len(f) for f in found])
    vectors = np.concatenate(found) if len(found) else np.zeros(0, dtype=np.int64)
    scores = _products(queries[rows], tree.vectors[vectors, :-1])
    times = np.diff(tree.copies)[vectors]
    rows, scores = np.repeat(rows, times), np.repeat(scores, times)
    at = np.concatenate([np.arange(tree.copies[v], tree.copies[v + 1]) for v in vectors]) if len(vectors) else vectors
    near = tree.ids[at] if len(at) else np.zeros(0, dtype=np.int64)
    other = near != ids[rows]
    rows, scores, near = rows[other], scores[other], near[other]
    order = np.lexsort((near, -scores, rows))
    rows, scores, near = rows[order], scores[order], near[order]
    first = np.searchsorted(rows, np.arange(len(queries)))
    kept = np.arange(len(rows)) - first[rows] < k
    return ids[rows[kept]], near[kept], scores[kept], looked


def nearest(
    vectors: DataFrame, is_query, k: int = NEIGHBOURS, factor: float = FACTOR, shard_roots: int = SHARD_ROOTS
) -> DataFrame:
    """The ``k`` nearest other vectors of each query: ``query_id, rank, vec_id, score``.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` is a condition on ``vec_id``.
    Ranks count from 1, ties go to the smaller ``vec_id``; a query with fewer candidates has
    fewer rows. Vectors that are null, zero or hold a null or a number that is not finite take
    no part, nor do rows without an id; an id names one vector (the smallest of several);
    vectors of unlike length do not meet. An empty table gives no rows. Other columns are not
    looked at. ``factor`` 1 is exact.
    """
    known = cut(usable(vectors).withColumn("size", F.size("embedding")))
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    parts = []
    for size, rows, longest in sorted(tuple(r) for r in known.groupBy("size").agg(F.count(F.lit(1)), F.max(length)).collect()):
        mine = known.filter(F.col("size") == size)
        shards = max(1, int(np.ceil(np.sqrt(rows) / shard_roots)))
        parts.append(_nearest_of_size(mine, is_query, k, factor, shards, float(longest), size))
    found = parts[0] if parts else known.sparkSession.createDataFrame([], "query_id long, vec_id long, score double")
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _nearest_of_size(vectors: DataFrame, is_query, k: int, factor: float, shards: int, longest: float, size: int) -> DataFrame:
    index = cut(trees(vectors, shards, longest, size, most_copies=k + 1))

    def blocked(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in tables:
            for at in range(0, len(table), QUERY_BLOCK):
                some = table.iloc[at : at + QUERY_BLOCK]
                yield pd.DataFrame(
                    {"ids": [some["vec_id"].to_numpy().astype("<i8").tobytes()], "queries": [_stacked(some["embedding"], size).tobytes()]}
                )

    blocks = vectors.filter(is_query).select("vec_id", "embedding").mapInPandas(blocked, "ids binary, queries binary")
    every = F.sequence(F.lit(0), F.lit(shards - 1))
    sent = cut(blocks).select(F.explode(every).alias("shard"), F.lit(1).alias("kind"), "ids", "queries")
    empty = F.lit(None).cast("binary")
    tree = index.withColumns({"kind": F.lit(0), "queries": empty})
    both = tree.unionByName(sent, allowMissingColumns=True)

    def searched(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, shard = None, None
        for table in tables:
            for row in table.itertuples(index=False):
                if row.kind == 0:
                    tree, shard = _tree(row, size), row.shard
                elif row.shard == shard:
                    ids = np.frombuffer(row.ids, dtype="<i8")
                    queries = np.frombuffer(row.queries, dtype="<f8").reshape(-1, size)
                    query_id, vec_id, score, _ = search_tree(tree, ids, queries, k, factor)
                    yield pd.DataFrame({"query_id": query_id, "vec_id": vec_id, "score": score})

    # a tree comes before the blocks of queries of its shard; both are read as a stream
    in_order = both.repartition("shard").sortWithinPartitions("shard", "kind")
    return in_order.mapInPandas(searched, "query_id long, vec_id long, score double")
