"""Exact top-k search by inner product with KD-trees per shard.

Points are dealt into shards of about ``SHARD_ROWS`` by a hash of their id. Each shard has a KD-tree:
median splits of the widest side, with tight bounding boxes. A tree is searched best first by the
greatest inner product that a box allows; boxes below the k-th score found so far are never opened.
Every query visits one shard first, and carries its k-th score from there to all others.

Queries travel in blocks of ``BLOCK``: a task has one tree and one block.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyalspan.llm.ship import let_go, ship
from loyalspan.session import materialise

SHARD_ROWS = 4096
BLOCK = 1024
LEAF = 128
EXACT = 2.0**53
LONG = np.iinfo(np.int64)


def matrix(vectors, width: int) -> np.ndarray:
    """Rows of ``width``; shorter vectors are filled with zeros. Floats while they stay exact."""
    rows = np.zeros((len(vectors), width), dtype=np.int64)
    for i, vector in enumerate(vectors):
        rows[i, : len(vector)] = vector
    return rows


class Tree:
    """Nodes in arrays; the points of a node are a range of the reordered points."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, rows: np.ndarray):
        order = np.arange(len(ids))
        self.first, self.last, self.left = [], [], []
        low, high, least = [], [], []
        waiting = [(0, len(ids), None)]
        while waiting:
            first, last, parent = waiting.pop()
            node = len(self.first)
            if parent is not None and self.left[parent] < 0:
                self.left[parent] = node
            part = order[first:last]
            box = points[part]
            low.append(box.min(axis=0) if len(part) else np.zeros(points.shape[1], dtype=np.int64))
            high.append(box.max(axis=0) if len(part) else np.zeros(points.shape[1], dtype=np.int64))
            least.append(ids[part].min() if len(part) else LONG.max)
            self.first.append(first)
            self.last.append(last)
            self.left.append(-1)
            if last - first > LEAF:
                half = (last - first) // 2
                if points.shape[1]:
                    wide = int((high[-1].astype(float) - low[-1]).argmax())
                    order[first:last] = part[np.argpartition(box[:, wide], half)]
                # The left child is taken from the pile first and so stands right behind its parent;
                # the right one is found through the end of the left one's subtree.
                waiting.append((first + half, last, node))
                waiting.append((first, first + half, node))
        self.ids, self.points, self.rows = ids[order], points[order], rows[order]
        self.low, self.high = np.array(low), np.array(high)
        self.least = np.array(least, dtype=np.int64)
        self.right = [-1] * len(self.first)
        at = {(a, b): i for i, (a, b) in enumerate(zip(self.first, self.last))}
        for node, left in enumerate(self.left):
            if left >= 0:
                self.right[node] = at[self.last[left], self.last[node]]

    def arithmetic(self, queries: np.ndarray):
        """The number type in which inner products with ``queries`` are exact."""
        largest = [float(np.abs(x.astype(float)).max(initial=0.0)) for x in (self.points, queries)]
        return float if largest[0] * largest[1] * max(1, self.points.shape[1]) < EXACT else object

    def bounds(self, queries: np.ndarray, kind) -> np.ndarray:
        """For each query and node, the greatest inner product with a point of the node's box."""
        q = queries.astype(kind)
        zero = q * 0
        return np.maximum(q, zero) @ self.high.T.astype(kind) + np.minimum(q, zero) @ self.low.T.astype(kind)

    def search(self, queries, query_rows, k: int, floors) -> Iterator[tuple[int, int, int]]:
        """(query row, point id, score) of points that may be among the k best of all shards.

        ``floors``: for each query the (score, id) of its k-th best so far elsewhere, or None.
        """
        if not len(self.ids):
            return
        kind = self.arithmetic(queries)
        bounds = self.bounds(queries, kind)
        points = self.points.astype(kind)
        for row, query in enumerate(queries.astype(kind)):
            own, floor, bound = query_rows[row], floors[row], bounds[row]
            best: list[tuple] = []  # (-score, id), sorted, at most k
            heap = [(-bound[0], self.least[0], 0)]
            while heap:
                top, least, node = heapq.heappop(heap)
                limit = best[-1] if len(best) == k else None
                limit = min(x for x in (limit, floor) if x) if limit or floor else None
                if limit and (top, least) > limit:
                    # Later boxes allow less, or the same score with larger ids.
                    break
                left = self.left[node]
                if left >= 0:
                    for child in (left, self.right[node]):
                        heapq.heappush(heap, (-bound[child], self.least[child], child))
                    continue
                part = slice(self.first[node], self.last[node])
                scores, ids, rows = points[part] @ query, self.ids[part], self.rows[part]
                good = np.nonzero(scores >= -limit[0])[0] if limit else np.arange(len(ids))
                found = [(-scores[i], ids[i]) for i in good if rows[i] != own]
                best = heapq.nsmallest(k, [*best, *found])
            for negative, point in best:
                yield int(own), int(point), max(LONG.min, min(LONG.max, int(-negative)))


def whole_vectors(vector: Column, factor: int) -> tuple[Column, Column]:
    """``floor(factor * x)`` of every component, and whether all components are finite numbers."""
    numbers = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(factor))))
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    return numbers, vector.isNotNull() & finite


def prepare(df: DataFrame, vec_id: str, vector: str, factor: int = 256) -> DataFrame:
    """(row, vec_id, vector): whole-number vectors, each under a number of its own.

    Vectors that are null or have a null or non-finite component are left out, and so are rows
    without an id. Rows that repeat an id, with equal vectors or others, are points of their own.
    Components beyond the range of a long become its end. Other columns are dropped. The numbers are
    fixed once the result is written: materialise it before use.
    """
    numbers, usable = whole_vectors(F.col(vector), factor)
    rows = df.where(usable & F.col(vec_id).isNotNull())
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), numbers.alias("vector"))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vector")


def build(points: DataFrame) -> DataFrame:
    """The index, a table (shard, width, tree): one KD-tree per shard of ``points``."""
    ship(points.sparkSession)
    shards = max(1, -(-points.count() // SHARD_ROWS))

    def grow(frame: pd.DataFrame) -> pd.DataFrame:
        let_go()
        width = int(frame["vector"].map(len).max())
        order = frame.sort_values(["vec_id", "row"])
        ids, rows = order["vec_id"].to_numpy(np.int64), order["row"].to_numpy(np.int64)
        tree = Tree(ids, matrix(order["vector"].tolist(), width), rows)
        shard = int(frame["shard"].iloc[0])
        return pd.DataFrame({"shard": [shard], "width": [width], "tree": [pickle.dumps(tree)]})

    # The hash may leave a shard of a small table empty; every shard in use has one tree.
    placed = points.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    return materialise(placed.groupBy("shard").applyInPandas(grow, "shard int, width int, tree binary"))


def _visit(k: int):
    def visit(trees: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(trees) and len(queries):
            tree: Tree = pickle.loads(trees["tree"].iloc[0])
            width = max(int(trees["width"].iloc[0]), int(queries["vector"].map(len).max()))
            if tree.points.shape[1] < width:
                grown = ((0, 0), (0, width - tree.points.shape[1]))
                tree.points, tree.low, tree.high = (np.pad(x, grown) for x in (tree.points, tree.low, tree.high))
            floors = [
                None if score is None or score != score else (-int(score), int(point))
                for score, point in zip(queries["floor_score"].astype(object), queries["floor_id"].astype(object))
            ]
            rows = list(tree.search(matrix(queries["vector"].tolist(), width), queries["row"].to_numpy(), k, floors))
        return pd.DataFrame(rows, columns=["query_row", "vec_id", "score"]).astype("int64")

    return visit


FOUND = "query_row long, vec_id long, score long"


def _searched(index: DataFrame, visits: DataFrame, k: int, blocks: int) -> DataFrame:
    """``visits`` (shard, block, ...) against the trees of their shards."""
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    trees = index.withColumn("block", every)
    pairs = trees.groupBy("shard", "block").cogroup(visits.groupBy("shard", "block"))
    return pairs.applyInPandas(_visit(k), FOUND)


def top_k(index: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The k best points of every query but itself: (query_id, rank, vec_id, score).

    ``index`` comes from :func:`build`, ``queries`` are rows of what it was built on: each is compared with
    all rows but itself, those with its id included. Higher inner products come
    first, then smaller ids; a query gets fewer rows where there are fewer points. Vectors of
    different lengths are compared as if the shorter one ended in zeros. Scores beyond the range of
    a long become its end. Without points or queries the result is empty.
    """
    ship(index.sparkSession)
    count = (index.agg(F.max("shard")).first()[0] or 0) + 1
    blocks = max(1, -(-queries.count() // BLOCK))
    number = F.pmod(F.xxhash64("row", F.lit("block")), F.lit(blocks)).cast("int")
    all_shards = F.sequence(F.lit(0), F.lit(count - 1))
    asked = queries.withColumn("block", number).withColumn(
        "home", F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")
    )
    asked = asked.withColumns({"floor_score": F.lit(None).cast("long"), "floor_id": F.lit(None).cast("long")})
    first = materialise(_searched(index, asked.withColumn("shard", F.col("home")), k, blocks))
    floors = first.groupBy("query_row").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("i")))).alias("best")
    )  # at most k of each query
    floors = floors.where(F.size("best") >= k).select(
        F.col("query_row").alias("row"),
        (-F.element_at("best", k)["s"]).alias("floor_score"),
        F.element_at("best", k)["i"].alias("floor_id"),
    )
    others = asked.drop("floor_score", "floor_id").join(floors, "row", "left")
    others = others.withColumn("shard", F.explode(all_shards)).where("shard <> home")
    found = first.unionByName(_searched(index, others, k, blocks))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = queries.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"))
    return ranked.join(names, "query_row").select("query_id", "rank", "vec_id", "score")
