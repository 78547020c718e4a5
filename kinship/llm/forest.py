"""Approximate nearest neighbours: a forest of random-projection trees, one
shared priority queue over all trees, exact ranking of what the leaves hold.

Fit: a bounded sample of vectors (``sample_rows``, the smallest by a hash of
their id) is cut by random hyperplanes, each through the median of the sample
along the direction between two sampled points, until a leaf holds
``leaf_sample`` of them. The trees (some hundred hyperplanes) are broadcast;
their size depends on the parameters alone.

Index: every row is sent down every tree and stored under (tree, leaf, block).
A leaf is cut by a hash of the id into blocks of about ``block_rows`` rows.

Search: each query holds one priority queue over the nodes of all trees. The
node with the largest smallest margin is opened first; the first ``visits``
leaves are visited. The queries are cut by another hash of the id into blocks
of about ``query_block_rows``, so a group of (tree, leaf, block, query block)
has no side that grows with the input. In each group the distances of all its
queries to all its rows are computed in double precision and the ``k``
smallest kept; the smallest of these over all groups are the result.

Work: the number of leaves follows from the sample, so the share of the table
that a query is compared with (and the recall) is the same at any size, and
comparisons grow with queries times rows. Copies of the queries grow with
rows / ``block_rows``, copies of the index with queries / ``query_block_rows``.

Equal vectors: only the ``k + 1`` smallest ids of a vector can be among the
``k`` nearest of any query, so the others are set aside before the index is
built; no result is lost, and a vector that a third of all rows share fills
no leaf.

Defined results: vectors that are null, hold null or non-finite components,
are all zero, or whose length differs from that of most vectors take no part;
rows without an id take no part; of rows that repeat an id the smallest vector
counts; a query with fewer candidates than ``k`` gets them all; no rows come
of an empty table or of a query without any candidate; further columns are
ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinship.llm.common import first_by_hash, written

TREES = 4
SAMPLE_ROWS = 4096
LEAF_SAMPLE = 128
VISITS = 48
BLOCK_ROWS = 4096
QUERY_BLOCK_ROWS = 4096

# What an index row and a query share in order to meet.
KEY = ("tree", "leaf", "block", "query_block")


@dataclass
class Tree:
    """Hyperplanes by node; ``left`` and ``right`` hold a node, or -1 - leaf."""

    normals: np.ndarray
    offsets: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of ``x``."""
        at = np.zeros(len(x), np.int64) if len(self.offsets) else np.full(len(x), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            above = np.einsum("ij,ij->i", x[inner], self.normals[node]) > self.offsets[node]
            at[inner] = np.where(above, self.right[node], self.left[node])
        return -1 - at


def grow(x: np.ndarray, leaf_sample: int, rng: np.random.Generator) -> Tree:
    normals, offsets, left, right, leaves = [], [], [], [], 0
    # (rows of the sample, the node above, which of its sides)
    todo = [(np.arange(len(x)), -1, left)]
    while todo:
        rows, above, side = todo.pop()
        normal = None
        if len(rows) > leaf_sample:
            a, b = x[rng.choice(rows, 2, replace=False)]
            normal = a - b
            along = x[rows] @ normal
            offset = float(np.median(along))
            up = along > offset
            if up.all() or not up.any():
                # The sample is too much alike to be cut.
                normal = None
        if normal is None:
            place, leaves = -1 - leaves, leaves + 1
        else:
            place = len(normals)
            normals.append(normal)
            offsets.append(offset)
            left.append(0)
            right.append(0)
            todo += [(rows[up], place, right), (rows[~up], place, left)]
        if above >= 0:
            side[above] = place
    dim = x.shape[1] if x.ndim == 2 else 0
    return Tree(
        np.array(normals, np.float64).reshape(len(normals), dim),
        np.array(offsets, np.float64),
        np.array(left, np.int64),
        np.array(right, np.int64),
    )


def visit(trees: list[Tree], q: np.ndarray, visits: int) -> list[tuple[int, int]]:
    """(tree, leaf) of the leaves that the shared queue reaches first."""
    queue = [(-np.inf, t, 0 if len(tree.offsets) else -1) for t, tree in enumerate(trees)]
    heapq.heapify(queue)
    margins = [tree.normals @ q - tree.offsets for tree in trees]
    out = []
    while queue and len(out) < visits:
        far, t, node = heapq.heappop(queue)
        if node < 0:
            out.append((t, -1 - node))
            continue
        margin = margins[t][node]
        # How far beyond a hyperplane a side lies, at most, on the way to it.
        heapq.heappush(queue, (max(far, -margin), t, int(trees[t].right[node])))
        heapq.heappush(queue, (max(far, margin), t, int(trees[t].left[node])))
    return out


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector as doubles) of the rows that take part."""
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists("vector", lambda x: x != 0)
    sound = (
        rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"))
        .where(F.col("id").isNotNull() & F.col("vector").isNotNull())
        .where(finite)
    )
    sizes = sound.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), "dim").limit(1).select("dim")
    one = sound.groupBy("id").agg(F.min("vector").alias("vector"))
    return one.join(F.broadcast(common), F.size("vector") == F.col("dim")).select("id", "vector")


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 0))


def rank(ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray, points: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, id, distance) of the ``k`` rows nearest to each query of a group, other than itself."""
    k = min(k, len(ids))
    found, score = np.empty(len(queries) * k, np.int64), np.empty(len(queries) * k)
    counts = np.zeros(len(queries), np.int64)
    at = 0
    for i, (query, q) in enumerate(zip(queries, points, strict=True)):
        difference = vectors - q
        distance = np.sqrt((difference * difference).sum(axis=1))
        distance[ids == query] = np.inf
        near = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
        near = near[np.isfinite(distance[near])]
        near = near[np.lexsort((ids[near], distance[near]))][:k]
        counts[i] = len(near)
        found[at : at + len(near)], score[at : at + len(near)] = ids[near], distance[near]
        at += len(near)
    return np.repeat(queries, counts), found[:at], score[:at]


def hashed_block(blocks: int, seed: int) -> Column:
    return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(blocks)).cast("int")


def every_block(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))


def groups(
    indexed: DataFrame, queries: DataFrame, forest: Broadcast, visits: int, blocks: int, query_blocks: int
) -> tuple[DataFrame, DataFrame]:
    """(index rows, query rows), each (tree, leaf, id, vector, block, query_block): those of equal KEY meet."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column("vector"))
                for t, tree in enumerate(forest.value):
                    leaves = tree.leaves(vectors)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(leaves), t), pa.int32()), pa.array(leaves, pa.int32()), *batch.columns],
                        names=["tree", "leaf", *batch.schema.names],
                    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [visit(forest.value, q, visits) for q in _matrix(batch.column("vector"))]
            row = np.repeat(np.arange(len(found)), [len(f) for f in found])
            flat = [leaf for f in found for leaf in f]
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([t for t, _ in flat], pa.int32()),
                    pa.array([leaf for _, leaf in flat], pa.int32()),
                    *taken.columns,
                ],
                names=["tree", "leaf", *taken.schema.names],
            )

    placed = "tree int, leaf int, id long, vector array<double>"
    index_rows = indexed.withColumn("block", hashed_block(blocks, 0)).mapInArrow(index, f"{placed}, block int")
    query_rows = queries.withColumn("query_block", hashed_block(query_blocks, 1)).mapInArrow(search, f"{placed}, query_block int")
    return index_rows.withColumn("query_block", every_block(query_blocks)), query_rows.withColumn("block", every_block(blocks))


def nearest(
    rows: DataFrame,
    queries_of,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = TREES,
    sample_rows: int = SAMPLE_ROWS,
    leaf_sample: int = LEAF_SAMPLE,
    visits: int = VISITS,
    block_rows: int = BLOCK_ROWS,
    query_block_rows: int = QUERY_BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query.

    ``queries_of`` makes a condition of the id column: which rows are queries.
    """
    spark = rows.sparkSession
    all_rows = written(usable(rows, id_col, vector_col), "forest-rows")
    alike = Window.partitionBy("vector").orderBy("id")
    place = F.row_number().over(alike)
    indexed = written(all_rows.withColumn("_place", place).where(F.col("_place") <= k + 1).drop("_place"), "forest-index")
    n = indexed.count()
    sample = first_by_hash(indexed, "id", sample_rows).toPandas()
    x = np.array(sample["vector"].to_list(), np.float64) if n else np.empty((0, 0))
    forest = spark.sparkContext.broadcast(
        [grow(x, leaf_sample, np.random.default_rng(seed)) for seed in range(trees)]
    )
    leaf_count = max(1, min(len(sample), n) // leaf_sample)
    blocks = max(1, round(n / leaf_count / block_rows))
    queries = all_rows.where(queries_of(F.col("id")))
    query_blocks = max(1, -(-queries.count() // query_block_rows))
    index_rows, query_rows = groups(indexed, queries, forest, visits, blocks, query_blocks)

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        vectors, points = np.stack(left["vector"].to_numpy()), np.stack(right["vector"].to_numpy())
        query, found, score = rank(left["id"].to_numpy(), vectors, right["id"].to_numpy(), points, k)
        return pd.DataFrame({"query_id": query, "vec_id": found, "score": score})

    found = (
        index_rows.groupBy(*KEY)
        .cogroup(query_rows.groupBy(*KEY))
        .applyInPandas(meet, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
