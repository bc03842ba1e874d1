"""Approximate nearest neighbours by a forest of random-projection trees.

A tree splits space by hyperplanes half-way between two vectors drawn at random, as in a sample of bounded size; the
forest is fitted on the driver and broadcast. Every vector of the table is then put into one leaf of each tree. A
query walks all trees at once: one priority queue holds the branches not taken, ordered by the margin to the
hyperplanes on the way, and the nearest branches of any tree are followed until enough leaves are reached. Queries
meet the vectors of their leaves in cogroups, a few for each tree, where candidates are ranked by their exact
distance; the best of each cogroup are merged. Beyond the size of the sample a leaf would grow with the table, so
its vectors are dealt to as many blocks as the table is times the sample, and its queries go to each block.

Equal vectors become one before the index is built, with the smallest ``k + 1`` of their ids: no more can be among a
query's nearest. So a vector that a third of all rows share costs one entry, and nothing is cut that could matter.

Defined cases: vectors that are null, zero, or hold a null or non-finite number take no part, nor do those of
another length than the most frequent one (the longer one, if two are equally frequent) or without an id; rows with
equal id and vector count once; fewer than ``k`` candidates give fewer rows; ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swapbook.llm import ship
from swapbook.llm.store import kept


@dataclass(frozen=True)
class Settings:
    k: int = 10
    trees: int = 16
    #: vectors of the sample in a leaf, at most
    leaf: int = 48
    #: leaves that a query looks into, over all trees
    probes: int = 1000
    #: vectors that the forest is fitted on, at most
    sample: int = 50_000
    seed: int = 7


#: Ranges of leaves that a tree is cut into, however large it is. A range is searched together, so a query has at most
#: ``RANGES * trees`` short lists of candidates in a block.
RANGES = 4
#: Queries of a range that are searched together, about.
QUERIES = 20_000


class Tree:
    """Hyperplanes in arrays; a child below zero is leaf ``-1 - child``."""

    def __init__(self, points: np.ndarray, leaf: int, random: np.random.Generator):
        self.normals: list[np.ndarray] = []
        self.offsets: list[float] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.root = self._leaf() if len(points) <= leaf else 0
        waiting = [] if len(points) <= leaf else [(np.arange(len(points)), None, 0)]
        while waiting:
            at, parent, side = waiting.pop()
            split = self._split(points, at, random) if len(at) > leaf else None
            if split is None:
                node = self._leaf()
            else:
                node, right = split
                waiting += [(at[~right], node, 0), (at[right], node, 1)]
            if parent is not None:
                self.children[parent][side] = node
        self.normal = np.array(self.normals) if self.normals else np.zeros((0, points.shape[1]))
        self.offset, self.child = np.array(self.offsets), np.array(self.children, np.int64).reshape(-1, 2)
        del self.normals, self.offsets, self.children

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def _split(self, points: np.ndarray, at: np.ndarray, random: np.random.Generator):
        for _ in range(5):
            a, b = points[random.choice(at, 2, replace=False)]
            normal = a - b
            length = np.linalg.norm(normal)
            if length == 0:
                continue
            normal = normal / length
            along = points[at] @ normal
            offset = float(np.median(along))
            right = along > offset
            if right.any() and not right.all():
                self.normals.append(normal)
                self.offsets.append(offset)
                self.children.append([0, 0])
                return len(self.normals) - 1, right
        return None

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        node = np.full(len(vectors), self.root, np.int64)
        while (inner := node >= 0).any():
            rows, at = np.flatnonzero(inner), node[inner]
            right = (np.einsum("ij,ij->i", vectors[rows], self.normal[at]) > self.offset[at]).astype(np.int64)
            node[rows] = self.child[at, right]
        return -1 - node


class Forest:
    def __init__(self, points: np.ndarray, settings: Settings):
        random = np.random.default_rng(settings.seed)
        self.trees = [Tree(points, settings.leaf, random) for _ in range(settings.trees)]
        self.first = np.concatenate([[0], np.cumsum([t.leaves for t in self.trees])]).astype(np.int64)
        #: the range of each leaf
        self.group = np.concatenate([k * RANGES + np.arange(t.leaves) * RANGES // t.leaves for k, t in enumerate(self.trees)])

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """One leaf number per vector and tree."""
        return np.column_stack([self.first[k] + t.leaf_of(vectors) for k, t in enumerate(self.trees)])

    def probe(self, vector: np.ndarray, probes: int) -> list[int]:
        """The leaves nearest to the query, from one queue over all trees."""
        queue = [(-np.inf, k, t.root) for k, t in enumerate(self.trees)]
        heapq.heapify(queue)
        found = []
        while queue and len(found) < probes:
            margin, k, node = heapq.heappop(queue)
            tree = self.trees[k]
            while node >= 0:
                gap = float(tree.normal[node] @ vector - tree.offset[node])
                near = int(gap > 0)
                heapq.heappush(queue, (max(margin, abs(gap)), k, int(tree.child[node, 1 - near])))
                node = int(tree.child[node, near])
            found.append(int(self.first[k] - 1 - node))
        return found


def usable(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v): the rows that take part."""
    v = F.col(vector)
    number = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    good = number & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & v.isNotNull() & F.coalesce(good, F.lit(False))
    )
    sizes = rows.groupBy(F.size("v").alias("length")).count()
    common = sizes.agg(F.max(F.struct("count", "length"))["length"].alias("length"))
    return rows.join(common, F.size("v") == F.col("length"), "left_semi")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _with_leaves(rows: DataFrame, shared, probes: int) -> DataFrame:
    """(key, leaf, group): where a vector lies (``probes`` 0), or where a query looks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = ship.received(shared)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column(1))
            lists = [forest.probe(v, probes) for v in vectors] if probes else forest.leaves_of(vectors)
            sizes = [len(x) for x in lists]
            keys = batch.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            leaves = np.concatenate(lists).astype(np.int64)
            yield pa.RecordBatch.from_arrays([keys, pa.array(leaves), pa.array(forest.group[leaves])], ["key", "leaf", "group"])

    return rows.mapInArrow(run, "key long, leaf long, group long")


def _ranked(k: int):
    """Per cogroup: the nearest k + 1 entries of each query among the leaves that it looks into here."""

    def run(index: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
        if not len(index) or not len(probes):
            return pd.DataFrame({"query": [], "key": [], "score": []}).astype({"query": "int64", "key": "int64"})
        index = index.sort_values("leaf", kind="stable")
        leaf, keys = index["leaf"].to_numpy(), index["key"].to_numpy()
        vectors = np.stack(index["v"].to_numpy()).astype(np.float64)
        queries, near, scores = [], [], []
        for query, point, wanted in zip(probes["query"], probes["q"], probes["leaves"]):
            low, high = np.searchsorted(leaf, wanted), np.searchsorted(leaf, wanted, side="right")
            # the leaves are those of one tree, which holds a vector once
            at = np.concatenate([np.arange(i, j) for i, j in zip(low, high)])
            if not len(at):
                continue
            away = vectors[at] - np.asarray(point, np.float64)
            score = np.sqrt((away * away).sum(axis=1))
            best = np.lexsort((keys[at], score))[: k + 1]
            queries.append(np.full(len(best), query))
            near.append(keys[at][best])
            scores.append(score[best])
        if not queries:
            return run(index[:0], probes)
        return pd.DataFrame({"query": np.concatenate(queries), "key": np.concatenate(near), "score": np.concatenate(scores)})

    return run


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector: str = "embedding",
            settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the nearest vectors found for each query row."""
    k = settings.k
    rows = usable(vectors, id_col, vector).distinct()
    marked = rows.withColumn("_query", F.coalesce(is_query, F.lit(False)))
    # one entry per distinct vector, under its smallest id, with the ids that can be among the nearest
    order = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = marked.withColumn("_no", order).filter(F.col("_no") <= k + 1)
    entries = kept(few.groupBy("v").agg(F.min("id").alias("key"), F.sort_array(F.collect_list("id")).alias("ids")))
    asked = kept(marked.filter("_query").join(entries.select("v", "key"), "v").select("id", "key"))

    sample = entries.select("key", "v").orderBy(F.xxhash64("key"), "key").limit(settings.sample).toArrow()
    points = _matrix(sample.column("v").combine_chunks())
    shared = ship.broadcast(vectors.sparkSession.sparkContext, Forest(points, settings))

    queries = entries.join(asked.select("key").distinct(), "key", "left_semi").select("key", "v")
    index = _with_leaves(entries.select("key", "v"), shared, 0)
    probes = _with_leaves(queries, shared, settings.probes).withColumnRenamed("key", "query")
    blocks = max(1, -(-entries.count() // settings.sample))
    parts = max(1, -(-queries.count() // QUERIES))

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    def dealt(key: str, n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n).cast("long"))

    # an entry is in one block and meets the queries of all parts, a query is in one part and goes to all blocks
    left = index.join(entries.select("key", "v"), "key").withColumn("block", dealt("key", blocks)).withColumn("part", each(parts))
    wanted = probes.groupBy("query", "group").agg(F.collect_list("leaf").alias("leaves"))
    right = wanted.join(queries.select(F.col("key").alias("query"), F.col("v").alias("q")), "query")
    right = right.withColumn("part", dealt("query", parts)).withColumn("block", each(blocks))
    place = ("group", "block", "part")
    near = left.groupBy(*place).cogroup(right.groupBy(*place)).applyInPandas(_ranked(k), "query long, key long, score double")
    near = near.groupBy("query", "key").agg(F.min("score").alias("score"))
    # an entry's least id is its key, so an id among the nearest k + 1 lies in one of the nearest k + 1 entries
    ahead = F.row_number().over(Window.partitionBy("query").orderBy("score", "key"))
    near = near.withColumn("_no", ahead).filter(F.col("_no") <= k + 1).drop("_no")
    scored = near.join(entries.select("key", "ids"), "key").select("query", "score", F.explode("ids").alias("vec_id"))
    best = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
    short = scored.withColumn("_no", best).filter(F.col("_no") <= k + 1).drop("_no")
    own = asked.select(F.col("id").alias("query_id"), F.col("key").alias("query"))
    answers = own.join(short, "query").filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
