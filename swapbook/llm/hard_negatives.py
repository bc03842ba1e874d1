"""Hard negatives by an inverted multi-index.

Vectors are cut into halves, each with a codebook of its own; a pair of codes is a cell. The score of an anchor with any
row of a cell is at most the sum of two half-scores: that of the anchor with the code, plus the anchor's length times the
radius of the rows around the code. A heap over the two sorted lists of half-scores (the multi-sequence algorithm) visits
the cells by falling bound, and stops as soon as no cell left can hold a row that belongs into the result: when the bound
falls below the last of the positives found, or below every window of negatives or the last one found in it. So the
result is exact, whatever the codebooks.

Codebooks are fitted on a sample of at most ``sample`` rows; every row is put into its cell. Whole cells, or parts of
large ones, form blocks of at most about ``block`` rows, and an anchor goes to those blocks only that have a cell with a
large enough bound: first to the best one alone, which gives the bound for the positives; then to all that can hold a
positive; then, with the positives known, to all that can hold a negative. A task holds one block at a time and lets
the anchors pass by, each a row; it hands out five rows at most for an anchor and positive. Cells are listed
on the driver (codes x codes of them at most), rows and anchors never are.

Components become whole numbers by floor(scale * x), so scores are exact. Defined cases: rows without an id or label take
no part, nor do those whose vector is null, holds a null or non-finite component or one of 2^24 or more after scaling (a
score might not fit a long), or has another length than the most frequent one (the longer of two as frequent). Of several
rows with one id the one with the smallest label and vector counts. An anchor without another row of its label has no
positives and no rows; a window without a row has none; a negative positive score has an empty window. Ties go to the
smaller id. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swapbook.llm import ship
from swapbook.llm.store import stored

LARGEST = float(1 << 24)


@dataclass(frozen=True)
class Settings:
    positives: int = 5
    negatives: int = 5
    #: a negative has at least this part of the positive's score, as a fraction
    low: tuple[int, int] = (4, 5)
    scale: int = 256
    #: codes of each half
    codes: int = 32
    #: rows that the codebooks are fitted on, at most
    sample: int = 20_000
    #: rows of a block, about
    block: int = 4096
    seed: int = 7


#: Rows that are scored at a time within a block.
STRIDE = 512


def codebook(points: np.ndarray, codes: int, random: np.random.Generator) -> np.ndarray:
    """Centres by some rounds of k-means."""
    distinct = np.unique(points, axis=0)
    centres = distinct[np.sort(random.choice(len(distinct), min(codes, len(distinct)), replace=False))].astype(float)
    for _ in range(8):
        near = nearest(points, centres)
        for k in range(len(centres)):
            if (own := near == k).any():
                centres[k] = points[own].mean(axis=0)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    away = (centres * centres).sum(axis=1)[None, :] - 2 * points @ centres.T
    return away.argmin(axis=1)


def _length(points: np.ndarray) -> np.ndarray:
    return np.sqrt((points * points).sum(axis=1))


@dataclass
class Codes:
    """Both codebooks, and the cells with their radii and blocks."""

    half: int
    first: np.ndarray
    second: np.ndarray
    cells: np.ndarray | None = None  # (cell, 2): codes
    radii: np.ndarray | None = None  # (cell, 2)
    block: np.ndarray | None = None  # first block of a cell
    parts: np.ndarray | None = None  # blocks that a cell is dealt to

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Codes of rows, and how far they are from them."""
        a, b = x[:, : self.half], x[:, self.half :]
        one, two = nearest(a, self.first), nearest(b, self.second)
        return one, two, _length(a - self.first[one]), _length(b - self.second[two])

    def bounds(self, x: np.ndarray) -> np.ndarray:
        """Upper bounds of the score of rows with each cell."""
        a, b = x[:, : self.half], x[:, self.half :]
        one = (a @ self.first.T)[:, self.cells[:, 0]] + np.outer(_length(a), self.radii[:, 0])
        two = (b @ self.second.T)[:, self.cells[:, 1]] + np.outer(_length(b), self.radii[:, 1])
        return raised(one + two)


def raised(bound):
    """A bound with room for rounding."""
    return bound + 1 + 1e-9 * np.abs(bound)


class Index:
    """The rows of a block by cell."""

    def __init__(self, codes: Codes, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, one: np.ndarray, two: np.ndarray):
        order = np.lexsort((ids, two, one))
        self.codes, self.ids, self.labels, self.x = codes, ids[order], labels[order], x[order]
        self.one, self.two = one[order], two[order]
        self.firsts, at1 = np.unique(self.one, return_inverse=True)
        self.seconds, at2 = np.unique(self.two, return_inverse=True)
        half = codes.half
        self.radius1, self.radius2 = np.zeros(len(self.firsts)), np.zeros(len(self.seconds))
        np.maximum.at(self.radius1, at1, _length(self.x[:, :half] - codes.first[self.one]))
        np.maximum.at(self.radius2, at2, _length(self.x[:, half:] - codes.second[self.two]))
        cell = at1 * len(self.seconds) + at2
        starts = np.searchsorted(cell, np.arange(len(self.firsts) * len(self.seconds) + 1))
        self.starts = starts.tolist()
        self.most = float(np.abs(self.x).max()) if self.x.size else 0.0
        self.own: dict[int, Index] = {}

    def of(self, label: int) -> Index:
        """The rows of one label."""
        if label not in self.own:
            k = np.flatnonzero(self.labels == label)
            self.own[label] = Index(self.codes, self.ids[k], self.labels[k], self.x[k], self.one[k], self.two[k])
        return self.own[label]

    def visits(self, a: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """(bound, begin, end) of the cells that have rows, by falling bound."""
        if not len(self.ids):
            return
        half, width = self.codes.half, len(self.seconds)
        one = self.codes.first[self.firsts] @ a[:half] + np.sqrt(a[:half] @ a[:half]) * self.radius1
        two = self.codes.second[self.seconds] @ a[half:] + np.sqrt(a[half:] @ a[half:]) * self.radius2
        order1, order2 = np.argsort(-one), np.argsort(-two)
        sorted1, sorted2 = one[order1].tolist(), two[order2].tolist()
        order1, order2 = order1.tolist(), order2.tolist()
        heap = [(-sorted1[0] - sorted2[0], 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if j == 0 and i + 1 < len(sorted1):
                heapq.heappush(heap, (-sorted1[i + 1] - sorted2[0], i + 1, 0))
            if j + 1 < width:
                heapq.heappush(heap, (-sorted1[i] - sorted2[j + 1], i, j + 1))
            cell = order1[i] * width + order2[j]
            if self.starts[cell] < self.starts[cell + 1]:
                yield -bound, self.starts[cell], self.starts[cell + 1]

    def strides(self, a: np.ndarray) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """(bound of these and all later rows, places, scores) of some cells at a time."""
        exact = self.most * float(np.abs(a).max(initial=0)) * max(len(a), 1) < 1 << 53
        rows, wide = (self.x, a) if exact else (self.x.astype(np.int64), a.astype(np.int64))
        held, size, top = [], 0, 0.0

        def scored() -> tuple[float, np.ndarray, np.ndarray]:
            at = np.concatenate([np.arange(b, e) for b, e in held])
            return top, at, (rows[at] @ wide).astype(np.int64)

        for bound, begin, end in self.visits(a):
            if not held:
                top = raised(bound)
            held.append((begin, end))
            size += end - begin
            if size >= STRIDE:
                yield scored()
                held, size = [], 0
        if held:
            yield scored()

    def positives(self, anchor: int, label: int, a: np.ndarray, least: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The best rows of the label other than the anchor, of ``least`` or more; (ids, scores)."""
        own = self.of(label)
        need = -np.inf if least is None else least
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for bound, at, found in own.strides(a):
            if bound < need:
                break
            good = (found >= need) & (own.ids[at] != anchor)
            ids, scores = np.append(ids, own.ids[at][good]), np.append(scores, found[good])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(ids) == k:
                need = max(need, scores[-1])
        return ids, scores

    def negatives(self, label: int, a: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """The best rows of other labels within each window of scores."""
        none = np.zeros(0, np.int64)
        found = [(none, none) for _ in windows]
        needs = [low if low <= high else np.inf for low, high in windows]
        for bound, at, scores in self.strides(a):
            if bound < min(needs, default=np.inf):
                break
            usable = (scores >= min(needs)) & (self.labels[at] != label)
            at, scores = at[usable], scores[usable]
            for w, (low, high) in enumerate(windows):
                good = (scores >= needs[w]) & (scores <= high)
                if good.any():
                    ids, best = np.append(found[w][0], self.ids[at[good]]), np.append(found[w][1], scores[good])
                    top = np.lexsort((ids, -best))[:k]
                    found[w] = ids[top], best[top]
                    if len(top) == k:
                        needs[w] = found[w][1][-1]
        return found


def _matrix(column: pa.Array, kind: str = "<i4") -> np.ndarray:
    """Rows of equal length, from binary values."""
    flat = np.frombuffer(b"".join(column.to_pylist()), kind)
    return flat.reshape(len(column), -1).astype(float) if len(column) else np.zeros((0, 0))


def usable(vectors: DataFrame, settings: Settings, id_col: str, vector: str, label: str) -> DataFrame:
    """(id, label, x): the rows that take part, one per id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v")).filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda c: F.coalesce(F.abs(c.cast("double") * settings.scale) < LARGEST, F.lit(False)))
    )
    rows = rows.select("id", "label", F.transform("v", lambda c: F.floor(c.cast("double") * settings.scale).cast("int")).alias("x"))
    first = F.row_number().over(Window.partitionBy("id").orderBy("label", "x"))
    return rows.withColumn("_no", first).filter("_no = 1").drop("_no")


def _placed(rows: DataFrame, shared) -> DataFrame:
    """(id, label, data, one, two, r1, r2): rows in their cells, components as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = ship.received(shared)
        for batch in batches:
            if batch.num_rows:
                x = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(batch.num_rows, -1)
                one, two, r1, r2 = codes.place(x.astype(float))
                data = pa.array([row.tobytes() for row in x], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), data, pa.array(one.astype(np.int32)), pa.array(two.astype(np.int32)), pa.array(r1), pa.array(r2)],
                    ["id", "label", "data", "one", "two", "r1", "r2"],
                )

    return rows.mapInArrow(run, "id long, label long, data binary, one int, two int, r1 double, r2 double")


def _dealt(codes: Codes, cells: list, block: int) -> int:
    """Give each cell its blocks: small neighbours share one, a large one is dealt to several. The number of blocks."""
    cells = sorted(cells, key=lambda c: (c.one, c.two))
    codes.cells = np.array([(c.one, c.two) for c in cells], np.int64).reshape(-1, 2)
    codes.radii = np.array([(c.r1, c.r2) for c in cells]).reshape(-1, 2)
    firsts, parts, at, held = [], [], 0, 0
    for c in cells:
        if held and held + c.n > block:
            at, held = at + 1, 0
        n = -(-c.n // block)
        firsts.append(at)
        parts.append(n)
        held += c.n
        if n > 1:
            at, held = at + n, 0
    codes.block, codes.parts = np.array(firsts, np.int64), np.array(parts, np.int64)
    return at + (held > 0)


def _routed(asked: DataFrame, shared, best_only: bool) -> DataFrame:
    """``asked`` (id, label, data, goals, least, skip) per block that it has to see.

    That is the block with the highest bound alone, or all but ``skip`` with a bound of ``least`` or more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = ship.received(shared)
        order = np.argsort(codes.block, kind="stable")
        starts, begins = np.unique(codes.block[order], return_index=True)
        parts = codes.parts[order[begins]]
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                bounds = np.maximum.reduceat(codes.bounds(_matrix(some.column(2)))[:, order], begins, axis=1)
                if best_only:
                    rows = np.arange(len(bounds))
                    blocks = starts[bounds.argmax(axis=1)]
                else:
                    least = np.array([-np.inf if x is None else x for x in some.column(4).to_pylist()])
                    rows, cols = np.nonzero(bounds >= least[:, None])
                    again = parts[cols]  # all parts of a large cell
                    ahead = np.arange(again.sum()) - np.repeat(np.cumsum(again) - again, again)
                    rows, blocks = np.repeat(rows, again), np.repeat(starts[cols], again) + ahead
                    skip = np.array([-1 if x is None else x for x in some.column(5).to_pylist()])
                    keep = blocks != skip[rows]
                    rows, blocks = rows[keep], blocks[keep]
                taken = some.select(["id", "label", "data", "goals", "least"]).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([pa.array(blocks), *taken.columns], ["block", *taken.schema.names])

    return asked.select("id", "label", "data", "goals", "least", "skip").mapInArrow(
        run, "block long, id long, label long, data binary, goals array<long>, least long"
    )


def _searched(index: DataFrame, routed: DataFrame, shared, settings: Settings) -> DataFrame:
    """(anchor_id, block, slot, id, score): what each block has to offer.

    Without goals these are positives (slot 0), else the negatives of each goal (its place is the slot). Rows of a
    block come first, then its anchors; one block is held at a time.
    """
    nothing = [F.lit(None).cast("array<bigint>").alias("goals"), F.lit(None).cast("long").alias("least")]
    members = index.select("block", F.lit(0).alias("kind"), "id", "label", "data", "one", "two", *nothing)
    no_codes = [F.lit(None).cast("int").alias(c) for c in ("one", "two")]
    asking = routed.select("block", F.lit(1).alias("kind"), "id", "label", "data", *no_codes, "goals", "least")
    rows = members.unionByName(asking).repartition("block").sortWithinPartitions("block", "kind", "id")
    up, down = settings.low
    names = ["anchor_id", "block", "slot", "id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = ship.received(shared)
        current, held, index = None, [], None
        for batch in batches:
            blocks, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for begin, end in zip([0, *edges], [*edges, batch.num_rows]):
                if begin == end:
                    continue
                some = batch.slice(begin, end - begin)
                if blocks[begin] != current:
                    current, held, index = blocks[begin], [], None
                if kinds[begin] == 0:
                    held.append(some)
                    continue
                if not held and index is None:
                    continue
                if index is None:
                    index = Index(
                        codes, *[np.concatenate([h.column(c).to_numpy() for h in held]) for c in (2, 3)],
                        np.vstack([_matrix(h.column(4)) for h in held]), *[np.concatenate([h.column(c).to_numpy() for h in held]) for c in (5, 6)],
                    )
                    held = []
                out = []
                anchors = zip(some.column(2).to_pylist(), some.column(3).to_pylist(), _matrix(some.column(4)), some.column(7).to_pylist(), some.column(8).to_pylist())
                for anchor, label, a, goals, least in anchors:
                    if goals is None:
                        lists = [index.positives(anchor, label, a, least, settings.positives)]
                    else:
                        lists = index.negatives(label, a, [(-(-up * p // down), p) for p in goals], settings.negatives)
                    out += [(anchor, slot, ids, scores) for slot, (ids, scores) in enumerate(lists) if len(ids)]
                if out:
                    sizes = [len(ids) for _, _, ids, _ in out]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat([o[0] for o in out], sizes)), pa.array(np.full(sum(sizes), current)),
                            pa.array(np.repeat([o[1] for o in out], sizes).astype(np.int32)),
                            pa.array(np.concatenate([o[2] for o in out])), pa.array(np.concatenate([o[3] for o in out])),
                        ],
                        names,
                    )

    return rows.mapInArrow(run, "anchor_id long, block long, slot int, id long, score long")


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
         settings: Settings = Settings()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score; ``is_anchor`` is told from ``id``."""
    spark = vectors.sparkSession
    everyone = usable(vectors, settings, id_col, vector, label)
    sizes = everyone.groupBy(F.size("x").alias("size")).count().agg(F.max(F.struct("count", "size")).alias("m")).first()
    size = sizes.m["size"] if sizes.m else 1
    rows = everyone.filter(F.size("x") == size)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(settings.sample).select("x").toArrow().column(0).combine_chunks()
    points = sample.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, size)
    random, half = np.random.default_rng(settings.seed), (size + 1) // 2
    if not len(points):
        points = np.zeros((1, size))
    codes = Codes(half, codebook(points[:, :half], settings.codes, random), codebook(points[:, half:], settings.codes, random))

    placed = stored(_placed(rows, ship.broadcast(spark.sparkContext, codes)))
    cells = placed.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).collect()
    _dealt(codes, cells, settings.block)
    shared = ship.broadcast(spark.sparkContext, codes)
    where = spark.createDataFrame(
        [(*map(int, c), int(b), int(p)) for c, b, p in zip(codes.cells, codes.block, codes.parts)], "one int, two int, _first long, _parts long"
    )
    # a row per cell: codes x codes at most
    block = F.col("_first") + F.pmod(F.xxhash64("id"), F.col("_parts"))
    index = placed.join(F.broadcast(where), ["one", "two"]).select(block.alias("block"), "id", "label", "data", "one", "two")

    none = F.lit(None).cast("long")
    anchors = placed.filter(F.coalesce(is_anchor, F.lit(False))).select("id", "label", "data", F.lit(None).cast("array<bigint>").alias("goals"))
    k = settings.positives
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    seeds = stored(_searched(index, _routed(anchors.withColumns({"least": none, "skip": none}), shared, True), shared, settings))
    known = seeds.groupBy("anchor_id").agg(F.count(F.lit(1)).alias("_n"), F.min("score").alias("_least"), F.min("block").alias("skip"))
    known = known.select(F.col("anchor_id").alias("id"), F.when(F.col("_n") >= k, F.col("_least")).alias("least"), "skip")
    further = _searched(index, _routed(anchors.join(known, "id", "left"), shared, False), shared, settings)
    ranked = seeds.unionByName(further).withColumn("slot", F.row_number().over(best) - 1).filter(F.col("slot") < k)
    positives = stored(ranked.select("anchor_id", "slot", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))

    up, down = settings.low
    goals = positives.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("slot", "positive_score"))).alias("g"))
    goals = goals.select("id", F.col("g.positive_score").alias("goals")).withColumn("_low", F.array_min(F.filter("goals", lambda p: p >= 0)))
    goals = goals.filter("_low is not null").select("id", "goals", F.ceil(F.col("_low") * up / down).alias("least"), none.alias("skip"))
    offers = _searched(index, _routed(anchors.drop("goals").join(goals, "id"), shared, False), shared, settings)
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    chosen = offers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= settings.negatives)
    return positives.join(chosen, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
