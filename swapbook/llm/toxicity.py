"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models over hashed words; each model also gets the
probabilities of the categories before it. For training these are out-of-fold predictions, so a later model learns
from probabilities as good as those it will meet. Words count once per document, as a whole and by their first four
and five letters, which also finds unseen forms of a known stem; the features that tell most about the category by
a chi-square score are used.

The models are fitted on the driver from at most ``MAX_LABELLED`` labelled documents, picked by a hash of their id
(word hashes only, not texts); every document is scored in Spark.

Defined cases: a null or wordless text has no features and gets the chance of a document without any, and no flag; labels that
are null, or that belong to no document, are left out; a category with one class only is predicted as its share;
repeated documents are scored each; documents without an id are scored too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swapbook.llm import ship
from swapbook.llm.text import whole

FEATURES = 1 << 18
MAX_LABELLED = 10_000
SELECTED = 4_000
FOLDS = 3
RIDGE = 1e-3
ROUNDS = 300


def features(text: Column) -> Column:
    """Sorted distinct feature numbers of a text."""
    words = F.array_distinct(F.array_remove(F.split(F.lower(whole(text)), "[^\\p{L}\\p{N}]+"), ""))

    def of(word: Column) -> Column:
        return F.array(F.xxhash64(word), F.xxhash64(F.lit(4), F.substring(word, 1, 4)), F.xxhash64(F.lit(5), F.substring(word, 1, 5)))

    hashes = F.flatten(F.transform(words, of))
    return F.array_distinct(F.transform(hashes, lambda h: F.pmod(h, F.lit(FEATURES)).cast("int")))


class Rows:
    """Feature numbers of several documents, one after the other."""

    def __init__(self, flat: np.ndarray, offsets: np.ndarray):
        self.flat, self.offsets = flat, offsets
        self.owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights[self.flat], len(self))

    def only(self, wanted: np.ndarray) -> Rows:
        """The same documents with the wanted features only."""
        keep = wanted[self.flat]
        sizes = np.bincount(self.owner[keep], minlength=len(self))
        return Rows(self.flat[keep], np.concatenate([[0], np.cumsum(sizes)]))

    def some(self, chosen: np.ndarray) -> Rows:
        keep = chosen[self.owner]
        return Rows(self.flat[keep], np.concatenate([[0], np.cumsum(np.diff(self.offsets)[chosen])]))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Link:
    """One category: weights of features and of earlier probabilities, and an intercept."""

    def __init__(self, rows: Rows, earlier: np.ndarray, y: np.ndarray):
        self.weights, self.chained, self.bias = np.zeros(FEATURES), np.zeros(earlier.shape[1]), 0.0
        share = y.mean() if len(y) else 0.0
        if share in (0.0, 1.0):
            self.bias = 30.0 if share else -30.0
            return
        wanted = np.zeros(FEATURES, bool)
        wanted[self.telling(rows, y)] = True
        rows = rows.only(wanted)
        self.bias = float(np.log(share / (1 - share)))
        # Adagrad over all rows; the step of a rare but telling feature does not shrink with the common ones
        g_w, g_c, g_b = np.full(FEATURES, 1e-12), np.full(earlier.shape[1], 1e-12), 1e-12
        for _ in range(ROUNDS):
            miss = self.predict(rows, earlier) - y
            d_w = np.bincount(rows.flat, miss[rows.owner], FEATURES) / len(y) + RIDGE * 0.01 * self.weights
            d_c, d_b = earlier.T @ miss / len(y) + RIDGE * self.chained, miss.mean()
            g_w, g_c, g_b = g_w + d_w**2, g_c + d_c**2, g_b + d_b**2
            self.weights -= 0.5 * d_w / np.sqrt(g_w) * wanted
            self.chained -= 0.2 * d_c / np.sqrt(g_c)
            self.bias -= 0.2 * d_b / np.sqrt(g_b)

    @staticmethod
    def telling(rows: Rows, y: np.ndarray) -> np.ndarray:
        """The features with the largest chi-square scores above what chance would give."""
        have, positive = np.bincount(rows.flat, minlength=FEATURES), np.bincount(rows.flat, y[rows.owner], FEATURES)
        n, p = len(y), y.sum()
        expected = have * p / n
        spread = expected * (1 - p / n) * (1 - have / n)
        score = np.where((have >= 3) & (spread > 0), (positive - expected) ** 2 / np.maximum(spread, 1e-9), 0)
        best = np.argsort(-score, kind="stable")[:SELECTED]
        return best[score[best] > 15]

    def predict(self, rows: Rows, earlier: np.ndarray) -> np.ndarray:
        return sigmoid(rows.sums(self.weights) + earlier @ self.chained + self.bias)


class Chain:
    """Links in the order of the categories, and the probability from which each is flagged."""

    def __init__(self, rows: Rows, labels: np.ndarray, folds: np.ndarray):
        self.links, self.limits = [], []
        earlier = np.zeros((len(rows), 0))
        for k in range(labels.shape[1]):
            y = labels[:, k].astype(float)
            self.links.append(Link(rows, earlier, y))
            outside = np.zeros(len(rows))
            for fold in range(FOLDS):
                out = folds == fold
                if out.any():
                    link = Link(rows.some(~out), earlier[~out], y[~out])
                    outside[out] = link.predict(rows.some(out), earlier[out])
            self.limits.append(self.best_limit(outside, y))
            earlier = np.column_stack([earlier, outside])

    @staticmethod
    def best_limit(p: np.ndarray, y: np.ndarray) -> float:
        """The threshold with the best F1 on out-of-fold predictions, the middle one of those that tie."""
        steps = np.linspace(0.05, 0.95, 19)
        hits = np.array([((p >= s) & (y > 0)).sum() for s in steps])
        f1 = 2 * hits / np.maximum(np.array([(p >= s).sum() for s in steps]) + y.sum(), 1)
        best = np.flatnonzero(f1 >= f1.max() - 1e-12)
        return float(steps[best[len(best) // 2]])

    def predict(self, rows: Rows) -> np.ndarray:
        done = np.zeros((len(rows), 0))
        for link in self.links:
            done = np.column_stack([done, link.predict(rows, done)])
        return done


def learn(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text: str = "text") -> Chain:
    """A chain for 0/1 columns of ``labels``, in the given order."""
    usable = labels.select(F.col(id_col).alias("_id"), *categories).dropna().dropDuplicates(["_id"])
    sample = usable.orderBy(F.xxhash64("_id"), "_id").limit(MAX_LABELLED)
    named = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_t"))
    joined = named.join(sample, "_id").select("_id", features(F.col("_t")).alias("f"), *categories)
    table = joined.orderBy(F.xxhash64("_id"), "_id").limit(MAX_LABELLED).toArrow()
    lists = table.column("f").combine_chunks()
    flat, offsets = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
    known = np.column_stack([table.column(c).to_numpy() for c in categories]) if len(table) else np.zeros((0, len(categories)))
    return Chain(Rows(flat, offsets), known, np.arange(len(table)) % FOLDS)


def score(docs: DataFrame, chain: Chain, categories: list[str], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ``p_<category>`` and the flag ``<category>`` of each document."""
    shared = ship.broadcast(docs.sparkSession.sparkContext, chain)
    kind = docs.schema[id_col].dataType.simpleString()
    fields = [f"p_{c} double" for c in categories] + [f"{c} boolean" for c in categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ship.received(shared)
        for batch in batches:
            lists = batch.column(1)
            offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            p = known.predict(Rows(lists.flatten().to_numpy(), offsets))
            flags = [pa.array((p[:, k] >= known.limits[k]) & (np.diff(offsets) > 0)) for k in range(len(categories))]
            names = ["doc_id", *[f"p_{c}" for c in categories], *categories]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(np.ascontiguousarray(x)) for x in p.T], *flags], names)

    narrow = docs.select(F.col(id_col).alias("doc_id"), features(F.col(text)).alias("f"))
    return narrow.mapInArrow(run, f"doc_id {kind}, {', '.join(fields)}")
