"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of 1- to 3-grams per language come from all training documents: each task adds up its own texts in numpy and
hands out one row per language and bucket, which a partial aggregate sums. The smoothed log-probability matrix
(buckets x languages, bounded by BUCKETS and MAX_LANGUAGES) is broadcast, and batches of texts are scored by looking up
the rows of their n-grams and adding them per document.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is everything if nothing could be
learned; a null language or id is not learned from; equal scores go to the language that sorts first. A prediction
depends on the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swapbook.llm import ship

BUCKETS = 1 << 15
ORDERS = 3
SMOOTHING = 0.5
MAX_LANGUAGES = 500
CHARACTERS = 200_000
UNKNOWN = "und"


def held_out(id_col: str) -> Column:
    """Documents that are never learned from: remainder 2 of the id's CRC-32 by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def has_letter(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit("\\p{L}")), F.lit(False))


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket ids of all n-grams of the texts, order by order, and where each text begins.

    Texts are parted by two empty characters, so an n-gram sees the end of its text but never the next one.
    """
    joined = "\0\0".join(["", *texts, ""]).lower()
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    lengths = np.array([len(t.lower()) + 2 for t in texts])
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    total = int(lengths.sum())
    found = np.empty((ORDERS, total), np.int32)
    mixed = np.zeros(total, np.uint32)
    for order in range(ORDERS):
        mixed = (mixed ^ codes[order : order + total]) * np.uint32(0x9E3779B1) + np.uint32(order + 1)
        found[order] = ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> np.uint32(17)
    return found, begins


def chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > CHARACTERS:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def counted(training: DataFrame) -> DataFrame:
    """(lang, bucket, n, docs): n-gram counts per language; bucket -1 has the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs) if x == lang]
                total = sums.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                total[BUCKETS] += len(own)
                for start, end in chunks(own):
                    total[:BUCKETS] += np.bincount(grams(own[start:end])[0].ravel(), minlength=BUCKETS)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            names = pa.array([lang]).take(pa.array(np.zeros(len(at), np.int32)))
            yield pa.RecordBatch.from_arrays([names, pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "bucket", "n"])

    rows = training.select("lang", "text").mapInArrow(run, "lang string, bucket int, n long")
    return rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Languages and the log-probability matrix."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        docs, grams_of = counts[:, BUCKETS].astype(float), counts[:, :BUCKETS] + SMOOTHING
        self.prior = np.log(docs / docs.sum()) if len(langs) else docs
        self.matrix = np.ascontiguousarray(np.log(grams_of / grams_of.sum(axis=1, keepdims=True)).T)

    def posteriors(self, texts: list[str]) -> np.ndarray:
        scores = np.tile(self.prior, (len(texts), 1))
        for start, end in chunks(texts):
            found, begins = grams(texts[start:end])
            for order in range(ORDERS):
                scores[start:end] += np.add.reduceat(self.matrix[found[order]], begins, axis=0)
        scores -= scores.max(axis=1, keepdims=True)
        share = np.exp(scores)
        return share / share.sum(axis=1, keepdims=True)


def learn(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    training = docs.filter(
        ~held_out(id_col) & F.col(id_col).isNotNull() & F.col(lang).isNotNull() & has_letter(F.col(text))
    ).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    table = counted(training)
    table = table.limit(MAX_LANGUAGES * (BUCKETS + 1) + 1).toArrow()  # the bound of the matrix, and one row to see it passed
    langs = sorted(set(table.column("lang").to_pylist()))
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    index = {name: i for i, name in enumerate(langs)}
    counts = np.zeros((len(langs), BUCKETS + 1))
    at = np.array([index[name] for name in table.column("lang").to_pylist()], np.int64)
    counts[at, table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return Model(langs, counts)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``lang_pred`` and ``score``."""
    shared = ship.broadcast(docs.sparkSession.sparkContext, model)
    others = [c for c in docs.columns if c != text]
    usable = docs.select(*others, F.when(has_letter(F.col(text)), F.col(text)).alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in usable.schema.fields if f.name != "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ship.received(shared)
        for batch in batches:
            texts = batch.column(len(others)).to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            at = [i for i, t in enumerate(texts) if t is not None]
            if at and known.langs:
                share = known.posteriors([texts[i] for i in at])
                best = share.argmax(axis=1)
                scores[at] = share[np.arange(len(at)), best]
                for i, k in zip(at, best):
                    names[i] = known.langs[k]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(others)], pa.array(names, pa.string()), pa.array(scores)], [*others, "lang_pred", "score"]
            )

    return usable.mapInArrow(run, f"{fields}, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document."""
    model = learn(docs, id_col, text, lang)
    narrow = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text).alias("text"))
    return predict(narrow, model)
