"""Language ID and toxicity: accuracy on documents that were not learned from, and the defined cases."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from swapbook.llm import lang_id, toxicity

TABLES = "/root/testdata/sf0.1"


def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    truth = {r.doc_id: (r.lang, r.letter) for r in docs.select("doc_id", "lang", lang_id.has_letter(F.col("text")).alias("letter")).collect()}
    rows = lang_id.identify(docs).collect()
    assert len(rows) == len(truth)
    right = total = 0
    for r in rows:
        lang, letter = truth[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not letter)
        if r.held_out and lang is not None and letter:
            total += 1
            right += r.lang_pred == lang
    assert total > 1000 and right > 0.95 * total


def test_language_cases(spark):
    rows = [(i, "the cat and the dog " * 5, "en") for i in range(20)] + [(20 + i, "der hund und die katze " * 5, "de") for i in range(20)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "123 --- !", "en"), (103, "und die der " * 50_000, None), (None, "the dog", "xx"), (104, "the", None)]
    df = spark.createDataFrame(rows + rows[:1], "doc_id long, text string, lang string").withColumn("_text", F.lit(1))
    found = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.identify(df).collect()}
    assert found[0][0] == "en" and found[20][0] == "de" and found[103][0] == "de" and found[None][0] == "en"
    assert found[100] == found[101] == found[102] == ("und", 0.0)
    assert lang_id.identify(df.limit(0)).count() == 0
    nothing = lang_id.identify(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_ngrams_do_not_reach_the_next_text():
    alone, _ = lang_id.grams(["abc"])
    both, begins = lang_id.grams(["abc", "xyz"])
    assert (both[:, : begins[1]] == alone).all()


def test_toxicity_held_out(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    names = ["low_quality", "toxic"]
    chain = toxicity.learn(docs, labels.filter("doc_id % 3 <> 0"), names)
    assert chain.links[1].chained.shape == (1,)
    rows = toxicity.score(docs, chain, names).join(labels.filter("doc_id % 3 = 0").select("doc_id", F.col("toxic").alias("truth")), "doc_id").collect()
    truth, flag = np.array([r.truth == 1 for r in rows]), np.array([r.toxic for r in rows])
    assert truth.sum() > 10
    # a floor below what was measured (132 of 147), not a target
    assert (truth & flag).sum() >= 0.85 * truth.sum()
    assert (~truth & flag).sum() <= 0.02 * (~truth).sum()


def test_toxicity_cases(spark):
    rows = [(i, "vile hateful scum words here" if i % 3 == 0 else "a calm walk by the river") for i in range(90)]
    rows += [(200, None), (201, ""), (202, "vile " * 100_000), (None, "vile hateful scum"), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"toxic": F.lit(7), "f": F.lit(1)})
    marks = [(i, int(i % 3 == 0), 0) for i in range(90)] + [(91, None, 1), (999, 1, 1), (None, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, never int")
    chain = toxicity.learn(docs, labels, ["toxic", "never"])
    found = toxicity.score(docs, chain, ["toxic", "never"]).collect()
    assert len(found) == len(rows)
    flags = {r.doc_id: r.toxic for r in found}
    assert all(flags[i] == (i % 3 == 0) for i in range(90)) and flags[None] and flags[202] and not flags[200] and not flags[201]
    assert all(r.p_never < 1e-9 and not r.never for r in found)
    assert toxicity.score(docs.limit(0), chain, ["toxic", "never"]).count() == 0
    blank = toxicity.learn(docs.limit(0), labels.limit(0), ["toxic"])
    assert toxicity.score(docs, blank, ["toxic"]).filter("toxic").count() == 0
