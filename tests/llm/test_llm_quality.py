"""Quality rules against plain Python counts, and the outlier test on planted vectors."""

import math
import re

import numpy as np
from pyspark.sql import functions as F

from swapbook.llm import quality

TABLES = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(8)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(words) < 20 or 100 * len(covered) > 30 * len(words),
    )


def check(spark, docs):
    rows = {r.doc_id: r for r in quality.assess(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert rows.keys() == texts.keys()
    for key, text in texts.items():
        r = rows[key]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == counts(text), key
        assert not (r.base_failed and r.kept)
    return rows


def test_whole_table(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    check(spark, docs)
    kept = {r.doc_id for r in quality.assess(docs).filter("kept").collect()}
    assert {r.doc_id for r in quality.accepted(docs).collect()} == kept


def test_defined_cases(spark):
    long_text = " ".join(f"w{i % 30011}x{i % 7}" for i in range(120_000))
    run = "one two three four five six seven eight"
    texts = [None, "", " \n\t\n", "a", f"{run}\n{run}\n{run}", f"x {run} y {run} " * 2, "    éé", long_text, "a a a a a a a a a a"]
    docs = spark.createDataFrame([(i, t, None, "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    check(spark, docs)
    assert quality.assess(docs.limit(0)).count() == 0
    assert quality.accepted(docs.limit(0)).count() == 0
    clashing = docs.withColumns({"n_words": F.lit(1), "_words": F.lit("x"), "kept": F.lit("y"), "_doc": F.lit(0), "g0": F.lit(3)})
    assert quality.accepted(clashing).columns == clashing.columns


def test_outliers_go_and_regular_rows_stay(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        n = int(60 + rng.integers(0, 120))
        words = ["".join(rng.choice(list("abcdefghij"), int(rng.integers(3, 9)))) for _ in range(n)]
        rows.append((i, " ".join(words), "en", "web" if i % 2 else None))
    for i in range(400, 440):  # symbols and endless words, a tenth of the table
        rows.append((i, " ".join("#$%&" * 40 + str(k) for k in range(50)), "en", "web" if i % 2 else None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    first = {r.doc_id: r.kept for r in quality.assess(docs).collect()}
    assert not any(first[i] for i in range(400, 440))
    assert all(first[i] for i in range(400))
    again = {r.doc_id: r.kept for r in quality.assess(docs.repartition(7)).collect()}
    assert again == first


def test_a_small_group_rejects_nothing(spark):
    text = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(i, text if i else " ".join(f"#{k}" for k in range(60)), "en", "s") for i in range(20)], "doc_id long, text string, lang string, source string")
    assert quality.assess(docs).filter("kept").count() == 20


def test_small_groups_are_judged_by_the_pool_they_share(spark):
    """Twelve sources of ten documents: none is large enough, the language is; a lone language goes by the rest of the table."""
    rng = np.random.default_rng(6)
    plain = lambda: " ".join("".join(rng.choice(list("abcdefgh"), int(rng.integers(3, 9)))) for _ in range(int(rng.integers(50, 150))))
    junk = " ".join("#$%&" * 40 + str(k) for k in range(50))
    rows = [(i, plain(), "en", f"s{i % 12}") for i in range(120)] + [(200 + i, junk, "en", f"s{i}") for i in range(6)]
    rows += [(300 + i, plain(), f"l{i % 30}", None) for i in range(60)] + [(400, junk, "l1", "x"), (401, junk, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in quality.assess(docs).collect()}
    assert {i for i, r in found.items() if not r.kept} == {*range(200, 206), 400, 401}
    assert all(r.distance is not None for r in found.values())
    assert {r.doc_id for r in quality.accepted(docs).collect()} == {i for i, r in found.items() if r.kept}


def test_pools_of_groups(spark):
    sizes = {("a", "x"): 60, ("a", "y"): 30, ("a", "z"): 25, ("b", "x"): 49, ("c", "x"): 1, ("d", "x"): 50}
    rows = [(g, h) for (g, h), n in sizes.items() for _ in range(n)]
    found = {tuple(r)[:2]: tuple(r)[2:] for r in quality.pools(spark.createDataFrame(rows, "g0 string, g1 string"), ["g0", "g1"], quality.Rules()).collect()}
    assert found == {
        ("a", "x"): ("a", "x"), ("a", "y"): ("a", "*"), ("a", "z"): ("a", "*"), ("b", "x"): ("*", "*"), ("c", "x"): ("*", "*"),
        ("d", "x"): ("d", "x"),
    }


def test_chi_square():
    assert math.isclose(quality.chi_square_limit(0.975, 5), 12.832501994030027, rel_tol=1e-9)


def test_native(spark):
    plan = quality.assess(spark.read.parquet(f"{TABLES}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
