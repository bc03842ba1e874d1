"""Near-duplicates against all pairs, also with buckets that are forced to go by prefixes."""

import random
import re

import pytest

from swapbook.llm import near_dup, store
from swapbook.llm.components import components

TABLES = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = WORD.findall((text or "").translate(UPPER_TO_LOWER))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets}


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect()}


def corpus(seed, n=60):
    rng = random.Random(seed)

    def text(k):
        return [f"w{rng.randrange(5000)}" for _ in range(k)]

    shared = text(70)  # a passage in many texts
    texts = []
    for _ in range(n):
        body = text(rng.randrange(1, 200))
        texts.append(body if rng.random() < 0.5 else shared + body)
    for _ in range(2 * n):
        copy = list(rng.choice(texts))
        for _ in range(rng.randrange(0, 1 + len(copy) // 25)):
            copy[rng.randrange(len(copy))] = "changed"
        texts.append(copy)
    rows = [" ".join(t) if rng.random() < 0.8 else " \n".join(t).upper() for t in texts]
    rows += [None, "", " \t", "one", "ONE", "one two", "one  two\n", "a b c d e", "A b c d e", "ÄB", "äb"]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return list(zip(order, rows))


@pytest.mark.parametrize("direct", [64, 1])
def test_all_pairs(spark, direct, monkeypatch):
    monkeypatch.setattr(near_dup, "DIRECT", direct)
    rows = corpus(direct)
    assert found(spark, rows) == brute(rows)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()]
    assert found(spark, rows) == brute(rows)


def test_exactly_at_the_threshold(spark):
    words = [f"w{i}" for i in range(11)]  # 7 shingles
    near, apart = words[:10], words[:9]  # 6 of 7 and 5 of 7
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(apart)), (4, " ".join(f"x{i}" for i in range(12))), (5, " ".join(f"x{i}" for i in range(10)))]
    # 6 of 8 is 75 per cent
    assert found(spark, rows) == brute(rows)
    assert brute(rows)[5][1] == 4


def test_repeated_and_missing_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (1, text), (2, text), (None, text), (3, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as node", "'x' as component")
    rows = [(r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect()]
    assert sorted(rows, key=str) == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (None, None, True), (3, 3, True), (None, None, True)], key=str)
    single = near_dup.one_of_each(df)
    assert single.columns == df.columns
    assert sorted((r.doc_id for r in single.collect()), key=str) == sorted([1, 3, None, None], key=str)
    assert near_dup.near_duplicates(df.limit(0)).count() == 0 and near_dup.one_of_each(df.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 300), (300, 500), (9, 9)], "a long, b long")
    labels = {r.node: r.component for r in components(links).collect()}
    assert labels == {**{i: 0 for i in range(101)}, 300: 300, 500: 300}


def test_texts_that_are_alike_but_apart_form_no_pairs(spark):
    shared = [10_000 + i for i in range(80)]
    sets, nodes = [], []
    for k in range(30):  # 80 of 100 shingles in all of them: two thirds of each union
        sets.append((k, sorted(shared + [100 * k + i for i in range(20)])))
        nodes.append((k, k))
    sets.append((30, sorted(shared + list(range(17)) + [90_000, 90_001, 90_002])))  # 97 of 103 with the first one
    nodes.append((30, 30))
    pairs = near_dup._by_prefixes(spark.createDataFrame(nodes, "node long, component long"), spark.createDataFrame(sets, "node long, items array<long>"))
    assert [(r.a, r.b) for r in pairs.collect()] == [(0, 30)]


@pytest.mark.parametrize("counters", [1 << 21, 4])
def test_prefixes_make_no_row_per_shingle(spark, monkeypatch, counters):
    monkeypatch.setattr(near_dup, "COUNTERS", counters)
    shared, rng = list(range(10_000, 10_080)), random.Random(5)
    sets = [(k, sorted(shared + [100 * k + i for i in range(20)])) for k in range(60)]
    sets += [(100 + k, sorted(rng.sample(sets[k][1], 97) + [50_000 + k])) for k in range(20)] + [(200, [7]), (201, [7]), (202, [])]
    nodes = spark.createDataFrame([(i, i) for i, _ in sets], "node long, component long")
    frame = spark.createDataFrame(sets, "node long, items array<long>")
    of = {i: set(s) for i, s in sets}
    alike = {(a, b) for a in of for b in of if a < b and of[a] and 100 * len(of[a] & of[b]) >= 75 * len(of[a] | of[b])}
    pairs = near_dup._by_prefixes(nodes, frame)
    assert len(alike) == 21 and alike <= {(r.a, r.b) for r in pairs.collect()}
    if counters > 4:  # a quarter of each set at most, and none that has no second owner
        full = nodes.join(frame, "node")
        posted = near_dup._posted(full, near_dup._levels(full)).collect()
        assert len(posted) < sum(map(len, of.values())) / 6
        assert all(r.before <= r.n / 4 and sum(r.item in s for s in of.values()) > 1 for r in posted)


def test_links_lie_in_few_partitions(spark):
    links = spark.range(50).selectExpr("id as a", "id + 1 as b").repartition(40)
    assert components(links).rdd.getNumPartitions() == 1


def test_sets_are_not_moved_by_a_join(spark):
    sets = spark.createDataFrame([(i, [i]) for i in range(100)], "node long, items array<long>")
    with store.bucketed(sets, "node") as table:
        joined = spark.range(100).withColumnRenamed("id", "node").hint("merge").join(table, "node")
        assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        assert joined.count() == 100
        name = [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]
    assert name and not [t.name for t in spark.catalog.listTables() if t.name in name]
