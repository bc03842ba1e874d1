"""Line dedup and mixing against DuckDB and plain Python."""

import collections

import pytest
from pyspark.sql import functions as F

import oracle_check
from swapbook.llm import line_dedup, mixing

TABLES = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_line_dedup", "op6_mixing"])
def test_as_in_sql(spark, name):
    good, note = oracle_check.compare(spark, oracle_check.connect(TABLES), TABLES, name)
    assert good, note


def test_boilerplate_of_a_host(spark):
    pages = [(i, "a", f"menu\nbody {i}\n\nfoot {i % 2}\nfoot {i % 2}") for i in range(10)]
    pages += [(10 + i, None, "menu\nown") for i in range(4)] + [(20, "b", None), (21, "b", ""), (22, "a", "menu")]
    pages += [(22, "a", "menu")]
    df = spark.createDataFrame(pages, "page_id long, host string, text string").withColumn("_over", F.lit(1))
    found = line_dedup.drop_boilerplate(df, ratio=0.3, least_pages=5, counts=True)
    assert found.columns == ["page_id", "host", "text", "_over", "n_lines", "n_dropped"]
    rows = collections.defaultdict(list)
    for r in found.collect():
        rows[r.page_id].append((r.text, r.n_lines, r.n_dropped))
    # both foot lines stand on 5 of 12 pages
    assert rows[0] == [("body 0\n", 5, 3)]
    assert rows[10] == [("menu\nown", 2, 0)]  # a host of four pages loses nothing
    assert rows[20] == [(None, 0, 0)] and rows[21] == [("", 1, 0)]
    assert rows[22] == [("", 1, 1)] * 2
    assert line_dedup.drop_boilerplate(df.limit(0)).count() == 0


def test_hosts_and_page_texts(spark):
    urls = [("HTTPS://User:pw@Www.X.org:80/a?b", "www.x.org"), ("nothing", None), (None, None), ("http://h", "h")]
    df = spark.createDataFrame(urls, "url string, expected string")
    assert all(r.h == r.expected for r in df.select(line_dedup.host(F.col("url")).alias("h"), "expected").collect())
    html = "<html><script>x<y</script><body><p>One <b>two</b></p><div>three</div><!-- no --></body></html>"
    text = spark.createDataFrame([(html,)], "html string").select(line_dedup.page_text(F.col("html"))).head()[0]
    assert [x for x in text.split("\n") if x] == ["One two", "three"]


def mixed(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df, {r.doc_id: r for r in mixing.mix(df).collect()}


def test_targets_and_limits(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 9)), ["a", "b", "c", None][min(i % 10, 3)]) for i in range(2000)]
    rows += [(5000, None, "a"), (5001, "", "b"), (5002, " ", "empty"), (5003, "w " * 20_000, None)]
    df, found = mixed(spark, rows)
    assert len(found) == len(rows)
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for i, text, source in rows:
        r = found[i]
        assert r.size == len((text or "").split()) and r.taken <= 2 * r.size
        sizes[source] += r.size
        taken[source] += r.taken
        target[source] = r.target
    # water level by plain halving
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    low, high = 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(level * weight[s], 2 * sizes[s]) for s in names) < 1.5 * sum(sizes.values()) else (low, level)
    for s in names:
        assert abs(target[s] - min(low * weight[s], 2 * sizes[s])) < 1e-3
        assert abs(taken[s] - target[s]) <= max([found[i].size for i, _, x in rows if x == s])
    assert {r.doc_id: r for r in mixing.mix(df.repartition(5)).collect()} == found


def test_sequence_holds_each_document_as_often_as_taken(spark):
    rows = [(i, f"w{i} " * (1 + i % 5), "ab"[i % 2]) for i in range(200)]
    df, found = mixed(spark, rows)
    odd = df.withColumns({"_size": F.lit(1), "_starts": F.lit("x"), "_doc": F.lit(2)})
    sequence = mixing.curriculum(odd)
    assert sequence.columns == odd.columns
    times = collections.Counter(r.doc_id for r in sequence.collect())
    assert all(times[i] * r.size == r.taken for i, r in found.items())
    assert mixing.curriculum(df.limit(0)).count() == 0 and mixing.mix(df.limit(0)).count() == 0


def test_repeated_rows(spark):
    rows = [(7, "a b c", "s")] * 6 + [(None, "a", "s"), (8, "b", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert mixing.mix(df).count() == 8


def test_pages_are_counted_without_their_texts(spark):
    pages = spark.createDataFrame([(i, "a", f"menu\nbody {i}") for i in range(10)], "page_id long, host string, text string")
    over = line_dedup.boilerplate(pages, "host", "text", 0.3, 5)
    assert over._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1
    assert [len(r._over) for r in over.collect()] == [1]


def test_mix_is_the_sequence_of_all_passes(spark):
    """Rows come in training order, and the times of all passes are those of the sequence."""
    rows = [(i, f"w{i} " * (1 + i % 5), "ab"[i % 2]) for i in range(300)]
    df, _ = mixed(spark, rows)
    found = mixing.mix(df.repartition(7)).collect()
    first = [r.position for r in found if r.position is not None]
    assert first == sorted(first) and [r.position for r in found[: len(first)]] == first and len(found) == 300
    assert all((r.positions[0] if r.positions else None) == r.position and len(r.positions) * r.size == r.taken for r in found)
    assert max(len(r.positions) for r in found) == 2
    times = sorted((at, r.doc_id) for r in found for at in r.positions)
    sequence = [r.doc_id for r in mixing.curriculum(df).collect()]
    assert len(sequence) == len(times)
    at_of = collections.defaultdict(list)
    for at, doc in times:
        at_of[doc].append(at)
    order = [at_of[doc].pop(0) for doc in sequence]
    assert order == sorted(order)
