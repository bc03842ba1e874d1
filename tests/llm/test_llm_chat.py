"""Transcript parsing: the path against all paths, blocks against no blocks, roles against the true ones."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from swapbook.llm import chat
from swapbook.llm.queries import op10_chat_formatting, transcripts

TABLES = "/root/testdata/sf0.01"


def model(seed):
    rng = np.random.default_rng(seed)
    return chat.Model(rng.random(6) * 9, rng.random((6, 6)) * 9, rng.random((6, chat.SEEN)) * 9)


def test_best_path():
    for seed in range(3):
        m = model(seed)
        seen = np.random.default_rng(seed + 50).integers(0, chat.SEEN, 5)

        def score(path):
            total = m.start[path[0]] + m.show[path[0], seen[0]]
            return total + sum(m.move[a, b] + m.show[b, o] for a, b, o in zip(path, path[1:], seen[1:]))

        best = max(itertools.product(range(6), repeat=5), key=score)
        assert np.isclose(score(best), score(list(m.path(seen))))


def turns(spark, rows, m):
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string").withColumns({"line": F.lit(1), "block": F.lit(2), "seen": F.lit(3)})
    out = chat.rendered(chat.parse(chat.lines_of(df), m))
    return sorted(((r.conv, r.turn_no, r.role, r.n_lines, r.text, r.rendered) for r in out.collect()), key=str)


def test_blocks_give_the_path_of_the_whole(spark, monkeypatch):
    rng = np.random.default_rng(8)
    kinds = ["User: hello?", "Assistant: it is so", "System: be kind", "and more of it", "why", "Well, no?"]
    rows = [(c, t, "\n".join(rng.choice(kinds, rng.integers(1, 4)))) for c in (1, 2, None) for t in range(50)]
    m = model(1)
    whole = turns(spark, rows, m)
    monkeypatch.setattr(chat, "BLOCK", 7)
    assert turns(spark, rows, m) == whole
    assert sum(n for _, _, _, n, _, _ in whole) == sum(t.count("\n") + 1 for _, _, t in rows)


def test_roles_of_the_whole_table(spark):
    rows = spark.read.parquet(f"{TABLES}/conversations.parquet")
    raw = transcripts(rows)
    lines = chat.lines_of(raw)
    parsed = chat.parse(lines, chat.learn(raw.filter("conv_id % 3 <> 0"), rows.filter("conv_id % 3 <> 0")))
    out = chat.rendered(parsed)
    assert out.agg(F.sum("n_lines")).head()[0] == lines.count()
    # turns of conversations that were not learned from, where none was split or joined
    true = rows.filter("conv_id % 3 = 0").selectExpr("conv_id", "role", "text")
    same = out.filter("conv % 3 = 0").join(true, (F.col("conv") == true.conv_id) & (out.text == true.text))
    right, total = same.agg(F.count_if(out.role == true.role), F.count(F.lit(1))).head()
    # a floor below what was measured (146 of 191 turns come back whole), not a target
    assert total > 0.7 * true.distinct().count() and right > 0.9 * total


def test_defined_cases(spark):
    m = model(2)
    rows = [(1, 0, "User: hi"), (1, 0, "User: hi"), (1, 1, None), (None, None, ""), (None, 1, "Assistant: yes\nno"), (3, 0, "x\n" * 3000), (4, 1, "a"), (4, 1, "b")]
    out = turns(spark, rows, m)
    lines = {}
    for conv, _, _, n, _, _ in out:
        lines[conv] = lines.get(conv, 0) + n
    assert lines == {1: 2, None: 3, 3: 3001, 4: 2}
    assert all(r == f"<|{role}|>\n{text}<|end|>\n" for _, _, role, _, text, r in out)
    assert turns(spark, rows[:0], m) == []
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    unlabelled = chat.learn(df, df.withColumn("role", F.lit("other")))
    assert len(turns(spark, rows, unlabelled)) > 0


def test_query_covers_the_table(spark):
    lines = chat.lines_of(transcripts(spark.read.parquet(f"{TABLES}/conversations.parquet"))).count()
    assert op10_chat_formatting(spark, TABLES).agg(F.sum("n_lines")).head()[0] == lines
