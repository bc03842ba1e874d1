"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from swapbook.llm import hard_negatives as h
from swapbook.llm.hard_negatives import Settings

TABLES = "/root/testdata/sf0.1"
SMALL = Settings(codes=5, block=40, sample=200)


def brute(rows, anchors, scale=256):
    """{(anchor, positive, rank, negative, positive score, negative score)} of [(id, label, vector)]."""
    rows = [(i, lab, [math.floor(scale * float(c)) for c in v]) for i, lab, v in rows]
    found = set()
    for a, label, x in rows:
        if not anchors(a):
            continue
        scores = [(-sum(p * q for p, q in zip(x, y)), i, lab) for i, lab, y in rows if i != a]
        for p, i, _ in sorted(s for s in scores if s[2] == label)[:5]:
            fit = sorted(s[:2] for s in scores if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p)
            found |= {(a, i, rank, j, -p, -n) for rank, (n, j) in enumerate(fit[:5], 1)}
    return found


def mined(df, **options):
    rows = [tuple(r) for r in h.mine(df, F.col("id") % 10 == 0, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def clustered(seed, n, d, labels, spread):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, d))
    return [(i, int(rng.integers(labels)), (centres[rng.integers(8)] + spread * rng.standard_normal(d)).tolist()) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(5)


def test_whole_table(spark):
    df = spark.read.parquet(f"{TABLES}/embeddings.parquet")
    got = {tuple(r) for r in h.mine(df, F.col("id") % 100 == 0, settings=Settings(block=300)).collect()}
    assert got == brute([(r.vec_id, r.label, r.embedding) for r in df.collect()], lambda i: i % 100 == 0)


@pytest.mark.parametrize("d, labels, spread", [(2, 3, 0.2), (7, 2, 0.05), (1, 4, 1.0), (12, 30, 0.5)])
def test_clusters(spark, d, labels, spread):
    rows = clustered(d, 500, d, labels, spread)
    assert mined(frame(spark, rows), settings=SMALL) == brute(rows, lambda i: i % 10 == 0)


def test_hot_vector_and_ties(spark):
    """A third of all rows share one vector, which is more than a block holds."""
    rows = clustered(3, 300, 4, 3, 0.3) + [(300 + i, i % 2, [1.0, 2.0, -1.0, 0.5]) for i in range(150)]
    assert mined(frame(spark, rows), settings=SMALL) == brute(rows, lambda i: i % 10 == 0)


def test_few_rows(spark):
    for rows in ([], [(0, 1, [1.0])], [(0, 1, [1.0]), (10, 1, [2.0])], [(0, 1, [1.0]), (1, 1, [2.0]), (2, 2, [1.5])], [(0, 1, [-1.0]), (1, 1, [1.0]), (2, 2, [1.0])]):
        assert mined(frame(spark, rows)) == brute(rows, lambda i: i % 10 == 0)


def test_large_numbers(spark):
    rows = clustered(5, 200, 6, 3, 0.3)
    rows = [(i, lab, [c * 15_000 for c in v]) for i, lab, v in rows]
    assert max(abs(c) for _, _, v in rows for c in v) < 65_536
    assert mined(frame(spark, rows), settings=SMALL) == brute(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(9, 120, 3, 2, 0.4)
    odd = [(200, None, [1.0, 1.0, 1.0]), (210, 1, None), (220, 1, [None, 1.0, 1.0]), (230, 0, [nan, 1.0, 1.0]), (240, 0, [inf, 1.0, 1.0]),
           (250, 0, [-inf, 1.0, 1.0]), (260, 0, []), (270, 0, [1.0]), (280, 0, [1e9, 0.0, 0.0]), (None, 0, [1.0, 1.0, 1.0])]
    df = frame(spark, rows + rows[:30] + odd).withColumns({"block": F.lit(1), "kind": F.lit(2), "id": F.lit(3), "data": F.lit(4), "one": F.lit(5)})
    assert mined(df, settings=SMALL) == brute(rows, lambda i: i % 10 == 0)
    # one id, two rows: the smaller label and vector counts
    twice = rows + [(0, 5, [0.0, 0.0, 0.0]), (1, -1, [0.5, 0.5, 0.5])]
    kept = [(1, -1, [0.5, 0.5, 0.5]), rows[0], *rows[2:]]
    assert mined(frame(spark, twice), settings=SMALL) == brute(kept, lambda i: i % 10 == 0)


def test_stops_early():
    """Cells with a bound below the last positive are not scored."""
    rng = np.random.default_rng(1)
    x = np.vstack([c + rng.integers(-3, 4, (1000, 4)) for c in 1000 * np.array([[1, 1, 1, 1], [-1, -1, -1, -1], [1, 1, -1, -1]])]).astype(float)
    codes = h.Codes(2, h.codebook(x[:, :2], 3, rng), h.codebook(x[:, 2:], 3, rng))
    one, two, _, _ = codes.place(x)
    index = h.Index(codes, np.arange(3000), np.zeros(3000, np.int64), x, one, two)
    scored = []
    whole = h.Index.strides
    own = index.of(0)
    own.strides = lambda a: (scored.append(len(s[1])) or s for s in whole(own, a))
    index.positives(-1, 0, np.array([900.0, 900, 900, 900]), None, 5)
    assert sum(scored) < 3000
