import random

import data
import pytest
import replay
from pyspark.sql import functions as F
from test_revalue import DAY0, event_log

from swapbook.operators import book, tick_value
from swapbook.operators.revalue import DAY_US


def expected(trades, ticks, curve):
    """{tick seq: (trades, unpriced, value)} by pricing each pair of tick and trade."""
    found = {tick[0]: [0, 0, 0.0] for tick in ticks}
    for (seq, _), (_, amount, _) in replay.valuations(trades, ticks, curve).items():
        found[seq][0 if amount is not None else 1] += 1
        found[seq][2] += amount or 0.0
    return found


def valued(spark, trades, ticks, curve, **options):
    rows = tick_value.tick_book_value(
        data.trade_frame(spark, trades), data.tick_frame(spark, ticks), data.curve_frame(spark, curve), **options
    ).collect()
    found = {r.seq: (r.trades, r.unpriced, r.book_value) for r in rows}
    assert len(found) == len(rows)
    return found


def same(got, want):
    assert got.keys() == want.keys()
    for seq, (n, missing, value) in want.items():
        assert got[seq][:2] == (n, missing), seq
        assert got[seq][2] == pytest.approx(value, rel=1e-9, abs=1e-3)


@pytest.mark.parametrize("two_foreign, holes, most", [(0.0, 0.0, 50_000), (0.5, 0.05, 50_000), (0.5, 0.0, 3)])
def test_every_tick_equals_event_by_event(spark, two_foreign, holes, most):
    trades, ticks = event_log(51, trades=200, ticks=150, days=5, hot=4, two_foreign=two_foreign)
    curve = data.curve_rates(holes=holes)
    got = valued(spark, trades, ticks, curve, most=most, width=DAY_US // 3)
    same(got, expected(trades, ticks, curve))
    assert sum(n + missing for n, missing, _ in got.values()) > 500


def test_ticks_dated_another_day_and_empty_books(spark):
    """Ticks of a date may come at any time, and before any trade."""
    trades, ticks = event_log(52, trades=60, ticks=80, days=4, two_foreign=0.3)
    rng = random.Random(7)
    shuffled = [(seq, DAY0 + (day - DAY0) * rng.choice([0, 1, 2]), base, ccy, rate) for seq, day, base, ccy, rate in ticks]
    curve = data.curve_rates()
    same(valued(spark, trades, shuffled, curve), expected(trades, shuffled, curve))
    nothing = data.trade_frame(spark, trades).limit(0)
    empty = tick_value.tick_book_value(nothing, data.tick_frame(spark, ticks), data.curve_frame(spark, curve))
    assert {tuple(r) for r in empty.select("trades", "unpriced", "book_value").collect()} == {(0, 0, 0.0)} and empty.count() == len(ticks)
    assert tick_value.tick_book_value(data.trade_frame(spark, trades), data.tick_frame(spark, ticks).limit(0), data.curve_frame(spark, curve)).count() == 0


def test_a_burst_is_cut_into_short_blocks(spark):
    rows = spark.range(4000).select(F.lit("EUR").alias("price"), F.lit(DAY0).alias("date"), (F.col("id") * 10).alias("at"))
    width = tick_value.block_width(rows, 500)
    assert width <= 5000 and tick_value.block_width(rows, 5000) == tick_value.QUARTER_US
    same_instant = rows.withColumn("at", F.lit(5).cast("long"))
    assert tick_value.block_width(same_instant, 10) == 1


def test_next_message_of_a_key(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), seq, i) for i, seq in enumerate(rng.sample(range(1000), 200))] + [("c", 7, 1)]
    found = book.with_next(spark.createDataFrame(rows, "id string, seq long, x int"), ("id",), 37).collect()
    order = {k: sorted(s for i, s, _ in rows if i == k) for k in "abc"}
    for r in found:
        later = [s for s in order[r.id] if s > r.seq]
        assert r.next_seq == (later[0] if later else None)
    assert len(found) == len(rows)


def test_no_product_of_ticks_and_trades(spark):
    """Twice the ticks of a day do not make a row more before the running sums."""
    trades, ticks = event_log(53, trades=100, ticks=60, days=2)
    curve = data.curve_frame(spark, data.curve_rates())
    versions = book.with_next(data.trade_frame(spark, trades), ("xccy", "id"), DAY_US).withColumnRenamed("xccy", "price")
    more = [(seq + 1, *rest) for seq, *rest in ticks]
    rows = []
    for some in (ticks, sorted(ticks + more)[: 2 * len(ticks)]):
        spans = tick_value.tick_spans(tick_value.distinct_ticks(data.tick_frame(spark, some)))
        rows.append(tick_value.book_moves(versions, spans, curve).count())
    assert rows[1] <= rows[0] + 16
