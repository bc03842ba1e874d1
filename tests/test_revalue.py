import datetime as dt
import random
import re

import data
import pytest
import replay
from pyspark.sql import functions as F

from swapbook.operators import book, revalue
from swapbook.operators.revalue import DAY_US, revalue_on_each_tick, revalue_on_tick, seen_by_close

DAY0 = dt.date(2024, 1, 1)


def event_log(seed, trades=150, ticks=120, days=6, hot=None, two_foreign=0.0):
    """Trades re-sent at random and ticks in between, over some days; seq in microseconds."""
    rng = random.Random(seed)
    span = days * DAY_US
    times = rng.sample(range(span), trades + ticks)
    log = []
    for seq in times[:trades]:
        number = hot if hot is not None and rng.random() < 0.4 else rng.randint(0, trades // 3)
        # attributes that place a trade stay the same for an id
        log.append(data.trade(random.Random(number), number, seq, two_foreign, notional=float(rng.randint(30, 100))))
    moves = []
    for seq in times[trades:]:
        ccy = rng.choice(data.CURRENCIES[:3]) if rng.random() < 0.6 else rng.choice(data.CURRENCIES)
        moves.append((seq, DAY0 + dt.timedelta(seq // DAY_US), "USD", ccy, 0.5 + rng.random() / 2))
    return log, moves


def closing_ticks(ticks, width):
    last = {}
    for tick in sorted(ticks):
        last[(tick[3], tick[0] // width)] = tick
    return set(last.values())


@pytest.mark.parametrize("width", [DAY_US, DAY_US // 5, 3 * DAY_US])
@pytest.mark.parametrize("two_foreign", [0.0, 0.5])
@pytest.mark.parametrize("small", [True, False])
def test_replay_equals_event_by_event(spark, monkeypatch, width, two_foreign, small):
    if not small:
        monkeypatch.setattr(revalue, "BROADCAST_ROWS", 0)
    trades, ticks = event_log(21, hot=4, two_foreign=two_foreign)
    curve = data.curve_rates()
    rows = revalue_on_tick(
        data.trade_frame(spark, trades), data.tick_frame(spark, ticks), data.curve_frame(spark, curve), width=width
    ).select("close_seq", "id", "seq", "swapvalue", "price_status", "valuationdate")
    got = {(r.close_seq, r.id): (r.seq, r.swapvalue, r.price_status) for r in rows.collect()}
    closes = closing_ticks(ticks, width)
    expected = replay.valuations(trades, ticks, curve, keep=lambda tick: tick in closes)
    assert got.keys() == expected.keys() and len(got) > 50
    for key, (seq, amount, status) in expected.items():
        assert got[key][0] == seq and got[key][2] == status
        assert got[key][1] == (None if amount is None else pytest.approx(amount, rel=1e-12, abs=1e-9))


def test_trade_after_all_closes_and_book_without_ticks_give_no_rows(spark):
    trades = [
        data.trade(random.Random(1), 1, 100, xccy="EUR", payccy="EUR", receiveccy="USD"),
        data.trade(random.Random(1), 2, 10, xccy="JPY", payccy="JPY", receiveccy="USD"),
    ]
    ticks = [(100, DAY0, "USD", "EUR", 0.7)]
    rows = revalue_on_tick(
        data.trade_frame(spark, trades), data.tick_frame(spark, ticks), data.curve_frame(spark, data.curve_rates())
    )
    assert rows.count() == 0


def test_hot_trade_is_reduced_before_the_shuffle(spark):
    """40 000 amendments of one trade leave the map side as one row per close and task."""
    one = data.trade(random.Random(1), 1, 0, xccy="EUR", payccy="EUR", receiveccy="USD")
    messages = (
        data.trade_frame(spark, [one])
        .withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(39_999))))
        .withColumn("seq", F.col("n").cast("bigint") * 1000)
        .drop("n")
        .withColumnRenamed("xccy", "price")
        .repartition(4)
    )
    ticks = data.tick_frame(spark, [(s, DAY0, "USD", "EUR", 0.7) for s in (5_000_000, 25_000_000, 39_000_000)])
    closing = revalue.closes(ticks, 10_000_000)
    seen = seen_by_close(messages, closing, ("price", "id"), 10_000_000, True)
    assert {(r.close_no, r.seq) for r in seen.collect()} == {(1, 4_999_000), (2, 24_999_000), (3, 38_999_000)}
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Aggregate\(key=\[price#\d+, id#\d+, close_no#\d+], functions=\[partial_max", plan)


def test_book_is_last_write_per_currency_and_id(spark):
    rng = random.Random(2)
    a = data.trade(rng, 1, 5, payccy="EUR", receiveccy="USD", xccy="EUR")
    newer = {**a, "seq": 9, "notional": 1.0}
    elsewhere = {**a, "payccy": "JPY", "xccy": "JPY", "seq": 1}
    messages = data.trade_frame(spark, [a, newer, elsewhere]).drop("xccy")
    current = book.trade_book(book.with_currency(messages))
    assert {(r.xccy, r.seq, r.notional) for r in current.collect()} == {("EUR", 9, 1.0), ("JPY", 1, a["notional"])}
    assert [r.id for r in book.book_of_currency(book.with_currency(messages), "JPY").collect()] == ["SWAP1"]


def test_both_legs_usd_stay_in_a_book_of_their_own(spark):
    usd = data.trade(random.Random(2), 1, 5, payccy="USD", receiveccy="USD", xccy="?")
    messages = book.with_currency(data.trade_frame(spark, [usd]))
    assert [r.xccy for r in messages.collect()] == ["USD"]


def test_messages_per_batch(spark):
    frame = spark.createDataFrame([(0,), (9_999_999,), (10_000_000,), (-1,)], "seq BIGINT")
    assert {(r.batch, r.messages) for r in book.messages_per_batch(frame).collect()} == {(0, 2), (1, 1), (-1, 1)}


def test_tasks_of_the_result(spark):
    """A given number of tasks holds the same rows, each trade in one of them."""
    trades, moves = event_log(33, hot=4)
    messages, ticks, curve = data.trade_frame(spark, trades), data.tick_frame(spark, moves), data.curve_frame(spark, data.curve_rates())
    some = revalue_on_tick(messages, ticks, curve)
    dealt = revalue_on_tick(messages, ticks, curve, tasks=5).withColumn("_task", F.spark_partition_id())
    assert dealt.groupBy("xccy", "id").agg(F.countDistinct("_task").alias("n")).filter("n > 1").isEmpty()
    assert 1 < dealt.select("_task").distinct().count() <= 5
    assert some.exceptAll(dealt.drop("_task")).isEmpty() and some.count() == dealt.count()


@pytest.mark.parametrize("block", [4, 1024])
@pytest.mark.parametrize("two_foreign", [0.0, 0.5])
@pytest.mark.parametrize("small", [True, False])
def test_every_tick_equals_event_by_event(spark, monkeypatch, block, two_foreign, small):
    """Each single tick re-prices its book, whatever the blocks and joins."""
    monkeypatch.setattr(revalue, "BLOCK", block)
    if not small:
        monkeypatch.setattr(revalue, "BROADCAST_ROWS", 0)
    trades, ticks = event_log(57, hot=4, two_foreign=two_foreign)
    # ticks for another date in between, and one at the time of a trade
    moved = [(s, d - dt.timedelta(days=1) if i % 7 == 0 else d, *rest) for i, (s, d, *rest) in enumerate(ticks)]
    taken = {t[0] for t in moved}
    moved += [(t["seq"], DAY0, "USD", t["xccy"], 0.75) for t in trades[:9] if t["seq"] not in taken]
    curve = data.curve_rates()
    rows = revalue_on_each_tick(data.trade_frame(spark, trades), data.tick_frame(spark, moved), data.curve_frame(spark, curve))
    closes = revalue_on_tick(data.trade_frame(spark, trades), data.tick_frame(spark, moved), data.curve_frame(spark, curve))
    assert set(rows.columns) == set(closes.columns)
    found = rows.select("close_seq", "id", "seq", "swapvalue", "price_status").collect()
    got = {(r.close_seq, r.id): (r.seq, r.swapvalue, r.price_status) for r in found}
    expected = replay.valuations(trades, moved, curve)
    assert got.keys() == expected.keys() and len(got) == len(found) > 300
    for key, (seq, amount, status) in expected.items():
        assert got[key][0] == seq and got[key][2] == status
        assert got[key][1] == (None if amount is None else pytest.approx(amount, rel=1e-12, abs=1e-9))


def test_every_tick_of_odd_ticks(spark):
    """A tick sent twice re-prices twice; ticks without date or time, and of no known currency, re-price nothing."""
    trade = data.trade(random.Random(1), 1, 100, xccy="EUR", payccy="EUR", receiveccy="USD")
    late = {**trade, "id": "SWAP2", "seq": 4 * DAY_US}
    ticks = [(100, DAY0, "USD", "EUR", 0.7), (300, DAY0, "USD", "EUR", 0.8), (300, DAY0, "USD", "EUR", 0.8), (400, None, "USD", "EUR", 0.9)]
    ticks += [(None, DAY0, "USD", "EUR", 0.9), (500, DAY0, "USD", "USD", 0.9), (3 * DAY_US, DAY0, "USD", "EUR", None)]
    rows = revalue_on_each_tick(data.trade_frame(spark, [trade, late]), data.tick_frame(spark, ticks), data.curve_frame(spark, data.curve_rates()))
    assert sorted((r.close_seq, r.id) for r in rows.collect()) == [(300, "SWAP1"), (300, "SWAP1"), (3 * DAY_US, "SWAP1")]
    none = revalue_on_each_tick(data.trade_frame(spark, [trade]), data.tick_frame(spark, ticks).limit(0), data.curve_frame(spark, data.curve_rates()))
    assert none.count() == 0
