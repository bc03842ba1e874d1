"""Event-time conflation: the result does not depend on how the stream is split or ordered."""

import random

import data
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_revalue import event_log
from test_streaming import same, stored

from swapbook.operators.revalue import DAY_US, revalue_on_tick
from swapbook.sources import messages
from swapbook.streaming import conflation, frames, jobs, sinks


def run(spark, folder, curve, schema, **options):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    priced = jobs.conflated_revaluations(stream, curve, DAY_US, buckets=3, **options)
    out = priced.select("tick_seq", "id", "trade_seq", "swapvalue", "price_status")
    query = jobs.writer(out, sinks.append_sink(f"{folder}/out"), f"{folder}/state", "conflated", available_now=True).start()
    query.awaitTermination(300)
    assert query.exception() is None
    return query


def put(spark, folder, events, end=False):
    if end:
        clock = spark.range(1).select(F.lit(jobs.CLOCK).alias("kind"), F.lit("").alias("xccy"), F.lit(9 * 10**15).cast("long").alias("seq"))
        events = events.limit(0).unionByName(clock, allowMissingColumns=True)
    events.coalesce(1).write.mode("append").parquet(f"{folder}/in")


@pytest.mark.parametrize("parts, mixed, two_foreign", [(1, False, 0.0), (4, True, 0.4)])
def test_equals_the_batch_replay(spark, folder, parts, mixed, two_foreign):
    trades, ticks = event_log(61, trades=160, ticks=90, days=4, two_foreign=two_foreign)
    curve = data.curve_frame(spark, data.curve_rates())
    trade_frame, tick_frame = data.trade_frame(spark, trades), data.tick_frame(spark, ticks)
    events = jobs.as_events(trade_frame, tick_frame)
    seqs = [t["seq"] for t in trades] + [t[0] for t in ticks]
    random.Random(1).shuffle(seqs) if mixed else seqs.sort()
    size = -(-len(seqs) // parts)
    for part in range(parts):
        put(spark, folder, events.filter(F.col("seq").isin(seqs[part * size : (part + 1) * size])))
        if part == 1:  # stop here, then go on from the checkpoint
            run(spark, folder, curve, events.schema, delay="10 days")
    put(spark, folder, events, end=True)
    run(spark, folder, curve, events.schema, delay="10 days")
    batch = revalue_on_tick(trade_frame, tick_frame, curve, width=DAY_US)
    expected = {(r.close_seq, r.id): (r.seq, r.swapvalue, r.price_status) for r in batch.collect()}
    assert len(expected) > 50
    same(stored(spark, folder), expected)


def test_windows_close_as_the_watermark_passes(spark, folder):
    """Without a clock row the last window waits; rows that come too late are left out."""
    eur = lambda n, seq: data.trade(random.Random(1), n, seq, payccy="EUR", receiveccy="USD", xccy="EUR")
    day = event_log(1)[1][0][1]
    first = [(DAY_US // 2, day, "USD", "EUR", 0.7), (3 * DAY_US, day, "USD", "EUR", 0.8)]
    curve = data.curve_frame(spark, data.curve_rates())
    events = jobs.as_events(data.trade_frame(spark, [eur(1, 5)]), data.tick_frame(spark, first))
    put(spark, folder, events)
    run(spark, folder, curve, events.schema, delay="1 hour")
    assert set(stored(spark, folder)) == {(DAY_US // 2, "SWAP1")}
    late = jobs.as_events(data.trade_frame(spark, [eur(2, 6)]), data.tick_frame(spark, [(DAY_US // 2 + 1, day, "USD", "EUR", 0.9)]))
    put(spark, folder, late)
    put(spark, folder, events, end=True)
    run(spark, folder, curve, events.schema, delay="1 hour")
    assert set(stored(spark, folder)) == {(DAY_US // 2, "SWAP1"), (3 * DAY_US, "SWAP1")}


def test_only_last_ticks_are_sent_to_the_buckets(spark):
    trades, ticks = event_log(62, trades=40, ticks=200, days=3)
    events = jobs.as_events(data.trade_frame(spark, trades), data.tick_frame(spark, [*ticks, (7, None, "USD", None, 0.5)]))
    left = events.coalesce(1).mapInArrow(conflation.last_ticks(messages.TICK, DAY_US), events.schema)
    rows = left.collect()
    assert sorted(r.seq for r in rows if r.kind == messages.TRADE) == sorted(t["seq"] for t in trades)
    newest = {}
    for seq, _, _, ccy, rate in sorted(ticks, key=lambda t: t[0]):
        newest[ccy, seq // DAY_US] = (seq, rate)
    known = [(r.price, r.seq // DAY_US, r.seq, r.rate) for r in rows if r.kind == messages.TICK and r.price is not None]
    assert sorted(known) == sorted((c, w, *at) for (c, w), at in newest.items()) and len(known) < len(ticks) / 4
    assert [r.seq for r in rows if r.kind == messages.TICK and r.price is None] == [7]


def test_own_ticks_only(spark, folder):
    trades, ticks = event_log(63, trades=120, ticks=90, days=4)
    curve = data.curve_frame(spark, data.curve_rates())
    trade_frame, tick_frame = data.trade_frame(spark, trades), data.tick_frame(spark, ticks)
    events = jobs.as_events(trade_frame, tick_frame)
    for part in range(3):
        put(spark, folder, events.filter(F.col("seq") % 3 == part))
    put(spark, folder, events, end=True)
    run(spark, folder, curve, events.schema, delay="10 days", all_currencies=False)
    batch = revalue_on_tick(trade_frame, tick_frame, curve, width=DAY_US)
    same(stored(spark, folder), {(r.close_seq, r.id): (r.seq, r.swapvalue, r.price_status) for r in batch.collect()})


def test_state_is_compressed():
    """A book in state takes a fraction of its Arrow table, and reads back as it was."""
    rng = random.Random(5)
    book = pd.DataFrame([{**data.trade(rng, n, n), "place": ""} for n in range(5000)])[frames.BOOK.names]
    state = frames.packed(book, frames.BOOK)
    assert len(state) * 3 < pa.Table.from_pandas(book, frames.BOOK, preserve_index=False).nbytes
    back = frames.unpacked(state, frames.BOOK)
    assert all(list(back[name]) == list(book[name]) for name in frames.BOOK.names)
