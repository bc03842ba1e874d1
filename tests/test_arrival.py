"""The order of messages over topics and partitions: as a number, and as time and place in state."""

import collections
import datetime as dt
import random

import data
import pandas as pd
import pyarrow as pa
import pytest
import replay
from pyspark.sql import functions as F
from test_conflation import put
from test_revalue import event_log
from test_streaming import same, stored, texts

from swapbook.operators.revalue import DAY_US, revalue_in_order
from swapbook.schemas import TRADE_COLUMNS
from swapbook.sources import arrival, kafka, messages
from swapbook.streaming import jobs, sinks
from swapbook.streaming.frames import RATE, packed, unpacked

SCHEMA = "value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
CLOCK_US = 6 * 3_600_000_000
EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
START = EPOCH + dt.timedelta(20)  # a stream takes rows at its first watermark, the epoch, for late ones


def as_records(trades, ticks):
    """The log in two partitions per topic, under a clock that moves every six hours, so that many messages share a time."""
    keyed = [((t["seq"], 1), t["xccy"]) for t in trades] + [((t[0], 0), t[3]) for t in ticks]
    rows, offsets = [], collections.Counter()
    rng = random.Random(3)
    for ((seq, _), ccy), (_, text) in zip(sorted(keyed), texts(trades, ticks)):
        part = (f"xccy_swaps_{ccy}", rng.randint(0, 1))
        rows.append((bytearray(text.encode()), *part, offsets[part], START + dt.timedelta(microseconds=seq // CLOCK_US * CLOCK_US)))
        offsets[part] += rng.randint(1, 3)  # compacted topics have gaps
    return rows


def in_order(rows):
    return sorted(rows, key=lambda r: (r[4], r[1], r[2], r[3]))


def batch_events(spark, rows):
    values = kafka.message_values(spark.createDataFrame(rows, SCHEMA))
    return messages.accepted(messages.events(messages.decode(arrival.numbered(values))))


def parted(events):
    trades = events.filter(F.col("kind") == messages.TRADE).select("seq", *TRADE_COLUMNS, "xccy")
    ticks = events.filter(F.col("kind") == messages.TICK)
    return trades, ticks.select("seq", F.col("tick_date").alias("date"), "price", "rate")


def test_numbers_follow_the_order(spark):
    rows = as_records(*event_log(8, trades=60, ticks=60, days=2))
    values = kafka.message_values(spark.createDataFrame(rows, SCHEMA).repartition(7))
    got = [(r.topic, r.partition, r.offset) for r in arrival.numbered(values).orderBy("seq").collect()]
    assert got == [(r[1], r[2], r[3]) for r in in_order(rows)]
    by_place = [(r.topic, r.partition, r.offset) for r in sorted(values.collect(), key=lambda r: (r.seq, r.place))]
    assert by_place == got


def test_defined_cases_of_numbers(spark):
    schema = "arrived LONG, topic STRING, partition INT, offset LONG, _no INT, seq LONG"
    rows = [(1999, "a", 0, 5, 1, 9), (1000, "a", 0, 5, 2, 9), (1000, "a", 1, 0, 3, 9), (1000, "a0", 0, 0, 4, 9), (-1, "b", 0, 0, 5, 9)]
    rows += [(None, "a", 0, 1, 6, 9), (1000, None, 0, 1, 7, 9), (1000, "a", None, 1, 8, 9), (1000, "a", 0, None, 9, 9)]
    frame = spark.createDataFrame(rows, schema)
    found = {r[0]: r[1] for r in arrival.numbered(frame.withColumnRenamed("_no", "name")).select("name", "seq").collect()}
    one = 1 << arrival.BITS
    assert found == {1: one, 2: one, 3: one + 1, 4: one + 2, 5: -one, 6: None, 7: None, 8: None, 9: None}
    assert arrival.numbered(frame.drop("_no").limit(0)).collect() == []
    assert [arrival.width(DAY_US), spark.range(1).select(arrival.micros(F.lit(7 * one + 3))).first()[0]] == [86_400_000 * one, 7000]


def test_numbers_take_one_move_of_the_records(spark):
    rows = [(1000, "a", 0, n // 2) for n in range(20)] + [(None, "a", 0, 1), (1000, "a", 1, 0)]
    found = arrival.numbered(spark.createDataFrame(rows, "arrived LONG, topic STRING, partition INT, offset LONG"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    one = 1 << arrival.BITS
    assert sorted(r.seq for r in found.collect() if r.seq is not None) == sorted([one + n // 2 for n in range(20)] + [one + 10])


def test_more_than_a_millisecond_holds_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(arrival, "BITS", 2)
    five = spark.range(5).select(F.lit(0).cast("long").alias("arrived"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    with pytest.raises(Exception, match="more messages in a millisecond"):
        arrival.numbered(five).collect()


@pytest.mark.parametrize("split", ["one file", "files in order", "files of partitions, last first"])
def test_stream_over_partitions_equals_the_batch(spark, folder, split):
    rows = as_records(*event_log(62, trades=160, ticks=90, days=4, two_foreign=0.4))
    curve = data.curve_frame(spark, data.curve_rates())
    trades, ticks = parted(batch_events(spark, rows))
    batch = revalue_in_order(trades, ticks, curve).collect()
    us = lambda n: (n >> arrival.BITS) * 1000
    expected = {(us(r.close_seq), r.id): (us(r.seq), r.swapvalue, r.price_status) for r in batch}
    assert len(expected) > 50 and sum(r.close_seq >> arrival.BITS == r.seq >> arrival.BITS for r in batch) > 0
    parts = {"one file": [rows], "files in order": [rows[k : k + 64] for k in range(0, len(rows), 64)]}.get(split)
    if parts is None:
        places = sorted({r[1:3] for r in rows}, reverse=True)
        parts = [[r for r in rows if r[1:3] == p] for p in places]
    typed = lambda part: messages.accepted(messages.events(messages.decode(kafka.message_values(spark.createDataFrame(part, SCHEMA)))))
    for part in parts:
        put(spark, folder, typed(part))
    put(spark, folder, typed(rows), end=True)
    stream = spark.readStream.schema(typed(rows).schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    priced = jobs.conflated_revaluations(stream, curve, DAY_US, buckets=3, delay="10 days")
    out = priced.select("tick_seq", "id", "trade_seq", "swapvalue", "price_status")
    query = jobs.writer(out, sinks.append_sink(f"{folder}/out"), f"{folder}/state", "placed", available_now=True).start()
    query.awaitTermination(300)
    assert query.exception() is None
    same(stored(spark, folder), expected)


def test_each_tick_sees_what_lies_before_it(spark, folder):
    """The job that prices every tick, against a replay of the ordered log, event by event."""
    trades, ticks = event_log(63, trades=80, ticks=40, days=3, two_foreign=0.4)
    rows = as_records(trades, ticks)
    rank = {(r[1], r[2], r[3]): k for k, r in enumerate(in_order(rows))}
    keyed = sorted([((t["seq"], 1), "trade", t) for t in trades] + [((t[0], 0), "tick", t) for t in ticks], key=lambda e: e[0])
    numbered = [(kind, event, rank[r[1:4]]) for (_, kind, event), r in zip(keyed, rows)]
    moved = [{**e, "seq": k} for kind, e, k in numbered if kind == "trade"]
    moves = [(k, *e[1:]) for kind, e, k in numbered if kind == "tick"]
    curve = data.curve_rates()
    ordered = in_order(rows)
    time = lambda k: int((ordered[k][4] - EPOCH).total_seconds()) * 1_000_000
    found = lambda v: None if v is None else round(v, 2)
    expected = collections.Counter(
        (time(tick), name, time(seq), found(value), status) for (tick, name), (seq, value, status) in replay.valuations(moved, moves, curve).items()
    )
    typed = messages.accepted(messages.events(messages.decode(kafka.message_values(spark.createDataFrame(rows, SCHEMA)))))
    typed.coalesce(1).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(typed.schema).parquet(f"{folder}/in")
    priced = jobs.revaluations_of_events(stream, data.curve_frame(spark, curve), buckets=3)
    query = jobs.writer(priced, sinks.append_sink(f"{folder}/out"), f"{folder}/state", "each", available_now=True).start()
    query.awaitTermination(300)
    rows = spark.read.parquet(f"{folder}/out").collect()
    assert collections.Counter((r.tick_seq, r.id, r.trade_seq, found(r.swapvalue), r.price_status) for r in rows) == expected
    assert sum(expected.values()) > 50


def test_state_from_before_messages_had_a_place():
    old = pa.schema([field for field in RATE if field.name != "place"])
    rates = pd.DataFrame({"seq": [4], "tick_date": [dt.date(2024, 1, 2)], "price": ["EUR"], "rate": [0.7]})
    found = unpacked(packed(rates, old), RATE)
    assert list(found.columns) == RATE.names and found["place"].tolist() == [""] and found["seq"].tolist() == [4]
    assert unpacked(packed(found, RATE), RATE).equals(found)
