"""The value of a book at every single tick.

A tick re-prices all trades of its currency's book as of its date. Their sum is usd + own / rate(tick), plus other / rate
for contracts with a second currency outside USD, where usd, own and other are sums over the book that do not depend on
the tick's rate. Between two ticks of a date these sums change only by the messages that arrive in between. So a tick
costs the lookup of a running sum, not a pass over the book:

1. each message version is valued once for each (currency, date) whose ticks it can be seen by;
2. versions that are in the book before the first tick of a date are summed up by a partial aggregate; each later one
   enters at its arrival and leaves at that of the next version;
3. entries and exits are added up per block of time, block sums are accumulated over the blocks, and within a block
   a running sum over its changes and ticks is formed. Blocks are as short as it takes for none to hold more than
   ``most`` rows, so a burst of messages or ticks is never in one task with the rest of its day.

The rows that are moved are versions x dates once (as when pricing at daily closes), then changes and ticks. Rates of
a second currency are looked up in the same way: the last one of a block, or of the blocks before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from swapbook.functions.keys import window_of
from swapbook.operators.book import with_next
from swapbook.operators.curve import WHOLE_YEARS
from swapbook.operators.fx import small_side
from swapbook.operators.pricing import leg_values, value_parts
from swapbook.schemas import BASE_CCY, CURRENCIES
from swapbook.session import checkpointed

DAY_US = 86_400_000_000
QUARTER_US = 900_000_000
SUMS = ("usd", "own", "other", "trades", "unpriced")
BOOK = ("price", "date", "other_ccy")
TICK, MOVE = 0, 1


def distinct_ticks(ticks: DataFrame) -> DataFrame:
    """(price, seq, date, rate): the ticks of the known currencies, one per place."""
    one = ticks.filter(F.col("price").isin(*CURRENCIES) & F.col("date").isNotNull()).groupBy("price", "seq")
    return one.agg(F.max(F.struct("date", "rate")).alias("t")).select("price", "seq", "t.date", "t.rate")


def tick_spans(ticks: DataFrame) -> DataFrame:
    """First and last tick of each currency and date: (price, date, first_seq, last_seq)."""
    return ticks.groupBy("price", "date").agg(F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


def versions_by_span(versions: DataFrame, spans: DataFrame, width: int = DAY_US) -> DataFrame:
    """The message versions that can be seen within each span, once per span; they carry its date, first and last tick.

    Spans are listed by the windows of ``seq`` they touch, and a version by those of its life, so the two meet by an
    equi-join; the pair counts in the first window that both touch.
    """
    first, last = window_of("first_seq", width), window_of("last_seq", width)
    touched = spans.select("*", first.alias("_from"), F.explode(F.sequence(first, last)).alias("_win"))
    ends = touched.groupBy("price").agg(F.min("_win").alias("_lo"), F.max("_win").alias("_hi"))
    life = (
        versions.join(F.broadcast(ends), "price")  # a row per currency of the fixed list
        .withColumn("_lo", F.greatest(window_of("seq", width), F.col("_lo")))
        .withColumn("_hi", F.least(F.coalesce(window_of("next_seq", width), F.col("_hi")), F.col("_hi")))
        .filter(F.col("_lo") <= F.col("_hi"))
        .withColumn("_win", F.explode(F.sequence("_lo", "_hi")))
    )
    met = life.join(small_side(touched), ["price", "_win"]).filter(
        (F.col("seq") < F.col("last_seq"))
        & (F.col("next_seq").isNull() | (F.col("next_seq") >= F.col("first_seq")))
        & (F.col("_win") == F.greatest("_lo", "_from"))
    )
    return met.drop("_lo", "_hi", "_win", "_from")


def book_moves(versions: DataFrame, spans: DataFrame, curve: DataFrame, day_count: str = WHOLE_YEARS) -> DataFrame:
    """Changes of the sums of each book and date: (price, date, other_ccy, at, usd, own, other, trades, unpriced).

    ``at`` is the arrival from which later ticks see the change, NULL for what was there before the first one.
    """
    pairs = versions_by_span(versions, spans).withColumnRenamed("price", "xccy")
    valued = value_parts(leg_values(pairs, curve, F.col("date"), day_count)).withColumnRenamed("xccy", "price")
    entry = F.struct(F.when(F.col("seq") >= F.col("first_seq"), F.col("seq")).alias("at"), F.lit(1).alias("sign"))
    leaves = F.when(F.col("next_seq") < F.col("last_seq"), F.struct(F.col("next_seq").alias("at"), F.lit(-1).alias("sign")))
    steps = valued.select(
        *BOOK, "usd_part", "own_part", "other_part", "known",
        F.explode(F.filter(F.array(entry, leaves), lambda x: x.isNotNull())).alias("_s"),
    )
    sign = F.col("_s.sign")
    return steps.groupBy(*BOOK, F.col("_s.at").alias("at")).agg(
        *[F.sum(F.col(f"{c}_part") * sign).cast("decimal(38,6)").alias(c) for c in ("usd", "own", "other")],
        F.sum(F.when(F.col("known"), sign).otherwise(0)).alias("trades"),
        F.sum(F.when(F.col("known"), 0).otherwise(sign)).alias("unpriced"),
    )


def block_width(rows: DataFrame, most: int, width: int = QUARTER_US) -> int:
    """A width at which no block of (price, date, at) rows holds more than ``most``, or one of a single instant."""
    while width > 1:
        counts = rows.groupBy("price", "date", window_of("at", width)).count()
        if (counts.agg(F.max("count").alias("n")).first()["n"] or 0) <= most:
            break
        width = max(1, width // 8)
    return width


def rates_at(asked: DataFrame, ticks: DataFrame, width: int) -> DataFrame:
    """``asked`` (price, date, seq, other_ccy) with ``other_rate``: the last rate of other_ccy for the date, as of seq."""
    key = ("other_ccy", "date")
    given = ticks.select(F.col("price").alias("other_ccy"), "date", F.col("seq").alias("at"), F.lit(0).alias("kind"), "rate", F.lit(None).cast("string").alias("price"))
    wanted = asked.select("other_ccy", "date", F.col("seq").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("double").alias("rate"), "price")
    rows = given.join(wanted.select(*key).distinct(), list(key), "left_semi").unionByName(wanted).withColumn("_block", window_of("at", width))
    lasts = rows.groupBy(*key, "_block").agg(F.max(F.when(F.col("kind") == 0, F.struct("at", "rate"))).alias("_last"))
    before = W.partitionBy(*key).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carried = lasts.select(*key, "_block", F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    inside = W.partitionBy(*key, "_block").orderBy("at", "kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    seen = rows.withColumn("_near", F.last(F.when(F.col("kind") == 0, F.struct("rate")), ignorenulls=True).over(inside))
    met = seen.filter("kind = 1").join(carried, [*key, "_block"])
    return met.select("price", "date", F.col("at").alias("seq"), "other_ccy", F.coalesce("_near.rate", "_carry.rate").alias("other_rate"))


def tick_book_value(
    messages: DataFrame,
    ticks: DataFrame,
    curve: DataFrame,
    day_count: str = WHOLE_YEARS,
    width: int = DAY_US,
    most: int = 50_000,
) -> DataFrame:
    """One row per tick: price, seq, date, rate, trades (valued), unpriced and book_value (of those valued).

    ``messages`` are trade messages with xccy, id and seq; a tick sees those that arrived before it. A trade counts as
    unpriced when the curve, or the rate of its second currency, is unknown. Trades without a payment date count nowhere.
    """
    known = checkpointed(distinct_ticks(ticks))
    spans = checkpointed(tick_spans(known))
    needed = ["id", "xccy", "seq", "settlementdate", "maturitydate", "notional", "longshort", "payccy", "receiveccy", "payindex", "receiveindex", "frequency"]
    versions = with_next(messages.select(*needed), ("xccy", "id"), width).withColumnRenamed("xccy", "price")
    moves = checkpointed(book_moves(versions, spans, curve, day_count))

    at = F.col("seq").alias("at")
    step = block_width(moves.select("price", "date", "at").dropna().unionByName(known.select("price", "date", at)), most)
    books = moves.select(*BOOK).distinct()
    asked = known.join(books, ["price", "date"], "left").withColumn("other_ccy", F.coalesce("other_ccy", F.lit(BASE_CCY)))

    zero = [F.lit(0).cast("decimal(38,6)" if c in ("usd", "own", "other") else "long").alias(c) for c in SUMS]
    changes = moves.withColumn("kind", F.lit(MOVE)).withColumn("rate", F.lit(None).cast("double"))
    asking = asked.select(*BOOK, at, *zero, F.lit(TICK).alias("kind"), "rate")
    # the sums before the first tick come ahead of all blocks
    rows = changes.unionByName(asking).withColumn("_block", F.coalesce(window_of("at", step), F.lit(-(1 << 62))))
    per_block = rows.groupBy(*BOOK, "_block").agg(*[F.sum(c).alias(c) for c in SUMS])
    before = W.partitionBy(*BOOK).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carried = per_block.select(*BOOK, "_block", *[F.sum(c).over(before).alias(f"_{c}") for c in SUMS])
    inside = W.partitionBy(*BOOK, "_block").orderBy("at", "kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = rows.filter(F.col("at").isNotNull()).withColumns({c: F.sum(c).over(inside) for c in SUMS}).filter(F.col("kind") == TICK)
    sums = running.join(carried, [*BOOK, "_block"]).select(
        *BOOK, F.col("at").alias("seq"), "rate", *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in SUMS]
    )
    second = asked.filter(F.col("other_ccy") != BASE_CCY).select("price", "date", "seq", "other_ccy")
    sums = sums.join(rates_at(second, known, step), ["price", "date", "seq", "other_ccy"], "left")
    return sums.groupBy("price", "seq", "date", "rate").agg(*_totals())


def _totals() -> list[Column]:
    """Totals of a tick over the contracts of each second currency."""
    number = lambda c: F.col(c).cast("double")
    usable = (F.col("other_ccy") == BASE_CCY) | F.col("other_rate").isNotNull()
    abroad = F.when(F.col("other_ccy") == BASE_CCY, F.lit(0.0)).otherwise(number("other") / F.nullif("other_rate", F.lit(0.0)))
    value = number("usd") + number("own") / F.nullif("rate", F.lit(0.0)) + abroad
    good = usable & value.isNotNull()
    return [
        F.sum(F.when(good, F.col("trades")).otherwise(0)).alias("trades"),
        F.sum(F.col("unpriced") + F.when(good, 0).otherwise(F.col("trades"))).alias("unpriced"),
        # a handful of terms, in a fixed order
        F.aggregate(
            F.array_sort(F.collect_list(F.when(good, F.struct("other_ccy", value.alias("v"))))), F.lit(0.0), lambda total, x: total + x.v
        ).alias("book_value"),
    ]
