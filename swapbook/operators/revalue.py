"""Re-pricing the book on FX ticks, as a batch replay.

A tick of a currency re-prices every trade that was in that currency's book when it arrived.
``revalue_on_each_tick`` does that for every single tick. ``revalue_on_tick`` is the conflated replay behind the stored
history, per window of ``seq``: the last tick of a (currency, window), called its close, re-prices the book as of that moment.

Plan of the conflated replay, with T trade messages and K closes per currency:

1. each message finds the first close that sees it, by one broadcast lookup on (currency, window);
2. messages seen first by the same close are reduced to the last one with a partial aggregate,
   so a trade that is amended without end still sends at most K rows per map task;
3. each remaining version holds until the close that sees the next one: it is exploded to
   exactly those closes and meets them in a second broadcast lookup.

No row is built that is not part of the result, and nothing is grouped by currency alone.

The result at every tick has a row per tick and trade in its book, so it grows with ticks times trades; only what leads to
it is kept small. Ticks are numbered in order of arrival and cut into blocks of one currency and date. A message version
meets the blocks of its life, not their ticks, its legs are valued once per block, and the ticks are unfolded within
the task that writes the rows. What is moved is versions times blocks; what is held is one block.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from swapbook.functions.keys import window_of
from swapbook.operators.curve import WHOLE_YEARS
from swapbook.operators.fx import BROADCAST_ROWS
from swapbook.operators.pricing import leg_values, price_with_rates, value_from_legs
from swapbook.schemas import CURRENCIES
from swapbook.session import checkpointed
from swapbook.sources import arrival

DAY_US = 86_400_000_000  # a day, where seq counts microseconds
#: Ticks of a block at most.
BLOCK = 1024


def closes(ticks: DataFrame, width: int = DAY_US) -> DataFrame:
    """Last tick per (currency, window), numbered from 1 within its currency.

    Columns: price, close_no, win, prev_win, close_seq, date, rate.
    """
    last = (
        ticks.filter(F.col("price").isin(*CURRENCIES))
        .withColumn("win", window_of("seq", width))
        .groupBy("price", "win")
        .agg(F.max(F.struct("seq", "date", "rate")).alias("t"))
        .select("price", "win", F.col("t.seq").alias("close_seq"), "t.date", "t.rate")
    )
    in_order = W.partitionBy("price").orderBy("win")
    return last.withColumn("close_no", F.row_number().over(in_order)).withColumn(
        "prev_win", F.lag("win").over(in_order)
    )


def windows_covered(closing: DataFrame) -> int:
    """Windows up to the last close, over all currencies: the rows of the lookup table below."""
    covered = F.col("win") - F.coalesce(F.col("prev_win"), F.col("win") - 1)
    return closing.agg(F.coalesce(F.sum(covered), F.lit(0)).alias("n")).first()["n"]


def seen_by_close(
    messages: DataFrame,
    closing: DataFrame,
    keys: tuple[str, ...],
    width: int,
    small: bool,
    tasks: int | None = None,
    order: tuple[str, ...] = (),
) -> DataFrame:
    """The messages in force at each close of their currency.

    ``messages`` needs price (the currency of the closes that look at it), seq and ``keys``
    (which include price). The result has one row per (key, close) from the first close after
    the key's first message on; it carries close_no. ``small`` says that the lookup table was
    found small enough to broadcast. ``tasks`` is the number of tasks that hold the result, else Spark chooses it.
    ``order`` names columns by which a task gives out its rows, those of a key and close after each other: few versions are
    sorted, before they become many rows.
    """
    # Every window up to the last close, with the first close at or after it.
    lookup = closing.select(
        "price",
        "close_no",
        "close_seq",
        F.explode(
            F.sequence(F.coalesce(F.col("prev_win") + 1, F.col("win")), F.col("win"))
        ).alias("win"),
    )
    if small:
        lookup = F.broadcast(lookup)
    # One row per currency of the fixed list.
    ends = F.broadcast(
        closing.groupBy("price").agg(F.min("win").alias("first_win"), F.max("close_no").alias("last_no"))
    )
    placed = (
        messages.join(ends, "price")
        # whatever came before the first window waits for the first close
        .withColumn("win", F.greatest(window_of("seq", width), F.col("first_win")))
        .join(lookup, ["price", "win"])
        .withColumn(
            "close_no",
            F.when(F.col("seq") < F.col("close_seq"), F.col("close_no")).otherwise(F.col("close_no") + 1),
        )
        .filter(F.col("close_no") <= F.col("last_no"))
        .drop("win", "first_win", "close_seq")
    )
    rest = [c for c in placed.columns if c not in keys and c not in ("seq", "close_no")]
    versions = placed.groupBy(*keys, "close_no").agg(F.max(F.struct("seq", *rest)).alias("_row"))
    if tasks is not None:
        versions = versions.repartition(tasks, *keys)
    later = W.partitionBy(*keys).orderBy("close_no")
    until = F.coalesce(F.lead("close_no").over(later) - 1, F.col("_row.last_no"))
    fields = [c for c in ("seq", *rest) if c != "last_no"]
    held = versions.withColumn("_until", until).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in fields], "close_no", "_until")
    if order:
        held = held.sortWithinPartitions(*order, "close_no")
    return held.select(*keys, *fields, F.explode(F.sequence("close_no", "_until")).alias("close_no"))


def close_rates(ticks: DataFrame, closing: DataFrame, width: int, small: bool) -> DataFrame:
    """Per close, the map currency -> rate a pricing job reads at that moment.

    That is the last rate stored for the date of the closing tick, of every currency: its own
    from the tick itself, another one from the ticks before it. At most one entry per currency
    of the fixed list.
    """
    # The closes of a window (one per currency) cut it into segments. Ticks of one segment look
    # the same to every close, so only the last one of a segment is kept before going on.
    cuts = closing.groupBy("win").agg(F.collect_list("close_seq").alias("cuts"))
    if small:
        cuts = F.broadcast(cuts)
    segment = F.size(F.filter("cuts", lambda c: c <= F.col("seq")))
    last_of_segment = (
        ticks.filter(F.col("price").isin(*CURRENCIES))
        .select(F.col("price").alias("ccy"), "date", "seq", "rate", window_of("seq", width).alias("win"))
        .join(cuts, "win", "left")
        .groupBy("ccy", "date", "win", segment.alias("segment"))
        .agg(F.max("seq").alias("seq"), F.max_by("rate", "seq").alias("rate"))
    )
    others = last_of_segment.select(
        F.explode(F.array(*[F.lit(c) for c in CURRENCIES])).alias("price"), "ccy", "date", "seq", "rate"
    ).filter(F.col("price") != F.col("ccy"))
    seen = seen_by_close(others, closing, ("price", "ccy", "date"), width, small).select(
        "price", "close_no", "date", "ccy", "rate"
    )
    own = closing.select("price", "close_no", "date", F.col("price").alias("ccy"), "rate")
    maps = (
        closing.select("price", "close_no", "date")
        .join(seen.unionByName(own), ["price", "close_no", "date"])
        .groupBy("price", "close_no")
        .agg(F.map_from_entries(F.collect_list(F.struct("ccy", "rate"))).alias("rates_by_ccy"))
    )
    return closing.select("price", "close_no", "close_seq", F.col("date").alias("tick_date")).join(
        maps, ["price", "close_no"]
    )


class Replay(NamedTuple):
    """The closes of a tick history, whether they are few enough to broadcast, and the rates known to each."""

    closing: DataFrame
    small: bool
    rates: DataFrame


def replay_of(ticks: DataFrame, width: int = DAY_US) -> Replay:
    """What ``revalue_on_tick`` needs of the ticks. A load in several parts computes it once."""
    # A few rows per currency and window, read several times below.
    closing = checkpointed(closes(ticks, width))
    small = windows_covered(closing) <= BROADCAST_ROWS
    rates = close_rates(ticks, closing, width, small)
    return Replay(closing, small, rates)


def revaluation_pairs(
    messages: DataFrame, replay: Replay, width: int = DAY_US, tasks: int | None = None, order: tuple[str, ...] = ()
) -> DataFrame:
    """(close, trade version in force) with both leg rates, ready to be priced.

    ``messages`` are trade messages with xccy and seq.
    """
    closing, small, rates = replay
    if small:  # one row per close, so never more than the windows counted
        rates = F.broadcast(rates)
    seen = seen_by_close(
        messages.withColumnRenamed("xccy", "price"), closing, ("price", "id"), width, small, tasks, order
    )
    rate_of = lambda ccy: F.try_element_at("rates_by_ccy", F.col(ccy))
    return (
        seen.join(rates, ["price", "close_no"])
        .withColumn("pay_rate", rate_of("payccy"))
        .withColumn("receive_rate", rate_of("receiveccy"))
        .withColumnRenamed("price", "xccy")
        .drop("rates_by_ccy")
    )


def revalue_on_tick(
    messages: DataFrame,
    ticks: DataFrame | Replay,
    curve: DataFrame,
    day_count: str = WHOLE_YEARS,
    width: int = DAY_US,
    tasks: int | None = None,
    order: tuple[str, ...] = (),
) -> DataFrame:
    """Valuations the closes produce: as of the tick's date, stamped with the tick's arrival.

    ``ticks`` have seq, date, price and rate, or are the ``replay_of`` such ticks in windows of the same width.
    """
    replay = ticks if isinstance(ticks, Replay) else replay_of(ticks, width)
    priced = price_with_rates(
        revaluation_pairs(messages, replay, width, tasks, order), curve, F.col("tick_date"), day_count
    )
    return priced.drop("valuationdate").withColumn("valuationdate", F.timestamp_micros("close_seq"))


def revalue_in_order(
    messages: DataFrame,
    ticks: DataFrame,
    curve: DataFrame,
    day_count: str = WHOLE_YEARS,
    width: int = DAY_US,
) -> DataFrame:
    """``revalue_on_tick`` over several topics: ``seq`` is a number of ``arrival.numbered``, ``width`` in microseconds.

    A trade of the same millisecond as a tick is priced by it if it lies before it in topic, partition and offset.
    """
    priced = revalue_on_tick(messages, ticks, curve, day_count, arrival.width(width))
    return priced.withColumn("valuationdate", F.timestamp_micros(arrival.micros(F.col("close_seq"))))


def every_tick(ticks: DataFrame, width: int = DAY_US) -> DataFrame:
    """All ticks as closes, numbered from 1 in order of arrival within their currency, with the rates known to each.

    Columns: price, close_no, win, block, close_seq, date, rates. ``rates`` lie in the order of the currency list. Ticks of equal seq
    are closes of their own. A block is a run of ticks of one date, at most ``BLOCK`` of them. Ticks without time or date re-price nothing.
    """
    known = ticks.filter(F.col("price").isin(*CURRENCIES) & F.col("seq").isNotNull() & F.col("date").isNotNull())
    told = known.withColumns(
        {"win": window_of("seq", width), "_told": F.max("rate").over(W.partitionBy("price", "date", "seq"))}
    )
    # the last rate of each currency for the date, from the ticks before; of a tick's own currency, the tick itself
    earlier = W.partitionBy("date").orderBy("seq").rangeBetween(W.unboundedPreceding, -1)
    stored = lambda c: F.last(F.when(F.col("price") == c, F.struct("_told")), ignorenulls=True).over(earlier)
    rates = F.array(*[F.when(F.col("price") == c, F.col("rate")).otherwise(stored(c)["_told"]) for c in CURRENCIES])
    in_order = W.partitionBy("price").orderBy("seq", "date", "rate")
    turn = F.when(F.col("date") == F.lag("date").over(in_order), 0).otherwise(1)
    numbered = told.withColumn("rates", rates).withColumns({"close_no": F.row_number().over(in_order), "_turn": turn})
    runs = numbered.withColumn("_run", F.sum("_turn").over(W.partitionBy("price").orderBy("close_no")))
    place = F.row_number().over(W.partitionBy("price", "_run").orderBy("close_no")) - 1
    cut = runs.withColumn("_cut", (place % BLOCK == 0).cast("int"))
    block = F.sum("_cut").over(W.partitionBy("price").orderBy("close_no"))
    return cut.withColumn("block", block).select("price", "close_no", "win", "block", F.col("seq").alias("close_seq"), "date", "rates")


def first_tick_after(messages: DataFrame, closing: DataFrame, width: int, small: bool) -> DataFrame:
    """Messages (price, seq, ...) that a tick of ``every_tick`` sees, with the first one: ``_first``, ``_block``.

    They also carry last_no and last_block, the ends of their currency. ``small`` says that the windows are few enough to broadcast.
    """
    wins = closing.groupBy("price", "win").agg(F.max("close_no").alias("_end"), F.max("block").alias("_end_block"))
    start = F.coalesce(F.lag("win").over(W.partitionBy("price").orderBy("win")) + 1, F.col("win"))
    lookup = wins.withColumn("_start", start).select(
        "price", "_end", "_end_block", F.col("win").alias("_at"), F.explode(F.sequence("_start", "win")).alias("win")
    )
    # One row per currency of the fixed list.
    ends = closing.groupBy("price").agg(
        F.min("win").alias("first_win"), F.max("close_no").alias("last_no"), F.max("block").alias("last_block")
    )
    sent = (
        messages.join(F.broadcast(ends), "price")
        # whatever came before the first window waits for the first tick
        .withColumn("win", F.greatest(window_of("seq", width), F.col("first_win")))
        .join(F.broadcast(lookup) if small else lookup, ["price", "win"])
        .drop("win", "first_win")
        .withColumns({"_no": F.lit(None).cast("int"), "_tick_block": F.lit(None).cast("long")})
    )
    marks = closing.select(
        "price", F.col("win").alias("_at"), F.col("close_seq").alias("seq"), F.col("close_no").alias("_no"),
        F.col("block").alias("_tick_block"),
    )
    # from the end of a window to its start: the tick met last is the first one after a message
    back = W.partitionBy("price", "_at").orderBy(F.desc("seq"), F.col("_no").desc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)
    return (
        sent.unionByName(marks, allowMissingColumns=True)
        .withColumns(
            {
                "_first": F.coalesce(F.last("_no", ignorenulls=True).over(back), F.col("_end") + 1),
                # of the tick, or where that is of a later window, the block before
                "_block": F.coalesce(F.last("_tick_block", ignorenulls=True).over(back), F.col("_end_block")),
            }
        )
        .filter(F.col("_no").isNull() & (F.col("_first") <= F.col("last_no")))
        .drop("_at", "_no", "_tick_block", "_end", "_end_block")
    )


def versions_by_block(messages: DataFrame, closing: DataFrame, width: int, small: bool) -> DataFrame:
    """The message versions of (price, id), once per block of ticks that may see them, the ticks from ``_first`` to ``_last``."""
    keys = ("price", "id")
    placed = first_tick_after(messages, closing, width, small)
    rest = [c for c in placed.columns if c not in (*keys, "seq", "_first", "_block")]
    versions = placed.groupBy(*keys, "_first").agg(F.max(F.struct("seq", *rest)).alias("_row"), F.min("_block").alias("_block"))
    spark = messages.sparkSession
    # few rows become many: no fewer tasks than Spark was told to use
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    later = W.partitionBy(*keys).orderBy("_first")
    held = versions.repartition(tasks, *keys).withColumns(
        {
            "_last": F.coalesce(F.lead("_first").over(later) - 1, F.col("_row.last_no")),
            "_until": F.coalesce(F.lead("_block").over(later), F.col("_row.last_block")),
        }
    )
    return held.select(
        *keys,
        *[F.col(f"_row.{c}").alias(c) for c in ("seq", *rest) if c not in ("last_no", "last_block")],
        "_first",
        "_last",
        F.explode(F.sequence("_block", "_until")).alias("block"),
    )


def revalue_on_each_tick(
    messages: DataFrame, ticks: DataFrame, curve: DataFrame, day_count: str = WHOLE_YEARS, width: int = DAY_US
) -> DataFrame:
    """A valuation per tick and trade in its currency's book: as of the tick's date, stamped with the tick's arrival.

    ``width`` only sets the windows of ``seq`` in which messages and ticks are sorted together; the result does not depend on it.
    """
    closing = checkpointed(every_tick(ticks, width))
    before = F.lag("win").over(W.partitionBy("price").orderBy("win"))
    windows = closing.select("price", "win").distinct().withColumn("prev_win", before)
    small = windows_covered(windows) <= BROADCAST_ROWS
    blocks = closing.groupBy("price", "block").agg(
        F.min("close_no").alias("_from"),
        F.max("close_no").alias("_to"),
        F.first("date").alias("tick_date"),
        F.sort_array(F.collect_list(F.struct("close_no", "close_seq", "rates"))).alias("_ticks"),
    )
    if closing.count() <= BROADCAST_ROWS:
        blocks = F.broadcast(blocks)
    number_of = lambda ccy: F.array_position(F.array(*[F.lit(c) for c in CURRENCIES]), F.col(ccy)).cast("int") - 1
    lo, hi = F.greatest("_first", "_from"), F.least("_last", "_to")
    met = (
        versions_by_block(messages.withColumnRenamed("xccy", "price"), closing, width, small)
        .join(blocks, ["price", "block"])
        .withColumns({"_lo": lo, "_hi": hi, "_pay_no": number_of("payccy"), "_receive_no": number_of("receiveccy")})
        .filter(F.col("_lo") <= F.col("_hi"))
    )
    legs = leg_values(met, curve, F.col("tick_date"), day_count)
    seen = F.slice("_ticks", F.col("_lo") - F.col("_from") + 1, F.col("_hi") - F.col("_lo") + 1)
    rate_of = lambda number: F.get("rates", F.col(number))
    at_tick = (
        legs.select(*[c for c in legs.columns if c != "_ticks"], F.inline(seen))
        .withColumns({"pay_rate": rate_of("_pay_no"), "receive_rate": rate_of("_receive_no")})
        .withColumnRenamed("price", "xccy")
        .drop("block", "rates", "_first", "_last", "_from", "_to", "_lo", "_hi", "_pay_no", "_receive_no")
    )
    return value_from_legs(at_tick).withColumn("valuationdate", F.timestamp_micros("close_seq"))
