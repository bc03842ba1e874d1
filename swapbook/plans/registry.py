"""Named queries over the test tables: (spark, table folder) -> DataFrame.

Dates leave as ISO text and amounts as whole cents, so that results compare across engines.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swapbook.functions import dates
from swapbook.functions.keys import topic_for, window_of
from swapbook.functions.money import in_chart_units
from swapbook.operators import book, curve, portfolio, risk, schedule
from swapbook.operators.curve import ACT_360, WHOLE_YEARS
from swapbook.operators.fx import latest_fx
from swapbook.operators.pricing import OK, leg_values, price
from swapbook.operators.revalue import DAY_US, replay_of, revalue_on_each_tick, revalue_on_tick
from swapbook.operators.tick_value import tick_book_value
from swapbook.plans import inputs
from swapbook.schemas import CURRENCIES, TENORS, TOPIC_RAW, VALUATION_KEY
from swapbook.session import KEPT_BATCHES, ROCKSDB_BOUNDED, ROCKSDB_PROVIDER, free_shuffles, shared_dir, work_dir
from swapbook.sources import arrival, commits, curves, latest_view, messages, valuation_table
from swapbook.streaming import metrics
from swapbook.streaming.jobs import CLOCK, as_events, conflated_revaluations, writer
from swapbook.streaming.sinks import append_sink, freeing

Query = Callable[[SparkSession, str], DataFrame]

LOOKUP_ORGANIZATION = "org32"
LOOKUP_TRADE = "SWAP1001"
LOOKUP_CURRENCY = "EUR"
#: Trade messages whose valuations a task sorts in memory.
MESSAGES_PER_TASK = 500_000
#: Trade messages that are moved at once for the valuation table, about 100 bytes of each twice.
MESSAGES_PER_PART = 100_000_000
#: Trade messages of a bucket of the stream's state, all of which a task may hold at once.
MESSAGES_PER_BUCKET = 40_000


def iso(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def stamp(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def digits(name: str, places: int = 9) -> Column:
    return F.round(name, places).alias(name)


def number(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


def _priced(spark: SparkSession, sf_dir: str, day_count: str = WHOLE_YEARS) -> DataFrame:
    return price(
        inputs.trades(spark, sf_dir),
        inputs.curve(spark, sf_dir),
        latest_fx(inputs.ticks(spark, sf_dir)),
        inputs.AS_OF,
        day_count,
    )


def _store(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the valuation table that the re-pricing of the whole tick history leaves behind.

    It is written by the first query of an application that needs it, and again when the input tables have changed.
    """
    state = commits.fingerprint(spark, [f"{sf_dir}/{name}.parquet" for name in ("orders", "lineitem", "events")])
    path = os.path.join(shared_dir(spark), f"valuations-{spark.sparkContext.applicationId}-{state}")
    messages_, ticks = inputs.trade_messages(spark, sf_dir), inputs.ticks(spark, sf_dir)
    sent = messages_.count()
    parts = max(1, -(-sent // MESSAGES_PER_PART))
    # a task prices the messages of its trades and writes their valuations, so these are neither moved nor spilled
    tasks = max(spark.sparkContext.defaultParallelism, -(-sent // (parts * MESSAGES_PER_TASK)))
    replay, curve_ = None, inputs.curve(spark, sf_dir)
    for number in range(parts):
        if valuation_table.committed(spark, path, "history", number):
            continue
        replay = replay or replay_of(ticks)
        # trades in parts of the book, so that the moved messages of one part only lie on disk beside the table
        book_part = F.pmod(F.xxhash64("xccy", "id"), F.lit(parts)) == number
        some = messages_.filter(book_part) if parts > 1 else messages_
        priced = revalue_on_tick(some, replay, curve_, tasks=tasks, order=("organization", "id"))
        valuation_table.append(priced.filter(F.col("price_status") == OK), path, "history", number, moved=False)
        del priced
        free_shuffles(spark)
    return path


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valuation_table.read(spark, _store(spark, sf_dir))
    free_shuffles(spark)  # those of the last write stay in use until Spark has run something else
    return rows


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.latest_valuation(_history(spark, sf_dir))


def kept_latest_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest valuations from the kept view, to which the history comes in weekly batches, merged half-way."""
    history, folder = _history(spark, sf_dir), work_dir(spark, "latest")
    week = F.weekofyear("valuation_day")
    for batch, (number,) in enumerate(sorted(history.select(week).distinct().collect())):
        latest_view.add(history.filter(week == number), folder, "history", batch)
        if batch == 2:
            latest_view.compact(spark, folder)
        free_shuffles(spark)  # a week of the history was moved
    return latest_view.read(spark, folder).select(*VALUATION_KEY, inputs.cents("swapvalue"), stamp("valuationdate"))


def compacted_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One organization's valuations from a table of two runs in several batches each, half of its days compacted."""
    history, folder = _history(spark, sf_dir), work_dir(spark, "table")
    day = F.dayofyear("valuation_day")
    for run in (0, 1):
        for batch in (0, 1):
            part = history.filter((day % 2 == run) & (F.pmod(F.xxhash64("id"), F.lit(2)) == batch))
            valuation_table.append(part, folder, f"run{run}", batch)
            free_shuffles(spark)  # a quarter of the history was moved
    for (when,) in sorted(history.select("valuation_day").filter(day % 2 == 0).distinct().collect()):
        valuation_table.compact(spark, folder, str(when))
    valuation_table.vacuum(spark, folder)
    return _served(portfolio.org_valuations(valuation_table.read(spark, folder), LOOKUP_ORGANIZATION))


def curve_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = curve.curve_points(inputs.curve(spark, sf_dir))
    return points.select("term", "days", "rate", "year_fraction", digits("discount_factor"))


def par_rate_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = curve.par_rate_grid(inputs.curve(spark, sf_dir))
    return grid.select("term", "n", "periods", digits("df_sum"), digits("par_rate"))


def fx_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks encoded as messages, decoded again."""
    raw = inputs.ticks(spark, sf_dir).select("seq", messages.tick_json().alias("value"))
    good = messages.accepted(messages.ticks(messages.decode(raw)))
    return good.select(
        "seq", iso("date"), dates.format_unpadded_date(F.col("date")).alias("fx_date"), "base", "price", "rate"
    )


def fx_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_fx(inputs.ticks(spark, sf_dir)).select(iso("date"), "base", "price", "rate")


def trades_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades encoded as messages, decoded again, with both date spellings."""
    trades = inputs.trades(spark, sf_dir)
    raw = trades.select("seq", messages.trade_json(trades).alias("value"))
    good = messages.accepted(messages.trades(messages.decode(raw)))
    slash = dates.format_slash_date(dates_text("settlementdate"))
    return good.select(
        "seq",
        "id",
        "organization",
        iso("tradedate"),
        slash.alias("settlement_slash"),
        dates.format_dash_date(slash).alias("settlementdate"),
        iso("maturitydate"),
        "notional",
        "counterparty",
        "longshort",
        "payccy",
        "receiveccy",
        "payindex",
        "receiveindex",
        "frequency",
        "xccy",
    )


def dates_text(name: str) -> Column:
    return F.col(name).cast("string")


def spoiled_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades and ticks as messages, about one in four of them made unusable in one of ten ways."""
    trades, ticks = inputs.trades(spark, sf_dir), inputs.ticks(spark, sf_dir)
    raw = trades.select("seq", messages.trade_json(trades).alias("value")).unionByName(
        ticks.select("seq", messages.tick_json().alias("value"))
    )
    harm = F.floor(F.col("seq") / 1_000_000) % 41
    swap = lambda field, other: F.regexp_replace("value", f'"{field}":"[^"]*"', f'"{field}":"{other}"')
    value = (
        F.when(harm == 0, F.lit("no payment dates"))
        .when(harm == 1, F.lit("{}"))
        .when(harm == 2, swap("notional", "1e30"))
        .when(harm == 3, swap("settlementdate", "2024-13-01"))
        .when(harm == 4, swap("frequency", "2W"))
        .when(harm == 5, swap("payccy", "XXX"))
        .when(harm == 6, swap("rate", "NaN"))
        .when(harm == 7, swap("price", "USD"))
        .when(harm == 8, swap("date", "31/31/2024"))
        .when(harm == 9, swap("swapvalue", "many"))
        .otherwise(F.col("value"))
    )
    return raw.select("seq", value.alias("value"))


def rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of each message of a spoiled topic: its route, and why it is set aside."""
    routed = messages.routed(messages.decode(spoiled_messages(spark, sf_dir)))
    return routed.select("seq", "route", F.coalesce("reject_reason", F.lit("")).alias("reject_reason"))


def curve_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curve written as its three files, about one line in three unusual in one of seven ways, and read back with a verdict."""
    folder = work_dir(spark, "curve")
    harm = F.col("days") % 23
    fields = [
        F.when(harm == 0, F.lit("soon")).when(harm == 1, F.lit("99999")).otherwise(F.col("days").cast("string")),
        F.when(harm == 2, F.lit("")).when(harm == 3, F.lit("\u00a0LIBOR\u200b")).otherwise(F.col("index_name")),
        F.when(harm == 4, F.lit("2W")).otherwise(F.col("term")),
        F.when(harm == 5, F.lit("NaN")).otherwise(F.col("rate").cast("string")),
    ]
    line = F.when(harm == 6, F.concat_ws("\t", *fields[:3])).otherwise(F.concat_ws("\t", *fields))
    lines = inputs.curve(spark, sf_dir).select("term", line.alias("days\tindex\tterm\trate"))
    for path, (term, _, _) in zip(curves.curve_paths(folder), TENORS):
        # a separator that no line holds, so that a line leaves as it is, below the header
        lines.filter(F.col("term") == term).drop("term").write.csv(path, sep="\u0001", quote="", header=True)
    judged = curves.judged_curve(spark, curves.curve_paths(folder))
    nothing = F.coalesce("reject_reason", F.lit("")).alias("reject_reason")
    return judged.select(
        F.coalesce("days", F.lit(-1)).alias("days"), F.coalesce("index_name", F.lit("")).alias("index_name"), "term",
        F.coalesce("rate", F.lit(0.0)).alias("rate"), nothing,
    )


def trade_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.trade_terms(inputs.trades(spark, sf_dir)).select("id", "months", "n", "np")


def payment_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = schedule.payment_schedule(inputs.trades(spark, sf_dir))
    return rows.select("id", "payment_no", iso("paymentdate"))


def reset_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.reset_dates(inputs.trades(spark, sf_dir), inputs.AS_OF).select("id", "np", iso("resetdate"))


def _leg_values(day_count: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        legs = leg_values(inputs.trades(spark, sf_dir), inputs.curve(spark, sf_dir), inputs.AS_OF, day_count)
        return legs.select("id", "np", "elapsed", digits("fixed_leg"), digits("float_leg"))

    return query


def _swap_valuation(day_count: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _priced(spark, sf_dir, day_count).select(
            "id",
            "organization",
            "counterparty",
            "xccy",
            "longshort",
            "payccy",
            "receiveccy",
            "payindex",
            "receiveindex",
            "frequency",
            "notional",
            "np",
            inputs.cents("swapvalue"),
            "price_status",
        )

    return query


def trade_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = book.trade_book(inputs.trade_messages(spark, sf_dir))
    return current.select("xccy", "id", "organization", "notional", "seq", iso("settlementdate"), "frequency")


def book_by_ccy(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = book.book_of_currency(inputs.trade_messages(spark, sf_dir), LOOKUP_CURRENCY)
    return current.select("id", "organization", "notional", "seq")


def tick_revaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The book of its currency at every single tick, trade by trade."""
    rows = revalue_on_each_tick(inputs.trade_messages(spark, sf_dir), inputs.ticks(spark, sf_dir), inputs.curve(spark, sf_dir))
    # to the nearest cent of the product, as in the SQL: of so many values some lie within the last bit of half a cent
    cents = F.round(F.col("swapvalue") * 100) / 100
    return rows.select(
        F.col("close_seq").alias("tick_seq"),
        "xccy",
        "id",
        "organization",
        "notional",
        F.col("seq").alias("trade_seq"),
        cents.alias("swapvalue"),
        "price_status",
    )


def each_tick_book_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The book of its currency at every single tick."""
    rows = tick_book_value(inputs.trade_messages(spark, sf_dir), inputs.ticks(spark, sf_dir), inputs.curve(spark, sf_dir))
    value = F.round(in_chart_units(F.col("book_value")), 6).alias("y")
    return rows.select(F.col("seq").alias("tick_seq"), F.col("price").alias("xccy"), iso("date"), "rate", "trades", "unpriced", value)


def stream_revalue_on_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same re-pricing by the streaming job, from files that come in several micro-batches.

    The topic is written in parts of sixteen days, each in several files without order, which are read one at a time: rows come
    days late, and no micro-batch holds a window as a whole. A clock row at the end lets the last windows close.
    """
    folder = work_dir(spark, "stream")
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set(ROCKSDB_BOUNDED, "true")
    spark.conf.set(KEPT_BATCHES, "2")
    events = as_events(inputs.trade_messages(spark, sf_dir), inputs.ticks(spark, sf_dir))
    part = window_of("seq", 16 * DAY_US)
    is_trade = F.col("kind") == messages.TRADE
    low, high, sent = events.agg(F.min(part), F.max(part), F.count(F.when(is_trade, 1))).first()
    buckets = max(4, -(-sent // (len(CURRENCIES) * MESSAGES_PER_BUCKET)))
    for number in range(low or 0, (high or 0) + 1) if low is not None else ():
        events.filter(part == number).repartition(2).write.mode("append").option("compression", "zstd").parquet(f"{folder}/in")
        free_shuffles(spark)
    end = F.lit(((high or 0) + 3) * 16 * DAY_US).cast("long")
    clock = spark.range(1).select(F.lit(CLOCK).alias("kind"), F.lit("").alias("xccy"), end.alias("seq"))
    events.limit(0).unionByName(clock, allowMissingColumns=True).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    priced = conflated_revaluations(
        stream, inputs.curve(spark, sf_dir), DAY_US, delay="16 days", buckets=buckets, all_currencies=False
    ).select("tick_seq", "xccy", "id", "organization", "notional", "trade_seq", inputs.cents("swapvalue"), "price_status")
    run = writer(priced, freeing(append_sink(f"{folder}/out")), f"{folder}/state", "revalue_tables", available_now=True).start()
    run.awaitTermination()
    return spark.read.schema(priced.schema).parquet(f"{folder}/out").drop("run_id", "batch_id")


def events_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = inputs.trade_messages(spark, sf_dir).select("seq")
    ticks = inputs.ticks(spark, sf_dir).select("seq")
    return book.messages_per_batch(trades.unionByName(ticks))


def topic_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages in their topics, three partitions each, under a clock that only moves once an hour; in order of arrival."""
    trades, ticks = inputs.trade_messages(spark, sf_dir), inputs.ticks(spark, sf_dir)
    sent = trades.select("xccy", "seq").unionByName(ticks.select(F.col("price").alias("xccy"), "seq"))
    hour = F.lit(3_600_000_000)
    records = sent.select(
        topic_for(TOPIC_RAW, F.col("xccy")).alias("topic"), F.pmod("seq", F.lit(3)).cast("int").alias("partition"),
        F.col("seq").alias("offset"), (F.col("seq") - F.pmod("seq", hour)).alias("arrived"),
    )
    return arrival.numbered(records)


def stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spoiled topic as a stream of several micro-batches: what their observed counts add up to."""
    folder = work_dir(spark, "metrics")
    spoiled_messages(spark, sf_dir).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("seq BIGINT, value STRING").option("maxFilesPerTrigger", 4).parquet(f"{folder}/in")
    typed = metrics.observed(messages.events(messages.decode(stream)))
    listener = metrics.MetricsListener(spark, f"{folder}/counts")
    spark.streams.addListener(listener)
    try:
        rejects = append_sink(f"{folder}/rejected")
        run = writer(messages.rejected(typed), rejects, f"{folder}/state", "batch_counts", available_now=True).start()
        run.awaitTermination()
        if not listener.wait(run):
            raise TimeoutError("the counts of the last micro-batches were not written")
    finally:
        spark.streams.removeListener(listener)
    return metrics.by_route(metrics.read(spark, f"{folder}/counts"))


def latest_valuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(spark, sf_dir).select(*VALUATION_KEY, inputs.cents("swapvalue"), stamp("valuationdate"))


def latest_valuation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = portfolio.latest_valuation_rows(_history(spark, sf_dir))
    return rows.select(
        *VALUATION_KEY, "counterparty", "notional", "frequency", inputs.cents("swapvalue"), stamp("valuationdate")
    )


def latest_for_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = portfolio.latest_for_organization(_history(spark, sf_dir), LOOKUP_ORGANIZATION)
    return rows.select(*VALUATION_KEY, inputs.cents("swapvalue"), stamp("valuationdate"))


def _served(rows: DataFrame) -> DataFrame:
    return rows.select("id", "organization", stamp("valuationdate"), inputs.cents("swapvalue"))


def org_valuations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _served(portfolio.org_valuations(_history(spark, sf_dir), LOOKUP_ORGANIZATION))


def swap_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _served(portfolio.swap_history(_history(spark, sf_dir), LOOKUP_TRADE))


def portfolio_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.portfolio_value(_latest(spark, sf_dir)).select("organization", number("portfoliovalue"))


def portfolio_by_ccy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = portfolio.portfolio_by_currency(_latest(spark, sf_dir))
    return rows.select("organization", "payccy", number("portfoliovalue"))


def portfolio_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = portfolio.portfolio_grouping_sets(_latest(spark, sf_dir))
    return rows.select(
        "organization", F.coalesce("payccy", F.lit("all")).alias("payccy"), number("portfoliovalue")
    )


def portfolio_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.portfolio_ranked(_latest(spark, sf_dir)).select("organization", number("portfoliovalue"))


def _drilldown_text(rows: DataFrame) -> DataFrame:
    parts = F.transform("drilldown", lambda e: F.concat_ws(":", e.payccy, e.amount.cast("string")))
    return rows.select(
        "organization", number("portfoliovalue"), digits("y", 6), F.array_join(parts, ",").alias("drilldown")
    )


def portfolio_drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drilldown_text(portfolio.portfolio_drilldown(_latest(spark, sf_dir)))


def portfolio_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drilldown_text(portfolio.portfolio_report(_history(spark, sf_dir)))


def net_liability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.net_liability(_latest(spark, sf_dir)).select("organization", number("owed"), "trades_owing")


def counterparty_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = portfolio.latest_valuation_rows(_history(spark, sf_dir))
    rows = risk.counterparty_exposure(latest)
    return rows.select("organization", "counterparty", number("exposure"), number("net"), "trades")


def _fx_sensitivity(day_count: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = risk.fx_sensitivity(_priced(spark, sf_dir, day_count))
        return rows.select("organization", "xccy", "shock", "trades", digits("change", 0))

    return query


QUERIES: dict[str, Query] = {
    "curve_points": curve_points,
    "par_rate_grid": par_rate_grid,
    "fx_ticks": fx_ticks,
    "fx_latest": fx_latest,
    "trades_normalized": trades_normalized,
    "rejected_messages": rejected_messages,
    "curve_files": curve_files,
    "trade_terms": trade_terms,
    "payment_schedule": payment_schedule,
    "reset_dates": reset_dates,
    "leg_values": _leg_values(WHOLE_YEARS),
    "leg_values_act360": _leg_values(ACT_360),
    "swap_valuation": _swap_valuation(WHOLE_YEARS),
    "swap_valuation_act360": _swap_valuation(ACT_360),
    "trade_book": trade_book,
    "book_by_ccy": book_by_ccy,
    "revalue_on_tick": tick_revaluation,
    "tick_book_value": each_tick_book_value,
    "stream_revalue_on_tick": stream_revalue_on_tick,
    "events_per_batch": events_per_batch,
    "topic_order": topic_order,
    "stream_batch_counts": stream_batch_counts,
    "latest_valuation": latest_valuation,
    "latest_valuation_rows": latest_valuation_rows,
    "latest_for_org": latest_for_org,
    "latest_view": kept_latest_view,
    "compacted_history": compacted_history,
    "org_valuations": org_valuations,
    "swap_history": swap_history,
    "portfolio_value": portfolio_value,
    "portfolio_by_ccy": portfolio_by_ccy,
    "portfolio_grouping_sets": portfolio_grouping_sets,
    "portfolio_ranked": portfolio_ranked,
    "portfolio_drilldown": portfolio_drilldown,
    "portfolio_report": portfolio_report,
    "net_liability": net_liability,
    "counterparty_exposure": counterparty_exposure,
    "fx_sensitivity": _fx_sensitivity(WHOLE_YEARS),
    "fx_sensitivity_act360": _fx_sensitivity(ACT_360),
}
