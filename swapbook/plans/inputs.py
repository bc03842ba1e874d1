"""Trades, trade messages, FX ticks and a curve derived from the star-schema test tables.

Each function reads its whole table. The formulas only spread key values over the domains of
the message fields; they stay integer until the last step so that any engine gets equal numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swapbook.functions.money import money
from swapbook.schemas import BASE_CCY, CURRENCIES, MAX_CURVE_DAYS, TENORS

AS_OF = "2024-01-15"
BASE_DATE = "2022-03-31"
EPOCH_US = 1_704_067_200_000_000  # 2024-01-01, start of the tick history
MONTH_S = 2_592_000
CURVE_DAYS = 1_097
ORGANIZATIONS = 750
COUNTERPARTIES = 10_000


# The columns in use. Stating them spares a look into the files while a query is planned.
LAYOUT = {
    "orders": "o_orderkey BIGINT",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(LAYOUT[name]).parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, splits: int) -> DataFrame:
    """Spread rows that come in fewer splits than there are cores; a no-op for a big table."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if splits < cores else df


def _pick(position: Column, values: tuple[str, ...]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), position.cast("int"))


def _text(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three curves of 1097 days, rates between 0.08 and 0.09."""
    assert CURVE_DAYS <= MAX_CURVE_DAYS
    days = (
        table(spark, sf_dir, "orders")
        .select((F.col("o_orderkey") % CURVE_DAYS + 1).cast("int").alias("days"))
        .distinct()
    )
    terms = F.explode(
        F.array(*[F.struct(F.lit(t[0]).alias("term"), F.lit(i).alias("t")) for i, t in enumerate(TENORS)])
    )
    step = (F.col("days") * 7919 + F.col("x.t") * 104729) % 10007
    return days.select("days", terms.alias("x")).select(
        "days",
        F.lit("LIBOR").alias("index_name"),
        F.col("x.term").alias("term"),
        (F.lit(0.08) + step.cast("double") / F.lit(1000700)).alias("rate"),
    )


def _as_ticks(events: DataFrame) -> DataFrame:
    """One FX tick per event; seq is its arrival in microseconds."""
    return events.select(
        F.unix_micros(F.col("ts").cast("timestamp")).alias("seq"),
        F.col("ts").cast("date").alias("date"),
        F.lit(BASE_CCY).alias("base"),
        _pick(F.col("user_id") % 8, CURRENCIES).alias("price"),
        (F.lit(0.5) + ((F.col("event_id") * 7919) % 10007).cast("double") / F.lit(20014)).alias("rate"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_ticks(table(spark, sf_dir, "events"))


def _as_trades(keyed: DataFrame) -> DataFrame:
    """Trade fields from a key ``k``, a notional in millions and an arrival ``seq``."""
    k = F.col("k")
    opened, maturity = F.col("opened"), F.lit(722) + F.lit(360) * (k * 43 % 53 % 2).cast("int")
    base, xccy, pays_base = F.lit(BASE_DATE).cast("date"), F.col("xccy"), F.col("pays_base")
    legs = ("FIXED", "LIBOR")
    return keyed.withColumns(
        {
            "xccy": _pick(k * 19 % 41 % 8, CURRENCIES),
            "pays_base": k * 17 % 11 % 2 == 0,
            "opened": (k * 37 % 732).cast("int"),
        }
    ).select(
        _text("SWAP", k).alias("id"),
        _text("org", k * 31 % ORGANIZATIONS + 1).alias("organization"),
        F.date_add(base, opened).alias("tradedate"),
        F.date_add(base, opened + 2).alias("settlementdate"),
        F.date_add(base, maturity).alias("maturitydate"),
        (F.col("millions") * 1_000_000).cast("double").alias("notional"),
        _text("org", k * 7919 % COUNTERPARTIES + 1).alias("counterparty"),
        _pick(k * 31 % 7 % 2, ("LONG", "SHORT")).alias("longshort"),
        F.when(pays_base, BASE_CCY).otherwise(xccy).alias("payccy"),
        F.when(pays_base, xccy).otherwise(BASE_CCY).alias("receiveccy"),
        _pick(k * 13 % 19 % 2, legs).alias("payindex"),
        _pick(k * 29 % 23 % 2, legs).alias("receiveindex"),
        _pick(k * 41 % 37 % 3, tuple(t[0] for t in TENORS)).alias("frequency"),
        "xccy",
        "seq",
    )


def order_keys(orders: DataFrame) -> DataFrame:
    """One trade per order; seq is its arrival in microseconds, within the tick history."""
    k = F.col("o_orderkey")
    return orders.select(
        k.alias("k"),
        (k * 131 % 71 + 30).alias("millions"),
        (k * 7919 % MONTH_S * 1_000_000 + EPOCH_US).alias("seq"),
    )


def line_keys(lines: DataFrame) -> DataFrame:
    """One re-sent trade per order line, with another notional and a later or earlier arrival."""
    k, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    arrival = (k * 7919 + line * 86413 + part * 37) % MONTH_S
    tie_break = line * 100_000 + F.col("l_suppkey") % 1000 * 100 + F.col("l_quantity").cast("bigint") % 100
    return lines.select(
        k.alias("k"),
        ((part * 131 + line) % 71 + 30).alias("millions"),
        (arrival * 1_000_000 + tie_break + EPOCH_US).alias("seq"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return _as_trades(spread(order_keys(orders), orders.rdd.getNumPartitions()))


def amendments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return _as_trades(spread(line_keys(lines), lines.rdd.getNumPartitions()))


def trade_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trade topic: first sendings and amendments."""
    return trades(spark, sf_dir).unionByName(amendments(spark, sf_dir))


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # a pattern, since a stream takes a plain path for a folder
    return spark.readStream.schema(LAYOUT[name]).parquet(f"{sf_dir}/{name}.parquet*")


def trade_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trade topic as a stream over the same tables."""
    first = order_keys(stream(spark, sf_dir, "orders"))
    return _as_trades(first.unionByName(line_keys(stream(spark, sf_dir, "lineitem"))))


def tick_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_ticks(stream(spark, sf_dir, "events"))


def cents(name: str) -> Column:
    """A value as whole cents, read back as a double for comparison."""
    return money(F.col(name)).cast("double").alias(name)
