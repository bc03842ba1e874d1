"""Current FX rates and currency conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swapbook.schemas import BASE_CCY, CURRENCIES

# Rows of a rate table that may be broadcast. (date, currency) rows are some tens of bytes, so
# this stays in the low tens of megabytes. Larger tables take the shuffle join.
BROADCAST_ROWS = 300_000


def latest_fx(ticks: DataFrame) -> DataFrame:
    """Current rate per (date, currency): the last tick wins. Every rate counts as against USD."""
    return (
        ticks.filter(F.col("price").isin(*CURRENCIES))
        .groupBy("date", "price")
        .agg(F.max_by("rate", "seq").alias("rate"))
        .select("date", F.lit(BASE_CCY).alias("base"), "price", "rate")
    )


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast when it has at most ``rows`` rows, else leave the join to Spark.

    The count stops at rows + 1, so checking a big table stays cheap for everything but the
    work below it; hand in tables that are already aggregated or stored.
    """
    if df.limit(rows + 1).count() <= rows:
        return F.broadcast(df)
    return df


def rates_on(fx: DataFrame, as_of: Column) -> DataFrame:
    """The rates of one date. One row per currency of the fixed list, so it may be broadcast."""
    return F.broadcast(
        fx.filter((F.col("date") == as_of) & F.col("price").isin(*CURRENCIES))
        .groupBy("price")
        .agg(F.max("rate").alias("rate"))
    )


def attach_rates(trades: DataFrame, rates: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Add ``pay_rate`` and ``receive_rate``, one lookup per leg currency.

    ``rates`` has (price, rate) and, when the rate also depends on them, the columns ``keys``
    that the trades share.
    """
    for ccy, rate in (("payccy", "pay_rate"), ("receiveccy", "receive_rate")):
        side = rates.select(*keys, F.col("price").alias(ccy), F.col("rate").alias(rate))
        trades = trades.join(side, [*keys, ccy], "left")
    return trades


def convert(value: Column, ccy: Column, rate: Column) -> Column:
    """A leg value in USD: divided by the rate unless it is in USD already."""
    return F.when(ccy == BASE_CCY, value).otherwise(value / F.nullif(rate, F.lit(0.0)))
