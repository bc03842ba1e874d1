"""Periods, payment dates and reset dates of a trade."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swapbook.functions.dates import as_date_column
from swapbook.schemas import tenors


def _i(expression: Column) -> Column:
    return expression.cast("int")


def whole(numerator: Column, denominator: Column) -> Column:
    """Integer quotient, rounded toward zero."""
    return _i(F.call_function("div", numerator, denominator))


def periods(settlement: Column, maturity: Column, n: Column) -> Column:
    """Whole periods of n days between settlement and maturity."""
    return whole(F.datediff(maturity, settlement), n)


def trade_terms(trades: DataFrame) -> DataFrame:
    """Trades with their months, period days ``n`` and number of periods ``np``.

    A frequency outside the tenor dimension leaves all three NULL.
    """
    terms = F.broadcast(tenors(trades.sparkSession)).withColumnRenamed("term", "frequency")
    return trades.join(terms, "frequency", "left").withColumn(
        "np", periods(F.col("settlementdate"), F.col("maturitydate"), F.col("n"))
    )


def with_periods_only(terms: DataFrame) -> DataFrame:
    """Drop trades without a payment date. Must come before any sequence over 1..np."""
    return terms.filter(F.col("np") >= 1)


def payment_schedule(trades: DataFrame) -> DataFrame:
    """One row per payment date: settlement + (2i + 1) n days for i = 0 .. np - 1.

    Successive dates are two periods apart and run past maturity, as the valuation rules ask.
    """
    last = F.greatest(F.col("np") - 1, F.lit(0))
    return (
        with_periods_only(trade_terms(trades))
        .select("*", F.explode(F.sequence(F.lit(0), last)).alias("payment_no"))
        .withColumn(
            "paymentdate",
            F.date_add("settlementdate", (F.lit(2) * F.col("payment_no") + 1) * F.col("n")),
        )
    )


def payment_dates(settlement: Column, n: Column, np: Column) -> Column:
    """The same dates as an array, for a row with np >= 1."""
    return F.transform(
        F.sequence(F.lit(0), F.greatest(np - 1, F.lit(0))),
        lambda i: F.date_add(settlement, _i((F.lit(2) * i + 1) * n)),
    )


def reset_offset(elapsed: Column, n: Column, np: Column) -> Column:
    """Days from settlement to the reset date.

    That is the first payment date less than n days behind the as-of date, else the last one.
    """
    i = F.least(F.greatest(whole(elapsed, n * 2), F.lit(0)), np - 1)
    return (i * 2 + 1) * n


def reset_dates(trades: DataFrame, as_of: Column | dt.date | str) -> DataFrame:
    """Trades with the reset date that governs their floating leg at ``as_of``."""
    elapsed = F.datediff(as_date_column(as_of), F.col("settlementdate"))
    return with_periods_only(trade_terms(trades)).withColumn(
        "resetdate",
        F.date_add("settlementdate", reset_offset(elapsed, F.col("n"), F.col("np"))),
    )
