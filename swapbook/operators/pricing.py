"""Valuation of swaps as column expressions over one broadcast curve join.

The trades are never shuffled: each row meets a three-row curve table and at most a few FX
rates, both broadcast, and everything after that is arithmetic on the row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swapbook.functions.dates import as_date_column
from swapbook.operators.curve import WHOLE_YEARS, curve_arrays
from swapbook.operators.fx import attach_rates, convert, rates_on, small_side
from swapbook.operators.schedule import periods, reset_offset, whole
from swapbook.schemas import (
    BASE_CCY,
    INDEX_FIXED,
    INDEX_FLOAT,
    SIDE_LONG,
    SIDE_SHORT,
)

OK = "ok"
MISSING_IR = "missing_ir"
MISSING_FX = "missing_fx"

_WORKING = ("rates", "dfs", "sums", "gaps", "pars", "months", "_last", "_ahead", "_par", "_start")


def _at(array: str, day: Column) -> Column:
    return F.get(F.col(array), day)


def _fixed_leg() -> Column:
    """Par rate times the sum of the remaining discount factors, plus one plus the last of them.

    Remaining means not before the as-of date; the leg is 1 when none remains. NULL when a
    needed curve day is unknown.
    """
    n, elapsed = F.col("n"), F.col("elapsed")
    last, ahead, par = F.col("_last"), F.col("_ahead"), F.col("_par")
    # one offset may fall on the as-of date itself
    today = F.when((elapsed > 0) & (elapsed % n == 0), _at("dfs", F.lit(0))).otherwise(F.lit(0.0))
    # a trade that settles after the as-of date starts further up its stride
    remaining = _at("sums", last) - _at("sums", ahead) + today
    known = _at("gaps", last) == _at("gaps", ahead)
    return F.when(last < 0, par * 0.0 + 1.0).when(
        known, par * remaining + (F.lit(1.0) + _at("dfs", last))
    )


def _float_leg() -> Column:
    """(1 + reset rate) times the rate at the next forward day, NULL when either is unknown."""
    n, np, start = F.col("n"), F.col("np"), F.col("_start")
    forward = F.when(start < 0, start + F.least(np, whole(n - 1 - start, n)) * n).otherwise(start)
    return (F.lit(1.0) + _at("rates", n)) * _at("rates", forward)


def _on_curve(trades: DataFrame, curve: DataFrame, as_of: Column, day_count: str) -> DataFrame:
    """Trades with a payment date (or of an unknown frequency), their term's curve and offsets."""
    arrays = F.broadcast(curve_arrays(curve, day_count).withColumnRenamed("term", "frequency"))
    n, np, elapsed = F.col("n"), F.col("np"), F.col("elapsed")
    return (
        trades.join(arrays, "frequency", "left")
        .withColumn("np", periods(F.col("settlementdate"), F.col("maturitydate"), n))
        .filter((np >= 1) | n.isNull())
        .withColumn("elapsed", F.datediff(as_of, F.col("settlementdate")))
        .withColumns(
            {
                "_last": np * n - elapsed,
                "_ahead": F.greatest(-elapsed, F.lit(0)),
                "_par": _at("pars", np * n),
                "_start": n - elapsed + reset_offset(elapsed, n, np),
            }
        )
    )


def leg_values(
    trades: DataFrame,
    curve: DataFrame,
    as_of: Column | dt.date | str,
    day_count: str = WHOLE_YEARS,
) -> DataFrame:
    """Add n, np, elapsed, fixed_leg and float_leg, in leg currency and per unit of notional.

    Trades without a payment date are dropped. Those of a frequency without a curve stay, unvalued.
    """
    return (
        _on_curve(trades, curve, as_date_column(as_of), day_count)
        .withColumns({"fixed_leg": _fixed_leg(), "float_leg": _float_leg()})
        .drop(*_WORKING)
    )


_SIDES = ("_pays_fixed", "_receives_fixed", "_pay", "_receive", "_amount")


def _with_sides(legs: DataFrame) -> DataFrame:
    """Add the value of either side in its currency, and the signed notional.

    The latter is NULL for a contract that is worth nothing: two floating legs, or an unknown
    side or index.
    """
    side = F.col("longshort")
    pays_fixed, receives_fixed = F.col("_pays_fixed"), F.col("_receives_fixed")
    counts = (pays_fixed & (receives_fixed | (F.col("receiveindex") == INDEX_FLOAT))) | (
        receives_fixed & (F.col("payindex") == INDEX_FLOAT)
    )
    position = F.when(side == SIDE_LONG, F.col("notional")).when(side == SIDE_SHORT, -F.col("notional"))
    return legs.withColumns(
        {
            "_pays_fixed": F.col("payindex") == INDEX_FIXED,
            "_receives_fixed": F.col("receiveindex") == INDEX_FIXED,
        }
    ).withColumns(
        {
            "_pay": F.when(pays_fixed, F.col("fixed_leg")).otherwise(F.col("float_leg")),
            "_receive": F.when(receives_fixed, F.col("fixed_leg")).otherwise(F.col("float_leg")),
            "_amount": F.when(counts, position),
        }
    )


def value_from_legs(legs: DataFrame) -> DataFrame:
    """Add swapvalue and price_status from leg values and the rates of both leg currencies.

    LONG earns receive minus pay, SHORT the opposite. A needed number that is missing leaves
    swapvalue NULL and says which in price_status.
    """
    pay, receive, amount, value = F.col("_pay"), F.col("_receive"), F.col("_amount"), F.col("_value")
    net = convert(receive, F.col("receiveccy"), F.col("receive_rate")) - convert(
        pay, F.col("payccy"), F.col("pay_rate")
    )
    status = (
        F.when(value.isNotNull(), OK)
        .when(pay.isNull() | receive.isNull(), MISSING_IR)
        .otherwise(MISSING_FX)
    )
    priced = _with_sides(legs).withColumn("_value", F.when(amount.isNull(), F.lit(0.0)).otherwise(amount * net))
    # A filter on a computed column moves below the projection that computes it and evaluates
    # the whole valuation a second time. It cannot move below a generator, so the two results
    # leave through one.
    result = F.inline(F.array(F.struct(value.alias("swapvalue"), status.alias("price_status"))))
    return priced.select(*legs.columns, result)


def with_fx_part(priced: DataFrame) -> DataFrame:
    """Add ``fx_part``, the share of swapvalue that comes from legs outside USD."""
    abroad = lambda value, ccy, rate: F.when(
        F.col(ccy) == BASE_CCY, F.lit(0.0)
    ).otherwise(convert(F.col(value), F.col(ccy), F.col(rate)))
    net = abroad("_receive", "receiveccy", "receive_rate") - abroad("_pay", "payccy", "pay_rate")
    amount = F.col("_amount")
    return (
        _with_sides(priced)
        .withColumn("fx_part", F.when(amount.isNull(), F.lit(0.0)).otherwise(amount * net))
        .drop(*_SIDES)
    )


#: Amounts that are summed up; out of range they are unknown.
PART = "decimal(28,6)"


def value_parts(legs: DataFrame) -> DataFrame:
    """Add the parts that make up a value at any rates: usd_part + own_part / rate(xccy) + other_part / rate(other_ccy).

    ``legs`` are the result of ``leg_values`` and carry xccy. other_ccy is the second currency outside USD, or USD when
    there is none. ``known`` is false, and the parts are zero, where a leg could not be valued.
    """
    pays, receives = F.col("payccy"), F.col("receiveccy")
    amount, counts = F.col("_amount"), F.col("_amount").isNotNull()
    second = F.when(counts & (pays != BASE_CCY) & (receives != BASE_CCY) & (receives != pays), receives).otherwise(BASE_CCY)
    known = ~counts | (F.col("_pay").isNotNull() & F.col("_receive").isNotNull())

    def part(ccy: Column) -> Column:
        received = F.when(receives == ccy, F.col("_receive")).otherwise(F.lit(0.0))
        paid = F.when(pays == ccy, F.col("_pay")).otherwise(F.lit(0.0))
        return F.when(counts, amount * (received - paid)).otherwise(F.lit(0.0)).try_cast(PART)

    sided = _with_sides(legs).withColumns({"_known": known, "_second": second})
    other = F.when(F.col("_second") == BASE_CCY, F.lit(0.0).cast(PART)).otherwise(part(F.col("_second")))
    split = sided.withColumns({"_usd": part(F.lit(BASE_CCY)), "_own": part(F.col("xccy")), "_other": other})
    whole = F.col("_known") & F.col("_usd").isNotNull() & F.col("_own").isNotNull() & F.col("_other").isNotNull()
    zero = F.lit(0).cast(PART)
    parts = F.struct(
        F.when(whole, F.col("_usd")).otherwise(zero).alias("usd_part"),
        F.when(whole, F.col("_own")).otherwise(zero).alias("own_part"),
        F.when(whole, F.col("_other")).otherwise(zero).alias("other_part"),
        F.col("_second").alias("other_ccy"),
        whole.alias("known"),
    )
    return split.select(*legs.columns, F.inline(F.array(parts)))


def price_with_rates(
    trades: DataFrame,
    curve: DataFrame,
    as_of: Column | dt.date | str,
    day_count: str = WHOLE_YEARS,
) -> DataFrame:
    """Price trades that already carry pay_rate and receive_rate."""
    return value_from_legs(leg_values(trades, curve, as_of, day_count))


def price(
    trades: DataFrame,
    curve: DataFrame,
    fx: DataFrame,
    as_of: Column | dt.date | str,
    day_count: str = WHOLE_YEARS,
    valuation_ts: Column | dt.datetime | str | None = None,
) -> DataFrame:
    """Value every trade at ``as_of``; usable with ``trades.transform``.

    ``fx`` holds the current rate per (date, price), see ``latest_fx``. ``as_of`` is one date for
    the whole book, or a date column of the trades. The result keeps the trade columns and adds
    n, np, elapsed, fixed_leg, float_leg, pay_rate, receive_rate, swapvalue, price_status and,
    when given, valuationdate.
    """
    if isinstance(as_of, Column):
        dated = trades.withColumn("_as_of", as_of)
        rates = small_side(fx.select(F.col("date").alias("_as_of"), "price", "rate"))
        priced = price_with_rates(
            attach_rates(dated, rates, keys=("_as_of",)), curve, F.col("_as_of"), day_count
        ).drop("_as_of")
    else:
        rates = rates_on(fx, as_date_column(as_of))
        priced = price_with_rates(attach_rates(trades, rates), curve, as_of, day_count)
    if valuation_ts is not None:
        stamp = valuation_ts if isinstance(valuation_ts, Column) else F.lit(valuation_ts).cast("timestamp")
        priced = priced.withColumn("valuationdate", stamp)
    return priced


def split_priced(priced: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that could be valued, and the quarantined ones that could not."""
    good = F.col("price_status") == OK
    return priced.filter(good), priced.filter(~good)


__all__ = [
    "BASE_CCY",
    "MISSING_FX",
    "MISSING_IR",
    "OK",
    "leg_values",
    "price",
    "price_with_rates",
    "split_priced",
    "value_from_legs",
    "value_parts",
    "with_fx_part",
]
