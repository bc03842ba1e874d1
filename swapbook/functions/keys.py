"""Routing and key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from swapbook.schemas import BASE_CCY


def non_usd_currency(pay: Column, receive: Column) -> Column:
    """Currency whose book holds a trade: the pay currency unless that is USD."""
    return F.when(pay != BASE_CCY, pay).otherwise(receive)


def topic_for(prefix: str, ccy: Column) -> Column:
    """Topic of a message: one topic per currency."""
    return F.concat_ws("_", F.lit(prefix), ccy)


def rate_key(days: Column, term: Column) -> Column:
    """Exported text key of a curve point, ``<days>-LIBOR-<term>``."""
    return F.concat_ws("-", days.cast("string"), F.lit("LIBOR"), term)


def fx_key(day: Column, ccy: Column) -> Column:
    """Exported text key of an FX rate, ``<M/d/yyyy>-USD-<ccy>``."""
    return F.concat_ws("-", F.date_format(day, "M/d/yyyy"), F.lit(BASE_CCY), ccy)


def strip_non_ascii(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")


def window_of(seq: str, width: int) -> Column:
    """Number of the window that holds ``seq``, in whole-number arithmetic."""
    step = F.lit(width).cast("bigint")
    return F.call_function("div", F.col(seq) - F.pmod(F.col(seq), step), step)
