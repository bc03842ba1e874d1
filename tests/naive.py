"""The valuation rules written out period by period, for small books in plain Python."""

from __future__ import annotations

import datetime as dt

DAYS = {"3M": 90, "6M": 180, "1Y": 360}


class Missing(Exception):
    pass


def factor(curve, term, day, day_count):
    rate = rate_at(curve, term, day)
    years = day // 360 if day_count == "whole_years" else day / 360
    return 1 / (1 + rate * years)


def rate_at(curve, term, day):
    if (term, day) not in curve:
        raise Missing("missing_ir")
    return curve[(term, day)]


def fixed_leg(curve, term, count, elapsed, day_count):
    n = DAYS[term]
    ends = [factor(curve, term, n * (i + 1), day_count) for i in range(count)]
    par = (1 - ends[-1]) / sum(ends)
    left = [n * (i + 1) - elapsed for i in range(count)]
    left = [factor(curve, term, day, day_count) for day in left if day >= 0]
    return par * sum(left) + 1 + (left[-1] if left else 0)


def float_leg(curve, term, count, settlement, as_of):
    n = DAYS[term]
    payments = [settlement + dt.timedelta((2 * i + 1) * n) for i in range(count)]
    reset = next((p for p in payments if (as_of - p).days < n), payments[-1])
    day = n - (as_of - reset).days
    for _ in range(count):
        if day >= 0:
            break
        day += n
    return (1 + rate_at(curve, term, n)) * rate_at(curve, term, day)


def value(trade, curve, rates, as_of, day_count="whole_years"):
    """(swapvalue, status), or None for a trade without payment date. ``rates``: currency -> rate."""
    span = (trade["maturitydate"] - trade["settlementdate"]).days
    count = span // DAYS[trade["frequency"]]
    if count < 1:
        return None
    if "FIXED" not in (trade["payindex"], trade["receiveindex"]):
        return 0.0, "ok"
    elapsed = (as_of - trade["settlementdate"]).days

    def leg(index):
        if index == "FIXED":
            return fixed_leg(curve, trade["frequency"], count, elapsed, day_count)
        return float_leg(curve, trade["frequency"], count, trade["settlementdate"], as_of)

    def in_usd(amount, ccy):
        if ccy == "USD":
            return amount
        if not rates.get(ccy):
            raise Missing("missing_fx")
        return amount / rates[ccy]

    try:
        pay, receive = leg(trade["payindex"]), leg(trade["receiveindex"])
        net = in_usd(receive, trade["receiveccy"]) - in_usd(pay, trade["payccy"])
    except Missing as reason:
        return None, str(reason)
    return (net if trade["longshort"] == "LONG" else -net) * trade["notional"], "ok"
