"""Re-pricing of a small event log, one event after the other, in plain Python."""

from __future__ import annotations

import naive


def pairs(trades, ticks):
    """Every (tick, trade in its book when it arrived, rates known then).

    ``ticks`` are (seq, date, base, price, rate). A tick comes before a trade of equal seq.
    """
    events = [((t[0], 0), "tick", t) for t in ticks] + [((t["seq"], 1), "trade", t) for t in trades]
    books: dict[str, dict[str, dict]] = {}
    rates: dict[tuple, float] = {}
    for _, kind, event in sorted(events, key=lambda e: e[0]):
        if kind == "trade":
            books.setdefault(event["xccy"], {})[event["id"]] = event
            continue
        seq, day, _, ccy, rate = event
        rates[(day, ccy)] = rate
        known = {c: r for (d, c), r in rates.items() if d == day}
        for trade in books.get(ccy, {}).values():
            yield event, trade, known


def valuations(trades, ticks, curve, keep=lambda tick: True):
    """{(tick seq, trade id): (trade seq, value, status)} for the ticks to keep."""
    result = {}
    for tick, trade, rates in pairs(trades, ticks):
        if keep(tick):
            priced = naive.value(trade, curve, rates, tick[1])
            if priced is not None:
                result[(tick[0], trade["id"])] = (trade["seq"], *priced)
    return result
