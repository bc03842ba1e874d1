import datetime as dt
import random

import data
import naive
import pytest
from pyspark.sql import functions as F

from swapbook.operators import pricing
from swapbook.operators.curve import curve_points, par_rate_grid
from swapbook.operators.pricing import leg_values, price, split_priced

AS_OF = data.AS_OF


def fx_frame(spark, rates, day=AS_OF):
    return spark.createDataFrame(
        [(day, "USD", ccy, rate) for ccy, rate in rates.items()], "date DATE, base STRING, price STRING, rate DOUBLE"
    )


def check(spark, trades, curve, rates, day_count="whole_years"):
    rows = price(
        data.trade_frame(spark, trades), data.curve_frame(spark, curve), fx_frame(spark, rates), AS_OF, day_count
    ).select("id", "swapvalue", "price_status")
    got = {r.id: (r.swapvalue, r.price_status) for r in rows.collect()}
    expected = {t["id"]: naive.value(t, curve, rates, AS_OF, day_count) for t in trades}
    expected = {k: v for k, v in expected.items() if v is not None}
    assert got.keys() == expected.keys()
    for trade_id, (amount, status) in expected.items():
        assert got[trade_id][1] == status, trade_id
        if amount is None:
            assert got[trade_id][0] is None
        else:
            assert got[trade_id][0] == pytest.approx(amount, rel=1e-12, abs=1e-4)
    return {status for _, status in expected.values()}


@pytest.mark.parametrize("day_count", ["whole_years", "act_360"])
@pytest.mark.parametrize("holes", [0.0, 0.02])
def test_random_book_equals_the_rules_written_out(spark, day_count, holes):
    rng = random.Random(7)
    trades = [data.trade(rng, i, two_foreign=0.2) for i in range(1500)]
    rates = {c: 0.5 + rng.random() / 2 for c in data.CURRENCIES if c != "XAU"}
    seen = check(spark, trades, data.curve_rates(holes=holes), rates, day_count)
    assert seen == {"ok", "missing_ir", "missing_fx"}


def test_random_books_with_any_offsets(spark):
    """Settlement far behind, far ahead and on a period boundary; short and long trades."""
    rng = random.Random(11)
    trades = []
    for i in range(1500):
        settlement = AS_OF - dt.timedelta(rng.choice([0, 90, 180, 360, 720, -90, -400, rng.randint(-900, 1500)]))
        span = rng.choice([0, 89, 90, 180, 359, 360, 1080, -50, rng.randint(0, 1500)])
        trades.append(
            data.trade(rng, i, settlementdate=settlement, maturitydate=settlement + dt.timedelta(span))
        )
    check(spark, trades, data.curve_rates(holes=0.01), {c: 0.75 for c in data.CURRENCIES})


@pytest.mark.parametrize(
    "day_count, fixed, swapvalue",
    [("whole_years", 2.0744973545, 121877841.2698), ("act_360", 2.0196367610, 118586205.6573)],
)
def test_worked_example(spark, day_count, fixed, swapvalue):
    flat = {(term, day): 0.08 for term in naive.DAYS for day in range(1, 1098)}
    settlement = AS_OF - dt.timedelta(100)
    swap = data.trade(
        random.Random(1),
        1,
        settlementdate=settlement,
        maturitydate=settlement + dt.timedelta(720),
        notional=30e6,
        longshort="LONG",
        receiveindex="FIXED",
        receiveccy="EUR",
        payindex="LIBOR",
        payccy="USD",
        frequency="1Y",
        xccy="EUR",
    )
    trades, curve = data.trade_frame(spark, [swap]), data.curve_frame(spark, flat)
    row = price(trades, curve, fx_frame(spark, {"EUR": 0.5}), AS_OF, day_count).first()
    assert row.fixed_leg == pytest.approx(fixed, abs=1e-10)
    assert row.float_leg == pytest.approx(0.0864, abs=1e-12)
    assert row.swapvalue == pytest.approx(swapvalue, abs=1e-4)
    assert par_rate_grid(curve, day_count).filter("term = '1Y' AND periods = 2").first().par_rate == pytest.approx(
        0.0771428571, abs=1e-10
    )


def test_every_sign_case(spark):
    rng = random.Random(3)
    base = data.trade(rng, 0, settlementdate=dt.date(2023, 3, 1), maturitydate=dt.date(2025, 3, 1))
    trades = []
    for side in ("LONG", "SHORT", "OTHER"):
        for pay in ("FIXED", "LIBOR", "OTHER"):
            for receive in ("FIXED", "LIBOR", "OTHER"):
                name = f"{side}-{pay}-{receive}"
                trades.append({**base, "id": name, "longshort": side, "payindex": pay, "receiveindex": receive})
    rows = price(
        data.trade_frame(spark, trades),
        data.curve_frame(spark, data.curve_rates()),
        fx_frame(spark, {c: 0.6 for c in data.CURRENCIES}),
        AS_OF,
    ).collect()
    values = {r.id: r.swapvalue for r in rows}
    assert len(values) == 27
    for name, amount in values.items():
        side, pay, receive = name.split("-")
        if "OTHER" in name or (pay, receive) == ("LIBOR", "LIBOR"):
            assert amount == 0
        elif side == "SHORT":
            assert amount == -values[f"LONG-{pay}-{receive}"] != 0


def test_value_is_linear_in_notional_and_zero_rate_is_missing(spark):
    rng = random.Random(5)
    base = data.trade(
        rng, 1, settlementdate=dt.date(2023, 3, 1), payindex="FIXED", payccy="EUR", receiveccy="USD", xccy="EUR"
    )
    double = {**base, "id": "double", "notional": base["notional"] * 2}
    foreign = {**base, "id": "zero", "payccy": "JPY", "xccy": "JPY"}
    rows = price(
        data.trade_frame(spark, [base, double, foreign]),
        data.curve_frame(spark, data.curve_rates()),
        fx_frame(spark, {"EUR": 0.6, "JPY": 0.0}),
        AS_OF,
    )
    good, bad = split_priced(rows)
    values = {r.id: r.swapvalue for r in good.collect()}
    assert values["double"] == 2 * values[base["id"]]
    assert [(r.id, r.price_status) for r in bad.collect()] == [("zero", "missing_fx")]


def test_unknown_frequency_is_kept_without_value(spark):
    odd = data.trade(random.Random(2), 1, frequency="2W", payindex="FIXED")
    rows = price(
        data.trade_frame(spark, [odd]), data.curve_frame(spark, data.curve_rates()), fx_frame(spark, {}), AS_OF
    ).collect()
    assert [(r.swapvalue, r.price_status) for r in rows] == [(None, "missing_ir")]


def test_as_of_column_prices_each_row_at_its_own_date(spark):
    rng = random.Random(9)
    trades = [data.trade(rng, i) for i in range(200)]
    curve = data.curve_frame(spark, data.curve_rates())
    days = [AS_OF, AS_OF + dt.timedelta(3)]
    fx = fx_frame(spark, {c: 0.7 for c in data.CURRENCIES}).unionByName(
        fx_frame(spark, {c: 0.9 for c in data.CURRENCIES}, days[1])
    )
    book = data.trade_frame(spark, trades)
    dated = book.withColumn("day", F.when(F.col("xccy") < "GBP", F.lit(days[0])).otherwise(F.lit(days[1])))
    got = {r.id: r.swapvalue for r in price(dated, curve, fx, F.col("day")).collect()}
    for day, some in ((days[0], book.filter("xccy < 'GBP'")), (days[1], book.filter("xccy >= 'GBP'"))):
        for r in price(some, curve, fx, day).collect():
            assert got[r.id] == r.swapvalue


def test_day_counts_agree_on_whole_years(spark):
    swap = data.trade(
        random.Random(1), 1, frequency="1Y", settlementdate=AS_OF, maturitydate=AS_OF + dt.timedelta(1080)
    )
    curve = data.curve_frame(spark, data.curve_rates())
    one, other = (
        leg_values(data.trade_frame(spark, [swap]), curve, AS_OF, dc).first() for dc in ("whole_years", "act_360")
    )
    assert one.fixed_leg == other.fixed_leg is not None


def test_curve_points_rules(spark):
    rows = [(1, "LIBOR", "3M", 0.01), (1, "LIBOR", "3M", 0.02), (400, "LIBOR", "3M", 0.05), (5, "OTHER", "3M", 0.9)]
    curve = spark.createDataFrame(rows, data.CURVE)
    points = {r.days: r for r in curve_points(curve).collect()}
    assert set(points) == {1, 400}
    assert points[1].rate == 0.02 and points[1].discount_factor == 1.0
    assert points[400].discount_factor == pytest.approx(1 / 1.05)
    with pytest.raises(Exception, match="curve reaches past"):
        curve_points(spark.createDataFrame([(99_999, "LIBOR", "3M", 0.1)], data.CURVE)).collect()
    with pytest.raises(ValueError):
        curve_points(curve, "30/360")


def test_transform_style(spark):
    trades = data.trade_frame(spark, [data.trade(random.Random(4), i) for i in range(20)])
    curve, fx = data.curve_frame(spark, data.curve_rates()), fx_frame(spark, {c: 0.6 for c in data.CURRENCIES})
    rows = trades.transform(lambda t: pricing.price(t, curve, fx, AS_OF, valuation_ts="2024-01-15 10:00:00"))
    assert {r.valuationdate for r in rows.collect()} == {dt.datetime(2024, 1, 15, 10)}
