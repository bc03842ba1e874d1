import datetime as dt
import json
import os

import data
from pyspark.sql import functions as F

from swapbook.functions import dates, keys
from swapbook.operators.curve import curve_points
from swapbook.sources import curves, messages


def test_curve_files_are_one_table_without_headers(spark, folder):
    os.makedirs(f"{folder}/ir_data")
    for term in ("3M", "6M", "1Y"):
        with open(f"{folder}/ir_data/ir_{term}.txt", "w", encoding="utf-8") as out:
            out.write(f"days\tindex\tterm\trate\n1\tLIBOR\t{term} \t0.0811\n2\tLIBOR\t{term}\t0.0822\n")
    rows = curves.read_curve(spark, curves.curve_paths(folder)).collect()
    assert sorted(map(tuple, rows)) == sorted(
        (d, "LIBOR", t, r) for t in ("3M", "6M", "1Y") for d, r in ((1, 0.0811), (2, 0.0822))
    )


def test_fx_seed_comes_before_every_tick(spark, folder):
    with open(f"{folder}/fx_USD.txt", "w") as out:
        out.write("1/5/2024\tUSD\tEUR\t0.7\n01/06/2024\tUSD\tJPY\t0.8\nbad\tUSD\tJPY\t0.9\n")
    rows = curves.read_fx_seed(spark, f"{folder}/fx_USD.txt").collect()
    assert sorted(map(tuple, rows)) == [
        (-1, dt.date(2024, 1, 5), "USD", "EUR", 0.7),
        (-1, dt.date(2024, 1, 6), "USD", "JPY", 0.8),
    ]


def test_spoiled_curve_lines_are_set_aside_and_the_rest_prices(spark, folder):
    good = "30\tLIBOR\t3M\t0.08"
    bad = {
        "x\tLIBOR\t3M\t0.08": "bad days", "-1\tLIBOR\t3M\t0.08": "bad days", "40000\tLIBOR\t3M\t0.08": "beyond reach",
        "30\t\t3M\t0.08": "no index", "30\tLIBOR\t2W\t0.08": "unknown term", "30\tLIBOR\t3M\t": "bad rate",
        "30\tLIBOR\t3M\tNaN": "bad rate", "30\tLIBOR\t3M\t1e400": "bad rate", "30\tLIBOR\t3M": "wrong number of fields",
        "30\tLIBOR\t3M\t0.08\t1": "wrong number of fields",
    }
    with open(f"{folder}/c.txt", "w", encoding="utf-8") as out:
        out.write("\n".join(["days\tindex\tterm\trate", good, *bad, "", "31\tLIB\u00e9OR\t3M\t0.09"]) + "\n")
    judged = curves.judged_curve(spark, f"{folder}/c.txt")
    assert {r.line: r.reject_reason for r in curves.rejected(judged).collect()} == bad
    usable = curves.read_curve(spark, f"{folder}/c.txt")
    assert sorted(map(tuple, usable.collect())) == [(30, "LIBOR", "3M", 0.08), (31, "LIBOR", "3M", 0.09)]
    assert curve_points(usable).count() == 2
    # fields that are not asked for count all the same
    assert judged.filter("reject_reason IS NULL").select("rate").count() == 2


def test_spoiled_seed_lines_are_set_aside_and_empty_files_are_empty(spark, folder):
    os.makedirs(f"{folder}/fx")
    bad = {"x\tUSD\tJPY\t0.9": "bad date", "1/5/2024\tUSD\tXXX\t0.9": "unknown currency", "1/5/2024\tUSD\tJPY\t0": "bad rate", "1/5/2024": "wrong number of fields"}
    with open(f"{folder}/fx/a.txt", "w") as out:
        out.write("\n".join([*bad, "1/5/2024\tUSD\tJPY\t0.9"]))
    open(f"{folder}/fx/b.txt", "w").close()
    judged = curves.judged_fx_seed(spark, f"{folder}/fx")
    assert {r.line: r.reject_reason for r in curves.rejected(judged).collect()} == bad
    assert curves.read_fx_seed(spark, f"{folder}/fx").select("price", "rate").collect() == [("JPY", 0.9)]
    assert curves.read_curve(spark, f"{folder}/fx/b.txt").collect() == []


def swap(**changes):
    body = {
        "source_stream": "swap_stream", "id": "SWAP1", "organization": "org1", "tradedate": "2023-01-01",
        "settlementdate": "2023-01-03", "maturitydate": "2025-01-03", "notional": "30000000", "counterparty": "None",
        "longshort": "LONG", "payccy": "USD", "receiveccy": "EUR", "payindex": "FIXED", "receiveindex": "LIBOR",
        "frequency": "3M", "valuationdate": "2023-01-01 10:00:00", "swapvalue": "0",
    }
    return json.dumps({k: v for k, v in {**body, **changes}.items() if v is not None})


def reasons(spark, make, texts):
    raw = spark.createDataFrame(list(enumerate(texts)), "seq BIGINT, value STRING")
    return {r.seq: r.reject_reason for r in make(messages.decode(raw)).select("seq", "reject_reason").collect()}


def test_trades_are_typed_or_rejected_with_a_reason(spark):
    changes = [
        ({}, None),
        ({"id": None}, "no id"),
        ({"organization": None}, "no organization"),
        ({"settlementdate": "01/03/2023"}, "bad date"),
        ({"maturitydate": None}, "bad date"),
        ({"notional": "many"}, "bad notional"),
        ({"frequency": "2W"}, "unknown frequency"),
        ({"frequency": None}, "unknown frequency"),
        ({"receiveccy": "XXX"}, "unknown currency"),
        ({"source_stream": None}, "not a message"),
    ]
    got = reasons(spark, messages.trades, [swap(**c) for c, _ in changes] + ["[]", "nonsense"])
    assert got == {i: reason for i, (_, reason) in enumerate([*changes, ({}, "not a message"), ({}, "not a message")])}


def test_ticks_are_typed_or_rejected_with_a_reason(spark):
    base = {"source_stream": "fx_stream", "date": "1/5/2024", "base": "USD", "price": "EUR", "rate": "0.7"}
    cases = [({}, None), ({"date": "2024-01-05"}, "bad date"), ({"price": "USD"}, "unknown currency"),
             ({"rate": "x"}, "bad rate"), ({"rate": "0"}, "bad rate"), ({"rate": "NaN"}, "bad rate")]
    got = reasons(spark, messages.ticks, [json.dumps({**base, **c}) for c, _ in cases] + [swap()])
    assert got == {i: reason for i, (_, reason) in enumerate(cases)}


def test_trade_message_round_trip(spark):
    raw = spark.createDataFrame([(7, swap())], "seq BIGINT, value STRING")
    trades = messages.accepted(messages.trades(messages.decode(raw)))
    again = trades.select("seq", messages.trade_json(trades).alias("value"))
    assert trades.collect() == messages.accepted(messages.trades(messages.decode(again))).collect()
    row = trades.first()
    assert (row.xccy, row.valuationdate, row.notional) == ("EUR", dt.datetime(2023, 1, 1, 10), 30e6)


def test_date_spellings_and_keys(spark):
    frame = spark.createDataFrame([("01/05/2024", "2024-01-05", dt.date(2024, 1, 5))], "slash STRING, dash STRING, d DATE")
    row = frame.select(
        dates.format_dash_date(F.col("slash")),
        dates.format_slash_date(F.col("dash")),
        dates.format_unpadded_date(F.col("d")),
        keys.rate_key(F.lit(90), F.lit("3M")),
        keys.fx_key(F.col("d"), F.lit("EUR")),
        keys.topic_for("t", F.lit("EUR")),
        dates.parse_dash_date(F.lit("no date")),
    ).first()
    assert tuple(row) == ("2024-01-05", "01/05/2024", "1/5/2024", "90-LIBOR-3M", "1/5/2024-USD-EUR", "t_EUR", None)


def test_schedule_rules(spark):
    from swapbook.operators import schedule

    rows = [
        data.trade(__import__("random").Random(1), 1, frequency="3M", settlementdate=dt.date(2023, 1, 1),
                   maturitydate=dt.date(2023, 1, 1) + dt.timedelta(280)),
        data.trade(__import__("random").Random(1), 2, frequency="1Y", settlementdate=dt.date(2023, 1, 1),
                   maturitydate=dt.date(2023, 6, 1)),
        data.trade(__import__("random").Random(1), 3, frequency="1Y", settlementdate=dt.date(2023, 1, 1),
                   maturitydate=dt.date(2022, 6, 1)),
    ]
    trades = data.trade_frame(spark, rows)
    assert [(r.id, r.months, r.n, r.np) for r in schedule.trade_terms(trades).orderBy("id").collect()] == [
        ("SWAP1", 3, 90, 3), ("SWAP2", 12, 360, 0), ("SWAP3", 12, 360, 0)
    ]
    days = [(r.paymentdate - dt.date(2023, 1, 1)).days for r in schedule.payment_schedule(trades).orderBy("payment_no").collect()]
    assert days == [90, 270, 450]
    array = schedule.with_periods_only(schedule.trade_terms(trades)).select(
        schedule.payment_dates(F.col("settlementdate"), F.col("n"), F.col("np")).alias("p")
    ).first().p
    assert [(d - dt.date(2023, 1, 1)).days for d in array] == days
    for elapsed, reset in ((-50, 90), (0, 90), (179, 90), (180, 270), (360, 450), (5000, 450)):
        row = schedule.reset_dates(trades, dt.date(2023, 1, 1) + dt.timedelta(elapsed)).first()
        assert (row.resetdate - dt.date(2023, 1, 1)).days == reset


def test_amounts_and_times_beyond_use_are_rejected(spark):
    changes = [({"notional": "NaN"}, "bad notional"), ({"notional": "1e30"}, "bad notional"), ({"swapvalue": "many"}, "bad value"),
               ({"swapvalue": "Infinity"}, "bad value"), ({"valuationdate": "tomorrow"}, "bad valuation date"),
               ({"valuationdate": "", "swapvalue": ""}, None)]
    got = reasons(spark, messages.trades, [swap(**c) for c, _ in changes])
    assert got == {i: reason for i, (_, reason) in enumerate(changes)}


def test_a_message_is_parsed_once(spark):
    raw = spark.createDataFrame([(1, swap()), (2, "{}")], "seq BIGINT, value STRING")
    for frame in (
        messages.routed(messages.decode(raw)), messages.accepted(messages.events(messages.decode(raw))),
        messages.rejected(messages.events(messages.decode(raw))),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json") == 1, plan
