"""DuckDB SQL that states what each named query must return.

The formulation is unlike the engine's: periods are unnested, joined with the curve and summed
per trade, and re-pricing joins every close with every earlier message.
"""

from __future__ import annotations

_CURVE = """curve AS (
  SELECT CAST(days AS INTEGER) AS days, term, 0.08::DOUBLE + CAST((days * 7919 + t * 104729) % 10007 AS DOUBLE) / 1000700 AS rate
  FROM (SELECT DISTINCT o_orderkey % 1097 + 1 AS days FROM orders) d
  CROSS JOIN (VALUES ('3M', 0), ('6M', 1), ('1Y', 2)) x(term, t))"""

_TENOR = "tenor AS (SELECT * FROM (VALUES ('3M', 3, 90), ('6M', 6, 180), ('1Y', 12, 360)) x(term, months, n))"


def _ccy(expression: str) -> str:
    return f"(['EUR','JPY','GBP','AUD','CHF','XAG','XAU','NZD'])[CAST({expression} AS INTEGER) + 1]"


def _trades(name: str, source: str) -> str:
    return f"""{name} AS (
  SELECT 'SWAP' || k AS id, 'org' || (k * 31 % 750 + 1) AS organization,
    DATE '2022-03-31' + CAST(k * 37 % 732 AS INTEGER) AS tradedate,
    DATE '2022-03-31' + CAST(k * 37 % 732 + 2 AS INTEGER) AS settlementdate,
    DATE '2022-03-31' + CAST(722 + 360 * (k * 43 % 53 % 2) AS INTEGER) AS maturitydate,
    CAST(millions * 1000000 AS DOUBLE) AS notional, 'org' || (k * 7919 % 10000 + 1) AS counterparty,
    CASE WHEN k * 31 % 7 % 2 = 0 THEN 'LONG' ELSE 'SHORT' END AS longshort,
    CASE WHEN k * 17 % 11 % 2 = 0 THEN 'USD' ELSE {_ccy('k * 19 % 41 % 8')} END AS payccy,
    CASE WHEN k * 17 % 11 % 2 = 0 THEN {_ccy('k * 19 % 41 % 8')} ELSE 'USD' END AS receiveccy,
    CASE WHEN k * 13 % 19 % 2 = 0 THEN 'FIXED' ELSE 'LIBOR' END AS payindex,
    CASE WHEN k * 29 % 23 % 2 = 0 THEN 'FIXED' ELSE 'LIBOR' END AS receiveindex,
    CASE k * 41 % 37 % 3 WHEN 0 THEN '3M' WHEN 1 THEN '6M' ELSE '1Y' END AS frequency,
    {_ccy('k * 19 % 41 % 8')} AS xccy, seq
  FROM ({source}) o)"""


_ORDERS = """SELECT o_orderkey AS k, o_orderkey * 131 % 71 + 30 AS millions,
  o_orderkey * 7919 % 2592000 * 1000000 + 1704067200000000 AS seq FROM orders"""
_LINES = """SELECT l_orderkey AS k, (l_partkey * 131 + l_linenumber) % 71 + 30 AS millions,
  (l_orderkey * 7919 + l_linenumber * 86413 + l_partkey * 37) % 2592000 * 1000000 + l_linenumber * 100000
  + l_suppkey % 1000 * 100 + CAST(l_quantity AS BIGINT) % 100 + 1704067200000000 AS seq FROM lineitem"""

_TRADE = _trades("trade", _ORDERS)
_MESSAGE = _trades("message", f"{_ORDERS} UNION ALL {_LINES}")

_TICK = f"""tick AS (
  SELECT epoch_us(ts) AS seq, CAST(ts AS DATE) AS date, 'USD' AS base, {_ccy('user_id % 8')} AS price,
    0.5::DOUBLE + CAST(event_id * 7919 % 10007 AS DOUBLE) / 20014 AS rate
  FROM events)"""

_FX = "fx AS (SELECT date, base, price, arg_max(rate, seq) AS rate FROM tick GROUP BY date, base, price)"

# message versions in force when the last tick of a currency and day arrived
_VERSION = """version AS MATERIALIZED (
  SELECT *, lead(seq) OVER (PARTITION BY xccy, id ORDER BY seq) AS next_seq FROM message)"""
_REVALUED = f"""{_VERSION}, closing AS MATERIALIZED (
  SELECT price, seq // 86400000000 AS day_no, max(seq) AS tick_seq, arg_max(date, seq) AS as_of, arg_max(rate, seq) AS rate
  FROM tick GROUP BY price, seq // 86400000000),
src AS MATERIALIZED (
  SELECT c.tick_seq, c.as_of, c.rate, v.* EXCLUDE (next_seq)
  FROM closing c JOIN version v ON v.xccy = c.price AND v.seq < c.tick_seq AND coalesce(v.next_seq, c.tick_seq) >= c.tick_seq)"""

# message versions in force at every tick of their currency
_AT_TICK = f"""{_VERSION},
src AS MATERIALIZED (
  SELECT t.seq AS tick_seq, t.date AS as_of, t.rate, v.* EXCLUDE (next_seq)
  FROM tick t JOIN version v ON v.xccy = t.price AND v.seq < t.seq AND coalesce(v.next_seq, t.seq) >= t.seq)"""

# message versions that the ticks of a currency and date can see
_SEEN = f"""{_VERSION}, span AS MATERIALIZED (
  SELECT price, date, min(seq) AS first_seq, max(seq) AS last_seq FROM tick GROUP BY price, date),
src AS MATERIALIZED (
  SELECT s.date AS as_of, v.* FROM span s
  JOIN version v ON v.xccy = s.price AND v.seq < s.last_seq AND coalesce(v.next_seq, s.first_seq) >= s.first_seq)"""

_PRICED_AT = """src AS (
  SELECT t.*, DATE '2024-01-15' AS as_of, x.rate FROM trade t LEFT JOIN fx x ON x.date = DATE '2024-01-15' AND x.price = t.xccy)"""


def _legs(day_count: str) -> str:
    years = "(days // 360)" if day_count == "whole_years" else "(days / 360.0::DOUBLE)"
    return f"""{_TENOR}, {_CURVE},
point AS MATERIALIZED (SELECT term, days, rate, 1 / (1 + rate * {years}) AS df FROM curve),
shape AS (
  SELECT s.*, n, date_diff('day', sd, md) // n AS np, date_diff('day', sd, as_of) AS e
  FROM (SELECT DISTINCT frequency, settlementdate AS sd, maturitydate AS md, as_of FROM src) s JOIN tenor ON term = frequency),
live AS (SELECT * FROM shape WHERE np >= 1),
par AS (
  SELECT frequency, np, CASE WHEN count(*) = count(df) THEN (1 - arg_max(df, k)) / sum(df ORDER BY k) END AS fr
  FROM (SELECT DISTINCT frequency, n, np FROM live) g, unnest(range(1, np + 1)) u(k)
  LEFT JOIN point ON term = frequency AND days = k * n GROUP BY frequency, np),
remaining AS (
  SELECT frequency, sd, md, as_of, count(*) AS wanted, count(df) AS known, sum(df ORDER BY k) AS total, arg_max(df, k) AS last_df
  FROM (SELECT * FROM live, unnest(range(1, np + 1)) u(k) WHERE k * n - e >= 0) r
  LEFT JOIN point ON term = frequency AND days = k * n - e GROUP BY frequency, sd, md, as_of),
reset AS (
  SELECT frequency, sd, md, as_of, n, np, e, n - (e - (2 * coalesce(min(k) FILTER (e - (2 * k - 1) * n < n), max(np)) - 1) * n) AS s0
  FROM live, unnest(range(1, np + 1)) u(k) GROUP BY frequency, sd, md, as_of, n, np, e),
forward AS (
  SELECT frequency, sd, md, as_of, coalesce(min(s0 + q * n) FILTER (s0 + q * n >= 0), max(s0 + np * n)) AS s
  FROM reset, unnest(range(0, np + 1)) u(q) GROUP BY frequency, sd, md, as_of),
leg AS MATERIALIZED (
  SELECT l.frequency, l.sd, l.md, l.as_of, l.n, l.np, l.e,
    CASE WHEN m.wanted IS NULL THEN p.fr * 0 + 1 WHEN m.wanted = m.known THEN p.fr * m.total + (1 + m.last_df) END AS fixed_leg,
    (1 + a.rate) * b.rate AS float_leg
  FROM live l
  JOIN par p ON p.frequency = l.frequency AND p.np = l.np
  LEFT JOIN remaining m ON (m.frequency, m.sd, m.md, m.as_of) = (l.frequency, l.sd, l.md, l.as_of)
  JOIN forward f ON (f.frequency, f.sd, f.md, f.as_of) = (l.frequency, l.sd, l.md, l.as_of)
  LEFT JOIN curve a ON a.term = l.frequency AND a.days = l.n
  LEFT JOIN curve b ON b.term = l.frequency AND b.days = f.s)"""


_LEGGED = """legged AS (
  SELECT s.*, g.n, g.np, g.e AS elapsed, g.fixed_leg, g.float_leg,
    CASE WHEN payindex = 'FIXED' THEN fixed_leg ELSE float_leg END AS pay_leg,
    CASE WHEN receiveindex = 'FIXED' THEN fixed_leg ELSE float_leg END AS receive_leg,
    payindex = 'LIBOR' AND receiveindex = 'LIBOR' AS worthless,
    CASE longshort WHEN 'LONG' THEN 1 ELSE -1 END AS sign
  FROM src s JOIN leg g ON (g.frequency, g.sd, g.md, g.as_of) = (s.frequency, s.settlementdate, s.maturitydate, s.as_of))"""


def _value(rate: str) -> str:
    return f"""CASE WHEN worthless THEN 0 ELSE sign * (
      CASE receiveccy WHEN 'USD' THEN receive_leg ELSE receive_leg / {rate} END
      - CASE payccy WHEN 'USD' THEN pay_leg ELSE pay_leg / {rate} END) * notional END"""


_PRICED = f"""priced AS (
  SELECT *, CASE WHEN swapvalue IS NOT NULL THEN 'ok' WHEN pay_leg IS NULL OR receive_leg IS NULL THEN 'missing_ir'
    ELSE 'missing_fx' END AS price_status
  FROM (SELECT *, {_value('rate')} AS swapvalue FROM legged) v)"""

_AT_EACH_TICK = f"""at_tick AS (
  SELECT t.seq AS tick_seq, t.price, t.date, t.rate, l.id, {_value('t.rate')} AS swapvalue
  FROM tick t LEFT JOIN legged l ON l.xccy = t.price AND l.as_of = t.date AND l.seq < t.seq AND coalesce(l.next_seq, t.seq) >= t.seq)"""

_CENTS = "CAST(CAST(swapvalue AS DECIMAL(18,2)) AS DOUBLE) AS swapvalue"


def _at_date(day_count: str = "whole_years") -> str:
    return f"WITH {_TRADE}, {_TICK}, {_FX}, {_PRICED_AT}, {_legs(day_count)}, {_LEGGED}, {_PRICED}"


_TICKS = f"WITH {_MESSAGE}, {_TICK}, {_REVALUED}, {_legs('whole_years')}, {_LEGGED}, {_PRICED}"
_EVERY_TICK = f"WITH {_MESSAGE}, {_TICK}, {_AT_TICK}, {_legs('whole_years')}, {_LEGGED}, {_PRICED}"
_HISTORY = f"""{_TICKS}, valuation AS (
  SELECT *, make_timestamp(tick_seq) AS valuationdate FROM priced WHERE price_status = 'ok')"""
_LATEST = f"""{_HISTORY}, latest AS (
  SELECT v.* FROM valuation v JOIN (
    SELECT organization, id, payccy, receiveccy, max(valuationdate) AS valuationdate FROM valuation GROUP BY ALL) m
  USING (organization, id, payccy, receiveccy, valuationdate))"""

_STAMP = "strftime(valuationdate, '%Y-%m-%d %H:%M:%S') AS valuationdate"
_SUM = "sum(CAST(swapvalue AS DECIMAL(18,2)))"
_BY_CCY = f"{_LATEST}, by_ccy AS (SELECT organization, payccy, {_SUM} AS v FROM latest GROUP BY organization, payccy)"
_DRILLDOWN = f"""{_BY_CCY}
SELECT organization, CAST(sum(v) AS DOUBLE) AS portfoliovalue, round(CAST(sum(v) AS DOUBLE) / 100000000, 6) AS y,
  string_agg(payccy || ':' || CAST(CAST(v AS DECIMAL(28,2)) AS VARCHAR), ',' ORDER BY payccy) AS drilldown
FROM by_ccy GROUP BY organization"""


def _swap_valuation(day_count: str) -> str:
    return f"""{_at_date(day_count)}
SELECT id, organization, counterparty, xccy, longshort, payccy, receiveccy, payindex, receiveindex, frequency, notional,
  CAST(np AS INTEGER) AS np, {_CENTS}, price_status FROM priced"""


def _leg_values(day_count: str) -> str:
    return f"""{_at_date(day_count)}
SELECT id, CAST(np AS INTEGER) AS np, CAST(elapsed AS INTEGER) AS elapsed, round(fixed_leg, 9) AS fixed_leg,
  round(float_leg, 9) AS float_leg FROM legged"""


def _fx_sensitivity(day_count: str) -> str:
    shocked = _value("(rate * (1.0::DOUBLE + shock))")
    return f"""{_at_date(day_count)}
SELECT organization, xccy, shock, count(*) AS trades,
  round(CAST(sum(CAST({shocked} - swapvalue AS DECIMAL(28,8))) AS DOUBLE), 0) AS change
FROM priced CROSS JOIN (VALUES (-0.1::DOUBLE), (-0.01::DOUBLE), (0.01::DOUBLE), (0.1::DOUBLE)) x(shock)
WHERE price_status = 'ok' GROUP BY organization, xccy, shock"""


_JUDGED = f"""WITH {_TRADE}, {_TICK},
sent AS (
  SELECT seq, 'trade' AS kind, seq // 1000000 % 41 AS harm, payccy FROM trade
  UNION ALL SELECT seq, 'tick', seq // 1000000 % 41, NULL FROM tick),
judged AS (
  SELECT seq, kind, CASE WHEN harm IN (0, 1) THEN 'not a message'
    WHEN kind = 'trade' THEN CASE harm WHEN 2 THEN 'bad notional' WHEN 3 THEN 'bad date' WHEN 4 THEN 'unknown frequency'
      WHEN 5 THEN 'unknown currency' WHEN 9 THEN 'bad value' ELSE '' END
    ELSE CASE harm WHEN 6 THEN 'bad rate' WHEN 7 THEN 'unknown currency' WHEN 8 THEN 'bad date' ELSE '' END END AS reject_reason
  FROM sent)"""

SQL: dict[str, str] = {
    "curve_points": f"""WITH {_CURVE}
SELECT term, days, rate, CAST(days // 360 AS DOUBLE) AS year_fraction, round(1 / (1 + rate * (days // 360)), 9) AS discount_factor
FROM curve""",
    "par_rate_grid": f"""WITH {_TENOR}, {_CURVE}
SELECT term, n, CAST(p AS INTEGER) AS periods, round(sum(df ORDER BY k), 9) AS df_sum,
  round((1 - arg_max(df, k)) / sum(df ORDER BY k), 9) AS par_rate
FROM (SELECT t.term, t.n, p, k, 1 / (1 + c.rate * (c.days // 360)) AS df
      FROM tenor t, unnest(range(1, 1097 // t.n + 1)) u(p), unnest(range(1, p + 1)) w(k)
      JOIN curve c ON c.term = t.term AND c.days = k * t.n) g
GROUP BY term, n, p""",
    "fx_ticks": f"""WITH {_TICK}
SELECT seq, CAST(date AS VARCHAR) AS date, month(date) || '/' || day(date) || '/' || year(date) AS fx_date, base, price, rate
FROM tick""",
    "fx_latest": f"WITH {_TICK}, {_FX} SELECT CAST(date AS VARCHAR) AS date, base, price, rate FROM fx",
    "trades_normalized": f"""WITH {_TRADE}
SELECT seq, id, organization, CAST(tradedate AS VARCHAR) AS tradedate, strftime(settlementdate, '%m/%d/%Y') AS settlement_slash,
  CAST(settlementdate AS VARCHAR) AS settlementdate, CAST(maturitydate AS VARCHAR) AS maturitydate, notional, counterparty,
  longshort, payccy, receiveccy, payindex, receiveindex, frequency, xccy FROM trade""",
    "rejected_messages": f"""{_JUDGED}
SELECT seq, CASE WHEN reject_reason = '' THEN kind ELSE 'rejected' END AS route, reject_reason FROM judged""",
    "topic_order": f"""WITH {_MESSAGE}, {_TICK},
record AS (
  SELECT 'xccy_swaps_' || xccy AS topic, CAST(seq % 3 AS INTEGER) AS partition, seq AS "offset", seq - seq % 3600000000 AS arrived
  FROM (SELECT xccy, seq FROM message UNION ALL SELECT price, seq FROM tick) m)
SELECT *, arrived // 1000 * 1048576 + dense_rank() OVER (PARTITION BY arrived ORDER BY topic, partition, "offset") - 1 AS seq
FROM record""",
    "stream_batch_counts": f"""{_JUDGED}
SELECT CASE WHEN reject_reason = '' THEN kind ELSE 'rejected' END AS route, reject_reason, count(*) AS messages
FROM judged GROUP BY 1, 2""",
    "curve_files": f"""WITH {_CURVE}, line AS (SELECT *, days % 23 AS harm FROM curve)
SELECT CAST(CASE harm WHEN 0 THEN -1 WHEN 1 THEN 99999 ELSE days END AS INTEGER) AS days,
  CASE harm WHEN 2 THEN '' ELSE 'LIBOR' END AS index_name, CASE harm WHEN 4 THEN '2W' ELSE term END AS term,
  CASE WHEN harm IN (5, 6) THEN 0.0::DOUBLE ELSE rate END AS rate,
  CASE harm WHEN 0 THEN 'bad days' WHEN 1 THEN 'beyond reach' WHEN 2 THEN 'no index' WHEN 4 THEN 'unknown term'
    WHEN 5 THEN 'bad rate' WHEN 6 THEN 'wrong number of fields' ELSE '' END AS reject_reason
FROM line""",
    "trade_terms": f"""WITH {_TRADE}, {_TENOR}
SELECT id, months, n, CAST(trunc(date_diff('day', settlementdate, maturitydate) / n) AS INTEGER) AS np
FROM trade JOIN tenor ON term = frequency""",
    "payment_schedule": f"""WITH {_TRADE}, {_TENOR},
t AS (SELECT id, settlementdate, n, date_diff('day', settlementdate, maturitydate) // n AS np FROM trade JOIN tenor ON term = frequency)
SELECT id, CAST(i AS INTEGER) AS payment_no, CAST(settlementdate + CAST((2 * i + 1) * n AS INTEGER) AS VARCHAR) AS paymentdate
FROM t, unnest(range(0, greatest(np, 0))) u(i)""",
    "reset_dates": f"""WITH {_TRADE}, {_TENOR},
t AS (SELECT id, settlementdate AS sd, n, date_diff('day', settlementdate, maturitydate) // n AS np FROM trade JOIN tenor ON term = frequency),
d AS (SELECT id, np, n, i, sd + CAST((2 * i + 1) * n AS INTEGER) AS pd FROM t, unnest(range(0, greatest(np, 0))) u(i))
SELECT id, CAST(np AS INTEGER) AS np,
  CAST(coalesce(min(pd) FILTER (date_diff('day', pd, DATE '2024-01-15') < n), max(pd)) AS VARCHAR) AS resetdate
FROM d GROUP BY id, np""",
    "leg_values": _leg_values("whole_years"),
    "leg_values_act360": _leg_values("act_360"),
    "swap_valuation": _swap_valuation("whole_years"),
    "swap_valuation_act360": _swap_valuation("act_360"),
    "trade_book": f"""WITH {_MESSAGE}
SELECT m.xccy, m.id, organization, notional, m.seq, CAST(settlementdate AS VARCHAR) AS settlementdate, frequency
FROM message m JOIN (SELECT xccy, id, max(seq) AS seq FROM message GROUP BY xccy, id) n USING (xccy, id, seq)""",
    "book_by_ccy": f"""WITH {_MESSAGE}
SELECT m.id, organization, notional, m.seq
FROM message m JOIN (SELECT xccy, id, max(seq) AS seq FROM message GROUP BY xccy, id) n USING (xccy, id, seq)
WHERE xccy = 'EUR'""",
    "revalue_on_tick": f"""{_EVERY_TICK}
SELECT tick_seq, xccy, id, organization, notional, seq AS trade_seq, {_CENTS}, price_status FROM priced""",
    "stream_revalue_on_tick": f"""{_TICKS}
SELECT tick_seq, xccy, id, organization, notional, seq AS trade_seq, {_CENTS}, price_status FROM priced""",
    "tick_book_value": f"""WITH {_MESSAGE}, {_TICK}, {_SEEN}, {_legs('whole_years')}, {_LEGGED}, {_AT_EACH_TICK}
SELECT tick_seq, price AS xccy, CAST(date AS VARCHAR) AS date, rate, count(swapvalue) AS trades, count(id) - count(swapvalue) AS unpriced,
  round(coalesce(sum(swapvalue), 0.0::DOUBLE) / 100000000, 6) AS y
FROM at_tick GROUP BY tick_seq, price, date, rate""",
    "events_per_batch": f"""WITH {_MESSAGE}, {_TICK}
SELECT seq // 10000000 AS batch, count(*) AS messages FROM (SELECT seq FROM message UNION ALL SELECT seq FROM tick) a GROUP BY 1""",
    "latest_valuation": f"{_LATEST} SELECT organization, id, payccy, receiveccy, {_CENTS}, {_STAMP} FROM latest",
    "latest_valuation_rows": f"""{_LATEST}
SELECT organization, id, payccy, receiveccy, counterparty, notional, frequency, {_CENTS}, {_STAMP} FROM latest""",
    "latest_for_org": f"""{_LATEST}
SELECT organization, id, payccy, receiveccy, {_CENTS}, {_STAMP} FROM latest WHERE organization = 'org32'""",
    "org_valuations": f"{_HISTORY} SELECT id, organization, {_STAMP}, {_CENTS} FROM valuation WHERE organization = 'org32'",
    "swap_history": f"{_HISTORY} SELECT id, organization, {_STAMP}, {_CENTS} FROM valuation WHERE id = 'SWAP1001'",
    "portfolio_value": f"""{_LATEST}
SELECT organization, CAST({_SUM} AS DOUBLE) AS portfoliovalue FROM latest GROUP BY organization""",
    "portfolio_by_ccy": f"{_BY_CCY} SELECT organization, payccy, CAST(v AS DOUBLE) AS portfoliovalue FROM by_ccy",
    "portfolio_grouping_sets": f"""{_LATEST}
SELECT organization, coalesce(payccy, 'all') AS payccy, CAST({_SUM} AS DOUBLE) AS portfoliovalue
FROM latest GROUP BY GROUPING SETS ((organization), (organization, payccy))""",
    "portfolio_ranked": f"""{_LATEST}
SELECT organization, CAST({_SUM} AS DOUBLE) AS portfoliovalue FROM latest GROUP BY organization
ORDER BY portfoliovalue DESC, organization""",
    "portfolio_drilldown": _DRILLDOWN,
    "portfolio_report": _DRILLDOWN,
    "net_liability": f"""{_LATEST}
SELECT organization, CAST(sum(least(CAST(swapvalue AS DECIMAL(18,2)), 0)) AS DOUBLE) AS owed,
  count(*) FILTER (swapvalue < 0) AS trades_owing FROM latest GROUP BY organization""",
    "counterparty_exposure": f"""{_LATEST}
SELECT organization, counterparty, CAST(sum(greatest(CAST(swapvalue AS DECIMAL(18,2)), 0)) AS DOUBLE) AS exposure,
  CAST({_SUM} AS DOUBLE) AS net, count(*) AS trades FROM latest GROUP BY organization, counterparty""",
    "fx_sensitivity": _fx_sensitivity("whole_years"),
    "fx_sensitivity_act360": _fx_sensitivity("act_360"),
}

SQL["latest_view"] = SQL["latest_valuation"]
SQL["compacted_history"] = SQL["org_valuations"]
