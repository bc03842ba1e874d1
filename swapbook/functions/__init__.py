from swapbook.functions.dates import (
    as_date_column,
    format_dash_date,
    format_slash_date,
    format_unpadded_date,
    parse_dash_date,
    parse_slash_date,
)
from swapbook.functions.keys import fx_key, non_usd_currency, rate_key, strip_non_ascii, topic_for
from swapbook.functions.money import in_chart_units, money

__all__ = [
    "as_date_column",
    "format_dash_date",
    "format_slash_date",
    "format_unpadded_date",
    "fx_key",
    "in_chart_units",
    "money",
    "non_usd_currency",
    "parse_dash_date",
    "parse_slash_date",
    "rate_key",
    "strip_non_ascii",
    "topic_for",
]
