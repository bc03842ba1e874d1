"""The three date spellings of the messages, as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DASH = "yyyy-MM-dd"
SLASH_PADDED = "MM/dd/yyyy"
SLASH = "M/d/yyyy"  # reads padded and unpadded, prints unpadded


def parse_dash_date(text: Column) -> Column:
    """Date of a ``2024-01-05`` text, NULL when it is none."""
    return F.try_to_date(text, DASH)


def parse_slash_date(text: Column) -> Column:
    """Date of a ``1/5/2024`` or ``01/05/2024`` text, NULL when it is none."""
    return F.try_to_date(text, SLASH)


def format_dash_date(text: Column) -> Column:
    """``01/05/2024`` -> ``2024-01-05``."""
    return F.date_format(parse_slash_date(text), DASH)


def format_slash_date(text: Column) -> Column:
    """``2024-01-05`` -> ``01/05/2024``."""
    return F.date_format(parse_dash_date(text), SLASH_PADDED)


def format_unpadded_date(day: Column) -> Column:
    """A date as ``1/5/2024``, the spelling used in FX keys."""
    return F.date_format(day, SLASH)


def as_date_column(value: Column | dt.date | str) -> Column:
    """A date argument given as a column, a date or an ISO text."""
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("date")
