"""Amounts.

Values are priced as doubles. They are summed as decimals of whole cents: a decimal sum does
not depend on the order in which partitions arrive, so a retried task or another number of
executors gives the same portfolio figures.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from swapbook.schemas import CHART_SCALE

MONEY = "decimal(18,2)"


def money(value: Column) -> Column:
    return value.cast(MONEY)


def in_chart_units(amount: Column, scale: float = CHART_SCALE) -> Column:
    """Scale an amount for display."""
    return amount.cast("double") / F.lit(float(scale))
