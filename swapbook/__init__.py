"""Swap book analytics on Spark: pricing, re-pricing on FX ticks, portfolio queries."""

from swapbook.operators.pricing import price

__all__ = ["price"]
