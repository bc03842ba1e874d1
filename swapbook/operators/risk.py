"""The three business questions: debt, counterparty risk, exposure to FX moves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swapbook.functions.money import money
from swapbook.operators.pricing import OK, with_fx_part

SHOCKS = (-0.1, -0.01, 0.01, 0.1)


def net_liability(latest: DataFrame) -> DataFrame:
    """What an organization owes: the sum of its trades with a negative value."""
    owed = F.least(money(F.col("swapvalue")), F.lit(0).cast("decimal(18,2)"))
    return latest.groupBy("organization").agg(
        F.coalesce(F.sum(owed), F.lit(0).cast("decimal(28,2)")).alias("owed"),
        F.count(F.when(F.col("swapvalue") < 0, 1)).alias("trades_owing"),
    )


def counterparty_exposure(valued: DataFrame) -> DataFrame:
    """What an organization would lose if a counterparty failed, and the net of all trades."""
    value = money(F.col("swapvalue"))
    return valued.groupBy("organization", "counterparty").agg(
        F.sum(F.greatest(value, F.lit(0).cast("decimal(18,2)"))).alias("exposure"),
        F.sum(value).alias("net"),
        F.count(F.lit(1)).alias("trades"),
    )


def fx_sensitivity(priced: DataFrame, shocks: Sequence[float] = SHOCKS) -> DataFrame:
    """Change in value per (organization, xccy) when every rate against USD moves by a shock.

    ``priced`` is the result of ``price`` with xccy. A leg outside USD is divided by its rate, so
    a move by s multiplies it by 1 / (1 + s), and the change is that leg times (1 / (1 + s) - 1).
    One sum per group therefore serves all shocks: the book is read and aggregated once and is
    never multiplied by the number of shocks.
    """
    sums = (
        with_fx_part(priced.filter(F.col("price_status") == OK))
        .groupBy("organization", "xccy")
        .agg(F.sum(F.col("fx_part").cast("decimal(28,8)")).alias("fx_value"), F.count(F.lit(1)).alias("trades"))
    )
    factors = F.explode(
        F.array(*[F.struct(F.lit(float(s)).alias("shock"), F.lit(1.0 / (1.0 + s) - 1.0).alias("factor")) for s in shocks])
    )
    return sums.select("*", factors.alias("x")).select(
        "organization",
        "xccy",
        F.col("x.shock").alias("shock"),
        "trades",
        (F.col("fx_value").cast("double") * F.col("x.factor")).alias("change"),
    )
