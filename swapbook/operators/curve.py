"""Interest-rate curves: discount factors, par rates and the per-term lookup arrays.

A remaining-leg sum runs over offsets ``d, d+n, d+2n, ...`` (n = days of a period), so a running
sum along that stride, kept per curve day, turns every such sum into one array lookup. The
running sums are computed once per curve; pricing a trade then costs a handful of lookups
whatever its number of periods, all inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from swapbook.schemas import DAYS_PER_YEAR, INDEX_FLOAT, MAX_CURVE_DAYS, tenors

WHOLE_YEARS = "whole_years"
ACT_360 = "act_360"
DAY_COUNTS = (WHOLE_YEARS, ACT_360)


def year_fraction(days: Column, day_count: str = WHOLE_YEARS) -> Column:
    """Years of ``days``: whole years only (the default), or days / 360."""
    if day_count == WHOLE_YEARS:
        return F.floor(days / F.lit(DAYS_PER_YEAR)).cast("double")
    if day_count == ACT_360:
        return days / F.lit(float(DAYS_PER_YEAR))
    raise ValueError(f"day_count must be one of {DAY_COUNTS}, not {day_count!r}")


def discount_factor(rate: Column, days: Column, day_count: str = WHOLE_YEARS) -> Column:
    """Simple-interest discount factor 1 / (1 + rate * years)."""
    return F.lit(1.0) / (F.lit(1.0) + rate * year_fraction(days, day_count))


def curve_points(curve: DataFrame, day_count: str = WHOLE_YEARS) -> DataFrame:
    """One row per (term, days) of the floating index, with its discount factor.

    A (term, days) given several times counts once, with its highest rate.
    """
    in_reach = F.when(F.col("days") <= MAX_CURVE_DAYS, F.col("days")).otherwise(
        F.raise_error(F.lit(f"curve reaches past {MAX_CURVE_DAYS} days")).cast("int")
    )
    return (
        curve.filter((F.col("index_name") == INDEX_FLOAT) & (F.col("days") >= 0))
        .select("term", in_reach.alias("days"), "rate")
        .groupBy("term", "days")
        .agg(F.max("rate").alias("rate"))
        .withColumn("year_fraction", year_fraction(F.col("days"), day_count))
        .withColumn("discount_factor", discount_factor(F.col("rate"), F.col("days"), day_count))
    )


def par_rate_grid(curve: DataFrame, day_count: str = WHOLE_YEARS) -> DataFrame:
    """Par rate per (term, number of periods); it depends on nothing else.

    Defined as far as the curve has every period end; the window is bounded by the curve.
    """
    points = curve_points(curve, day_count).join(F.broadcast(tenors(curve.sparkSession)), "term")
    so_far = W.partitionBy("term").orderBy("periods").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        points.filter((F.col("days") > 0) & (F.col("days") % F.col("n") == 0))
        .withColumn("periods", (F.col("days") / F.col("n")).cast("int"))
        .withColumn("df_sum", F.sum("discount_factor").over(so_far))
        .withColumn("known", F.count(F.lit(1)).over(so_far))
        .filter(F.col("known") == F.col("periods"))
        .withColumn("par_rate", (F.lit(1.0) - F.col("discount_factor")) / F.col("df_sum"))
        .select("term", "n", "periods", "discount_factor", "df_sum", "par_rate")
    )


def curve_arrays(curve: DataFrame, day_count: str = WHOLE_YEARS) -> DataFrame:
    """One row per tenor: (term, months, n, rates, dfs, sums, gaps, pars), arrays indexed by day.

    ``rates[d]`` and ``dfs[d]`` are NULL where the curve has no day ``d``. ``sums[d]`` adds the
    known discount factors of d, d-n, d-2n, ... above zero and ``gaps[d]`` counts the unknown ones.
    ``pars[d]`` is the par rate of a trade with d/n periods. Three rows of at most MAX_CURVE_DAYS entries: safe to broadcast.
    """
    terms = tenors(curve.sparkSession)
    points = curve_points(curve, day_count)
    reach = points.groupBy("term").agg(F.max("days").alias("reach"))
    stride = (
        W.partitionBy("term", (F.col("days") % F.col("n")))
        .orderBy("days")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    after_start = F.col("days") > 0
    days = (
        reach.join(F.broadcast(terms), "term")
        .select("term", "n", F.explode(F.sequence(F.lit(0), F.col("reach"))).alias("days"))
        .join(points, ["term", "days"], "left")
        .withColumn(
            "df_sum",
            F.sum(F.when(after_start, F.coalesce("discount_factor", F.lit(0.0))).otherwise(F.lit(0.0))).over(stride),
        )
        .withColumn("gap", F.sum(F.when(after_start & F.col("rate").isNull(), 1).otherwise(0)).over(stride))
    )
    days = days.withColumn(
        "par_rate",
        F.when(
            after_start & (F.col("days") % F.col("n") == 0) & (F.col("gap") == 0),
            (F.lit(1.0) - F.col("discount_factor")) / F.col("df_sum"),
        ),
    )
    packed = days.groupBy("term").agg(
        F.sort_array(
            F.collect_list(F.struct("days", "rate", "discount_factor", "df_sum", "gap", "par_rate"))
        ).alias("p")
    )
    arrays = packed.select(
        "term",
        F.col("p.rate").alias("rates"),
        F.col("p.discount_factor").alias("dfs"),
        F.col("p.df_sum").alias("sums"),
        F.col("p.gap").cast("array<int>").alias("gaps"),
        F.col("p.par_rate").alias("pars"),
    )
    return terms.join(arrays, "term", "left")
