"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight that is a linear function of training time t in [0, 1]; the integral of its schedule over
the run, times the demand, is the number of words it must give. The documents of a source are laid out on its own
axis of cumulative words in the order of a hash; the inverse of its cumulative demand turns a place on that axis into
the time at which the document is trained on. Sorting by time by range gives the training order.

Targets: the sources share ``share`` times all words by their weights, none gives more than ``passes`` times what it
has, and the excess is shared anew by weight (all at once, since the limits order the sources). A document is taken
in a pass if the middle of its interval lies before its source's target, so a source is off by half a document.

A running sum over a source would put a hot source into one task. It is taken in two levels instead: sums per
(source, slice of the hash range), a running sum over the fixed number of slices, and a running sum within a slice.

Defined cases: a null source is a source of its own and comes last; a null text has size 0, and is taken as nothing;
repeated rows are documents of their own (equal rows are told apart by nothing, so any of them is the one taken); a source without words has the target 0; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swapbook.llm.store import kept
from swapbook.llm.text import n_words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
SLICES = 4096
#: Slope of a source's schedule by the rank of its name, repeating: weight at t is mean * (1 + slope * (2 t - 1)).
SLOPES = (0.8, 0.0, -0.8)


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit("~"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES,
            slopes: tuple[float, ...] = SLOPES) -> DataFrame:
    """Per source key: its size, slope and target. One row per source name, ordered in a small window."""
    totals = sizes.groupBy("_key").agg(F.sum("_size").alias("source_size"), F.first("_source").alias("_name"))
    everything = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(everything.orderBy(F.col("_name").asc_nulls_last())) - 1

    def of(values: tuple) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), rank % len(values))

    # ordered by limit per weight, the sources that reach their limit come first
    order = everything.orderBy(F.col("source_size") / F.col("_weight"), F.col("_name").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    limit = F.col("source_size") * F.lit(passes)
    full = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(passes)
    used = F.coalesce(F.sum("_weight").over(before), F.lit(0))
    # what a unit of weight gets if exactly the sources before this one are at their limit
    unit = (F.sum("source_size").over(everything) * F.lit(share) - full) / (F.sum("_weight").over(everything) - used)
    ranked = totals.withColumns({"_weight": of(weights), "_slope": of(slopes)}).withColumn("_unit", unit)
    ranked = ranked.withColumns({"_row": F.row_number().over(order), "_within": F.col("_unit") * F.col("_weight") <= limit})
    level = F.min(F.when(F.col("_within"), F.struct("_row", "_unit"))).over(everything)["_unit"]
    target = F.least(F.coalesce(level * F.col("_weight"), limit.cast("double")), limit.cast("double"))
    return ranked.select("_key", "source_size", "_slope", target.alias("target"))


def time_of(place: Column, target: Column, slope: Column) -> Column:
    """t at which a source's cumulative demand reaches ``place``: the root of s t^2 + (1 - s) t = place / target."""
    share = F.least(F.greatest(place / target, F.lit(0.0)), F.lit(1.0))
    linear = 1 - slope
    curved = (F.sqrt(linear * linear + 4 * slope * share) - linear) / (2 * slope)
    return F.when(place.isNotNull(), F.when(slope == 0, share).otherwise(curved))


def laid_out(docs: DataFrame, id_col: str, text: str, source: str) -> DataFrame:
    """Size, source key and order of each document; other columns stay."""
    digits = F.substring(F.md5(F.concat(F.lit("curriculum|"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 15)
    return docs.withColumns(
        {
            "_size": n_words(F.col(text)),
            "_source": F.col(source),
            "_key": _key(F.col(source)),
            "_hash": F.conv(digits, 16, 10).cast("long"),
        }
    )


def placed(rows: DataFrame, narrow: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
           passes: int = PASSES, slopes: tuple[float, ...] = SLOPES) -> DataFrame:
    """``rows`` with source_size, target, slope and ``_starts``: where each pass that takes the row begins on its axis.

    ``narrow`` holds the same rows without their texts; the sums come from it.
    """
    slice_no = F.shiftright(F.col("_hash"), 60 - SLICES.bit_length() + 1).cast("int")
    sums = narrow.groupBy("_key", slice_no.alias("_slice")).agg(F.sum("_size").alias("_sum"))
    before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_key", "_slice", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    known = offsets.join(targets(narrow, weights, share, passes, slopes), "_key")
    inside = Window.partitionBy("_key", "_slice").orderBy("_hash", "_size").rowsBetween(Window.unboundedPreceding, -1)
    within = rows.withColumn("_slice", slice_no).withColumn("_within", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    met = within.join(known, ["_key", "_slice"]).withColumn("_place", F.col("_offset") + F.col("_within"))
    starts = F.array(*[F.col("_place") + F.col("source_size") * k for k in range(passes)])
    taken = F.filter(starts, lambda at: (F.col("_size") > 0) & (at + F.col("_size") / 2 < F.col("target")))
    return met.withColumn("_starts", taken).drop("_slice", "_offset", "_within", "_place")


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document, in training order: size, source_size, target, taken (words, repeats counted), ``position``, ``positions``.

    ``positions`` are the times of all passes that take the document, in billionths of the run; ``position`` is the first
    of them, null for a document that is not taken. Rows are sorted by range by position and hash, documents not taken last.
    """
    narrow = kept(laid_out(docs, id_col, text, source).select(id_col, "_size", "_source", "_key", "_hash"))
    rows = placed(narrow, narrow)
    times = F.transform("_starts", lambda at: F.floor(time_of(at, F.col("target"), F.col("_slope")) * F.lit(1e9)).cast("long"))
    timed = rows.select(
        F.col(id_col),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.size("_starts") * F.col("_size")).alias("taken"),
        times.alias("positions"),
        "_hash",
    ).withColumn("position", F.get("positions", F.lit(0)))
    order = (F.col("position").asc_nulls_last(), F.col("_hash"))
    sequence = timed.repartitionByRange(*order).sortWithinPartitions(*order)
    return sequence.select(id_col, "size", "source_size", "target", "taken", "position", "positions")


def curriculum(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The training sequence: each document once per pass that takes it, sorted by time; ``docs``' columns only."""
    own = docs.select(F.struct(*docs.columns).alias("_doc"))
    parts = own.select("_doc", *[F.col(f"_doc.{c}").alias(f"_c{i}") for i, c in enumerate((id_col, text, source))])
    rows = laid_out(parts, "_c0", "_c1", "_c2").drop("_c0", "_c1", "_c2")
    narrow = kept(rows.select("_size", "_source", "_key", "_hash"))
    spots = placed(rows, narrow)
    times = F.transform("_starts", lambda at: time_of(at, F.col("target"), F.col("_slope")))
    timed = spots.select("_doc", "_hash", F.explode(times).alias("_time"))
    return timed.repartitionByRange("_time", "_hash").sortWithinPartitions("_time", "_hash").select("_doc.*")
