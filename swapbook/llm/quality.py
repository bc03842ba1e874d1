"""Quality rules: plain counts of a text, and a robust outlier test of its statistics.

The counts of a document become a vector of transformed statistics. For each language and source the
minimum-covariance-determinant estimate of centre and scatter is searched for, and a document whose vector lies
too far from the centre (Mahalanobis distance) is rejected.

The search is a chain of aggregates. A C-step needs the rows nearest to the present centre: distances are put into
bins that are a few per cent wide, counts and moments are summed per group and bin, and the bins are filled up from
the nearest until the wanted share of the group is reached; a bin counts whole, so rows at equal distance stay
together. Statistics are whole thousandths, so sums are exact and do not depend on the order of partitions. Two
starts are carried along (scales of the single statistics; and their correlations after clipping); the one whose
scatter has the smaller determinant is kept, then re-weighted once.

Defined cases: a null text has no words and fails the base rules; null language or source are values of their own;
a group of fewer than ``least_rows`` rows past the base rules goes by the estimate of the small groups of its language, or of
all that is left of the table where those are too few as well (``pools``), and only a rest below ``least_rows`` rejects nothing;
repeated rows count as often as they occur; other columns pass through ``assess`` and ``accepted`` untouched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swapbook.llm.store import kept
from swapbook.llm.text import SPACES, hashed, whole, windows, without, words

SYMBOLS = "#*$%&|<>"
RUN = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATS = ("q_words", "q_word_length", "q_symbols", "q_dup_lines", "q_repeats")
P = len(STATS)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


@dataclass(frozen=True)
class Rules:
    min_words: int = 20
    max_repeat_percent: int = 30
    #: share of a group's rows that a C-step keeps
    core: float = 0.75
    steps: int = 4
    least_rows: int = 50
    #: chance of a regular row to lie beyond the limit
    tail: float = 1e-8
    #: least standard deviations in thousandths, since most texts have no symbol or repetition at all
    floors: tuple[int, ...] = field(default=(600, 45, 300, 150, 120))


def chi_square_cdf(x: float, p: int) -> float:
    """P(chi-square with ``p`` degrees of freedom <= x), by the series of the incomplete gamma function."""
    a, h = p / 2, x / 2
    term = total = math.exp(-h + a * math.log(h) - math.lgamma(a + 1)) if h > 0 else 0.0
    n = a
    while term > total * 1e-17 and total:
        n += 1
        term *= h / n
        total += term
    return total


def chi_square_limit(share: float, p: int) -> float:
    low, high = 0.0, 500.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, p) < share else (low, middle)
    return high


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five counts, the number of lines and ``base_failed``'s inputs as columns of type long."""
    body = whole(F.col(text))
    lines = F.filter(F.split(body, "\n"), lambda x: without(x, SPACES) != "")
    found = docs.withColumns(
        {
            "_lines": lines,
            "_words": words(F.col(text)),
            "word_chars": F.length(without(body, SPACES)).cast("long"),
            "n_symbols": (F.length(body) - F.length(without(body, SYMBOLS))).cast("long"),
        }
    )
    found = found.withColumns(
        {
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_words": F.size("_words").cast("long"),
            "_hashes": hashed(F.col("_words")),
        }
    ).drop("_lines", "_words")
    found = found.withColumn("_runs", windows(F.col("_hashes"), RUN)).drop("_hashes")
    # only a text with a repeated run is looked at closer
    repeated = F.size(F.array_distinct("_runs")) < F.size("_runs")
    located = F.sort_array(F.transform("_runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = found.withColumn("_located", F.when(repeated, located)).drop("_runs")

    def twice(x: Column, i: Column) -> Column:
        before, after = F.get("_located", i - 1)["h"], F.get("_located", i + 1)["h"]
        return x["h"].eqNullSafe(before) | x["h"].eqNullSafe(after)

    starts = F.array_sort(F.transform(F.filter("_located", twice), lambda x: x["i"]))
    found = found.withColumn("_starts", starts).drop("_located")
    covered = F.transform("_starts", lambda s, i: F.least(F.lit(RUN), F.coalesce(F.get("_starts", i + 1) - s, F.lit(RUN))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return found.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("_starts")


def base_failed(rules: Rules) -> Column:
    return (F.col("n_words") < rules.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent
    )


def statistics() -> dict[str, Column]:
    """The vector in whole thousandths; logarithms keep every entry below some tens of thousands."""

    def thousandths(x: Column) -> Column:
        return F.round(x * 1000).cast("long")

    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    return {
        "q_words": thousandths(F.log1p(F.col("n_words"))),
        "q_word_length": thousandths(F.log1p(F.col("word_chars") / n)),
        "q_symbols": thousandths(F.log1p(F.col("n_symbols") * 100 / n)),
        "q_dup_lines": thousandths(F.col("n_dup_lines") / lines),
        "q_repeats": thousandths(F.col("n_repeat_words") / n),
    }


def moments(columns: list[Column]) -> list[Column]:
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(columns)]
    products = [F.sum(columns[i] * columns[j]).alias(f"s{i}_{j}") for i, j in PAIRS]
    return [F.count(F.lit(1)).alias("n"), *sums, *products]


def factored(sums: DataFrame, keys: list[str], floors: tuple[int, ...], scale: float = 1.0) -> DataFrame:
    """Centre ``m<i>``, inverse Cholesky factor ``w<i>_<j>`` and log determinant from moments per key."""
    out = sums.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in range(P)})
    covariance = {}
    for i, j in PAIRS:
        value = (F.col(f"s{i}_{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")) * F.lit(scale)
        covariance[f"c{i}_{j}"] = value + F.lit(float(floors[i] ** 2)) if i == j else value
    return inverted(out.withColumns(covariance), keys)


def inverted(out: DataFrame, keys: list[str]) -> DataFrame:
    """Row-wise Cholesky factor of ``c<i>_<j>`` and its inverse, one entry after another."""

    def total(terms: list[Column]) -> Column:
        result = F.lit(0.0)
        for term in terms:
            result = result + term
        return result

    for j in range(P):
        rest = F.col(f"c{j}_{j}") - total([F.col(f"l{j}_{k}") * F.col(f"l{j}_{k}") for k in range(j)])
        out = out.withColumn(f"l{j}_{j}", F.sqrt(F.greatest(rest, F.lit(1.0))))
        below = {}
        for i in range(j + 1, P):
            rest = F.col(f"c{i}_{j}") - total([F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)])
            below[f"l{i}_{j}"] = rest / F.col(f"l{j}_{j}")
        out = out.withColumns(below) if below else out
    for i in range(P):
        row = {f"w{i}_{i}": 1 / F.col(f"l{i}_{i}")}
        for j in range(i):
            row[f"w{i}_{j}"] = -total([F.col(f"l{i}_{k}") * F.col(f"w{k}_{j}") for k in range(j, i)]) / F.col(f"l{i}_{i}")
        out = out.withColumns(row)
    log_det = total([F.log(F.col(f"l{i}_{i}")) for i in range(P)])
    return out.select(
        *keys, *[f"m{i}" for i in range(P)], *[f"w{i}_{j}" for i, j in PAIRS], log_det.alias("log_det")
    )


def distance() -> Column:
    """Squared Mahalanobis distance of a row to the centre that was joined to it."""
    total = F.lit(0.0)
    for i in range(P):
        y = F.lit(0.0)
        for j in range(i + 1):
            y = y + F.col(f"w{i}_{j}") * (F.col(STATS[j]) - F.col(f"m{j}"))
        total = total + y * y
    return total


def with_group(df: DataFrame, group: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """Null-free copies of the group columns, so that null is a value to join on."""
    keys = {f"g{i}": F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for i, c in enumerate(group)}
    return df.withColumns(keys), list(keys)


def starts(rows: DataFrame, keys: list[str], rules: Rules) -> DataFrame:
    """Two first estimates per group, from quartiles on a grid of 0.02."""
    grid = F.explode(F.array(*[F.struct(F.lit(i).alias("d"), (F.floor(F.col(c) / 20) * 20).alias("v")) for i, c in enumerate(STATS)]))
    counted = rows.select(*keys, grid.alias("x")).groupBy(*keys, "x.d", "x.v").count()
    ordered = Window.partitionBy(*keys, "d").orderBy("v")
    whole_group = Window.partitionBy(*keys, "d")
    counted = counted.withColumns({"upto": F.sum("count").over(ordered), "of": F.sum("count").over(whole_group)})

    def quartile(share: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.col("of") * share, F.col("v")))

    quartiles = counted.groupBy(*keys, "d").agg(*[quartile(s).alias(f"v{k}") for k, s in enumerate((0.25, 0.5, 0.75))])
    spread = F.greatest((F.col("v2") - F.col("v0")) / 1.349, F.lit(20.0))
    picked = []
    for i in range(P):
        at = F.col("d") == i
        picked += [F.max(F.when(at, F.col("v1"))).alias(f"med{i}"), F.max(F.when(at, spread)).alias(f"mad{i}")]
    middle = quartiles.groupBy(*keys).agg(*picked)
    floors = rules.floors
    diagonal = middle.select(*keys, *[F.col(f"med{i}").cast("double").alias(f"m{i}") for i in range(P)], *[
        (F.col(f"mad{i}") * F.col(f"mad{i}") + F.lit(float(floors[i] ** 2)) if i == j else F.lit(0.0)).alias(f"c{i}_{j}")
        for i, j in PAIRS
    ])
    clipped = [
        F.round(F.least(F.greatest(F.col(c), F.col(f"med{i}") - 2 * F.col(f"mad{i}")), F.col(f"med{i}") + 2 * F.col(f"mad{i}"))).cast("long")
        for i, c in enumerate(STATS)
    ]
    near = rows.join(middle, keys).groupBy(*keys).agg(*moments(clipped))
    first = inverted(diagonal, keys).withColumn("start", F.lit(0))
    return first.unionByName(factored(near, keys, floors).withColumn("start", F.lit(1)))


BINS_PER_OCTAVE = 24


def c_step(rows: DataFrame, estimate: DataFrame, keys: list[str], rules: Rules) -> DataFrame:
    """The estimate from the rows that lie nearest to the present one."""
    by = [*keys, "start"]
    bin_no = F.floor(F.log2(distance() + F.lit(1e-6)) * BINS_PER_OCTAVE).cast("int")
    binned = rows.join(estimate, keys).groupBy(*by, bin_no.alias("bin")).agg(*moments([F.col(c) for c in STATS]))
    whole_group = Window.partitionBy(*by)
    filled = binned.withColumns(
        {"_all": F.sum("n").over(whole_group), "_upto": F.sum("n").over(whole_group.orderBy("bin"))}
    ).filter(F.col("_upto") - F.col("n") < F.ceil(F.col("_all") * F.lit(rules.core)))
    sums = ["n", *[f"s{i}" for i in range(P)], *[f"s{i}_{j}" for i, j in PAIRS]]
    core = filled.groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums])
    return factored(core, by, rules.floors, consistency(rules.core))


def consistency(share: float) -> float:
    """Factor that makes the scatter of the nearest ``share`` of normal rows that of all rows."""
    return share / chi_square_cdf(chi_square_limit(share, P), P + 2)


POOL = "*"


def pools(rows: DataFrame, keys: list[str], rules: Rules) -> DataFrame:
    """One row per group: its keys and ``p<i>``, those of the pool that its estimate is taken from.

    A group of ``least_rows`` rows is a pool of its own. Smaller ones of equal keys but the last are one pool; where that is too
    small still, those of equal keys but the last two, and in the end what is left of the whole table. No real key is ``*``.
    """
    found = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).withColumns(
        {"_open": F.col("_n") < rules.least_rows, **{f"p{i}": F.col(k) for i, k in enumerate(keys)}}
    )
    for depth in reversed(range(len(keys))):
        found = found.withColumn("_place", F.struct(F.lit(depth), *keys[:depth]))
        total = found.filter("_open").groupBy("_place").agg(F.sum("_n").alias("_total"))
        found = found.withColumns({f"p{i}": F.when(F.col("_open"), F.lit(POOL)).otherwise(F.col(f"p{i}")) for i in range(depth, len(keys))})
        found = found.join(total, "_place", "left").withColumn("_open", F.col("_open") & (F.col("_total") < rules.least_rows)).drop("_place", "_total")
    return found.filter(~F.col("_open")).drop("_n", "_open")


def estimates(rows: DataFrame, keys: list[str], rules: Rules) -> DataFrame:
    """Centre and scatter per group, from its pool: the better of the starts, re-weighted once."""
    own = kept(pools(rows, keys, rules))
    by = [f"p{i}" for i in range(len(keys))]
    pooled = rows.join(own, keys).drop(*keys)
    found = starts(pooled, by, rules)
    for _ in range(rules.steps):
        found = c_step(pooled, found, by, rules)
    # a lineage of joins over the same rows ends here; one row per pool and start
    found = kept(found)
    fields = F.struct("log_det", "start", *[c for c in found.columns if c not in (*by, "log_det", "start")])
    best = found.groupBy(*by).agg(F.min(fields).alias("b")).select(*by, "b.*").drop("start", "log_det")
    inner = pooled.join(best, by).filter(distance() <= F.lit(chi_square_limit(0.975, P)))
    weighted = inner.groupBy(*by).agg(*moments([F.col(c) for c in STATS]))
    return kept(own.join(factored(weighted, by, rules.floors, consistency(0.975)).drop("log_det"), by).drop(*by))


def verdicts(rows: DataFrame, estimate: DataFrame, keys: list[str], rules: Rules) -> DataFrame:
    """``rows`` with ``distance`` (null without an estimate or after a failed base rule) and ``kept``."""
    far = F.when(~F.col("base_failed"), distance())
    limit = chi_square_limit(1 - rules.tail, P)
    judged = rows.join(estimate, keys, "left").withColumn("distance", far)
    # one condition of both sides: a filter on it stays above the join, and the counts below are not inlined into it
    passed = F.coalesce("distance", F.when(F.col("base_failed"), math.inf).otherwise(0.0)) <= F.lit(limit)
    return judged.withColumn("kept", passed).drop(*[c for c in estimate.columns if c not in keys])


def _measured(docs: DataFrame, text: str, rules: Rules) -> DataFrame:
    return with_counts(docs, text).withColumn("base_failed", base_failed(rules)).withColumns(statistics())


def assess(docs: DataFrame, id_col: str = "doc_id", text: str = "text", group: tuple[str, ...] = ("lang", "source"),
           rules: Rules = Rules()) -> DataFrame:
    """One row per document: its id, the counts, ``base_failed``, ``distance`` and ``kept``."""
    grouped, keys = with_group(docs.select(F.col(id_col), F.col(text), *[c for c in group if c not in (id_col, text)]), group)
    narrow = kept(_measured(grouped, text, rules).select(id_col, *keys, *COUNTS, "base_failed", *STATS))
    estimate = estimates(narrow.filter(~F.col("base_failed")).select(*keys, *STATS), keys, rules)
    return verdicts(narrow, estimate, keys, rules).select(id_col, *COUNTS, "base_failed", "kept", F.round("distance", 3).alias("distance"))


def accepted(docs: DataFrame, text: str = "text", group: tuple[str, ...] = ("lang", "source"),
             rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with their own columns only.

    The statistics are taken twice, for the estimate and for the verdict: that costs less than moving the texts.
    """
    own = docs.select(F.struct(*docs.columns).alias("_doc"))
    parts = own.select("_doc", F.col(f"_doc.{text}").alias("_text"), *[F.col(f"_doc.{c}").alias(f"_k{i}") for i, c in enumerate(group)])
    grouped, keys = with_group(parts, tuple(f"_k{i}" for i in range(len(group))))
    measured = _measured(grouped, "_text", rules).select("_doc", *keys, "base_failed", *STATS)
    # filtered after it is computed: below, the filter would evaluate the counts per element of a text
    narrow = kept(measured.select(*keys, "base_failed", *STATS)).filter(~F.col("base_failed"))
    estimate = estimates(narrow.select(*keys, *STATS), keys, rules)
    return verdicts(measured, estimate, keys, rules).filter("kept").select("_doc.*")
