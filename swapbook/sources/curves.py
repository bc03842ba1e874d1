"""Reference data files: interest-rate curves and the FX seed.

Every line is typed once and gets a ``reject_reason`` (NULL if good). One bad line is set aside with its text and
does not keep the others from being used.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swapbook.functions.dates import parse_slash_date
from swapbook.functions.keys import strip_non_ascii
from swapbook.schemas import CURRENCIES, MAX_CURVE_DAYS, TENORS
from swapbook.sources.messages import _amount, _first

_MALFORMED = "_malformed"


def curve_paths(root: str, terms: Iterable[str] = tuple(t[0] for t in TENORS)) -> list[str]:
    """The curve files of an input folder, one per term."""
    return [f"{root}/ir_data/ir_{term}.txt" for term in terms]


def _fields(spark: SparkSession, path: str | list[str], names: tuple[str, ...], header: bool, stream: bool = False) -> DataFrame:
    """Tab-separated text columns without what is not ASCII, and ``line``: the text of the whole line.

    A line with more or fewer fields than there are names has its text in ``_malformed`` too.
    """
    reader = spark.readStream if stream else spark.read
    layout = ", ".join(f"{name} STRING" for name in (*names, _MALFORMED))
    raw = (
        reader.schema(layout)
        # all fields are read whatever is asked for, else a line's number of fields would not be looked at
        .options(sep="\t", quote="", header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=_MALFORMED, columnPruning=False)
        .csv(path)
    )
    whole = F.concat_ws("\t", *[F.coalesce(name, F.lit("")) for name in names])
    cleaned = [F.trim(strip_non_ascii(F.col(name))).alias(name) for name in names]
    return raw.select(*cleaned, _MALFORMED, F.coalesce(_MALFORMED, whole).alias("line"))


def _set_aside(problems: list[tuple[Column, str]]) -> Column:
    return _first([(F.col(_MALFORMED).isNotNull(), "wrong number of fields"), *problems]).alias("reject_reason")


def judged_curve(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Tab-separated ``days, index, term, rate`` files with a header line: every line typed, with ``reject_reason``."""
    text = _fields(spark, paths, ("days", "index_name", "term", "rate"), header=True)
    typed = text.withColumns({"days": F.col("days").try_cast("int"), "rate": _amount(F.col("rate"))})
    problems = [
        (F.col("days").isNull() | (F.col("days") < 0), "bad days"),
        (F.col("days") > MAX_CURVE_DAYS, "beyond reach"),
        (F.coalesce("index_name", F.lit("")) == "", "no index"),
        (~F.col("term").isin(*[t[0] for t in TENORS]), "unknown term"),
        (F.col("rate").isNull(), "bad rate"),
    ]
    return typed.select("days", "index_name", "term", "rate", _set_aside(problems), "line")


def read_curve(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The usable lines of curve files as one table; the others are in ``rejected(judged_curve(..))``."""
    return accepted(judged_curve(spark, paths))


def judged_fx_seed(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Tab-separated ``date, base, price, rate`` files without header: every line as a tick, with ``reject_reason``."""
    text = _fields(spark, path, ("date", "base", "price", "rate"), header=False, stream=stream)
    typed = text.withColumns({"date": parse_slash_date(F.col("date")), "rate": _amount(F.col("rate"))})
    problems = [
        (F.col("date").isNull(), "bad date"),
        (~F.col("price").isin(*CURRENCIES), "unknown currency"),
        (F.col("rate").isNull() | (F.col("rate") == 0), "bad rate"),
    ]
    seq = F.lit(-1).cast("bigint").alias("seq")
    return typed.select(seq, "date", "base", "price", "rate", _set_aside(problems), "line")


def read_fx_seed(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """The usable lines of the seed as ticks before all others.

    With ``stream`` the folder is read once by a stream, to start its rate state with.
    """
    return accepted(judged_fx_seed(spark, path, stream))


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reject_reason").isNull()).drop("reject_reason", "line")


def rejected(judged: DataFrame) -> DataFrame:
    """The lines set aside and why."""
    return judged.filter(F.col("reject_reason").isNotNull()).select("line", "reject_reason")
