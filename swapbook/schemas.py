"""Column layouts, enumerations and the tenor dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values of the data model -------------------------------------------------
BASE_CCY = "USD"
CURRENCIES = ("EUR", "JPY", "GBP", "AUD", "CHF", "XAG", "XAU", "NZD")
INDEX_FIXED = "FIXED"
INDEX_FLOAT = "LIBOR"
SIDE_LONG = "LONG"
SIDE_SHORT = "SHORT"
STREAM_SWAP = "swap_stream"
STREAM_FX = "fx_stream"
TENORS = (("3M", 3, 90), ("6M", 6, 180), ("1Y", 12, 360))  # term, months, days
DAYS_PER_YEAR = 360
CHART_SCALE = 100_000_000
TOPIC_RAW = "xccy_swaps"
TOPIC_PRICED = "processed_xccy_swaps"
# -------------------------------------------------------------------------------------

# A curve reaching further than a hundred years is refused with an error. This bounds the
# size of the arrays built from it, and so of what a pricing job broadcasts.
MAX_CURVE_DAYS = 36_600

CURVE = T.StructType(
    [
        T.StructField("days", T.IntegerType()),
        T.StructField("index_name", T.StringType()),
        T.StructField("term", T.StringType()),
        T.StructField("rate", T.DoubleType()),
    ]
)

# Swap and FX messages share a topic, so one all-text struct covers both.
MESSAGE = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "source_stream",
            "id",
            "organization",
            "tradedate",
            "settlementdate",
            "maturitydate",
            "notional",
            "counterparty",
            "longshort",
            "payccy",
            "receiveccy",
            "payindex",
            "receiveindex",
            "frequency",
            "valuationdate",
            "swapvalue",
            "date",
            "base",
            "price",
            "rate",
        )
    ]
)

TRADE_FIELDS = (
    ("id", T.StringType()),
    ("organization", T.StringType()),
    ("tradedate", T.DateType()),
    ("settlementdate", T.DateType()),
    ("maturitydate", T.DateType()),
    ("notional", T.DoubleType()),
    ("counterparty", T.StringType()),
    ("longshort", T.StringType()),
    ("payccy", T.StringType()),
    ("receiveccy", T.StringType()),
    ("payindex", T.StringType()),
    ("receiveindex", T.StringType()),
    ("frequency", T.StringType()),
)
TRADE_COLUMNS = tuple(name for name, _ in TRADE_FIELDS)

# The 16 stored columns of a valuation.
VALUATION = T.StructType(
    [T.StructField(name, kind) for name, kind in TRADE_FIELDS]
    + [
        T.StructField("valuationdate", T.TimestampType()),
        T.StructField("swapvalue", T.DoubleType()),
        T.StructField("source_stream", T.StringType()),
    ]
)
VALUATION_COLUMNS = tuple(VALUATION.fieldNames())

# Identity of a priced contract; with valuationdate it is the key of a stored valuation.
VALUATION_KEY = ("organization", "id", "payccy", "receiveccy")


def tenors(spark: SparkSession) -> DataFrame:
    """The three-row tenor dimension (term, months, n = days of a period)."""
    rows = ", ".join(f"('{term}', {months}, {days})" for term, months, days in TENORS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS tenor(term, months, n)")


def valuation_columns(df: DataFrame) -> DataFrame:
    """Project to the stored valuation layout."""
    if "source_stream" not in df.columns:
        df = df.withColumn("source_stream", F.lit(STREAM_SWAP))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in VALUATION])
