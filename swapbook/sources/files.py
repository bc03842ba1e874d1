"""Files of messages and stored valuations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from swapbook.sources import valuation_table

RAW = "seq BIGINT, value STRING"


def stream_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A folder of JSON lines ``{"seq": .., "value": ".."}`` as a stream of messages."""
    reader = spark.readStream.schema(RAW)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW).json(path)


def read_valuations(spark: SparkSession, path: str) -> DataFrame:
    """Stored valuations, with the columns valuation_day, run_id and batch_id of their place."""
    return valuation_table.read(spark, path)
