"""Kafka topics as streaming sources. Needs Spark's Kafka package on the cluster's class path."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swapbook.schemas import CURRENCIES, TOPIC_RAW
from swapbook.sources.arrival import place


def topics(prefix: str = TOPIC_RAW, currencies: Iterable[str] = CURRENCIES) -> list[str]:
    """The topic of each currency."""
    return [f"{prefix}_{ccy}" for ccy in currencies]


def source_options(
    servers: str,
    prefix: str = TOPIC_RAW,
    currencies: Iterable[str] | None = CURRENCIES,
    max_per_trigger: int | None = None,
    starting: str = "earliest",
) -> dict[str, str]:
    """Options of the source: a topic list, or the topic pattern when currencies may be added.

    ``max_per_trigger`` bounds a micro-batch, which is the rate control of the stream.
    """
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": starting}
    if currencies is None:
        options["subscribePattern"] = f"{prefix}_[A-Z]{{3}}"
    else:
        options["subscribe"] = ",".join(topics(prefix, currencies))
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def message_values(records: DataFrame) -> DataFrame:
    """Message text with its time and place.

    ``seq`` is the broker's clock in microseconds and ``place`` tells messages of one time apart, so topics and
    partitions have one order, see ``arrival``. Topic, partition and offset stay, for a replay.
    """
    return records.select(
        F.col("value").cast("string").alias("value"),
        F.unix_micros("timestamp").alias("seq"),
        place().alias("place"),
        F.unix_micros("timestamp").alias("arrived"),
        "topic",
        "partition",
        "offset",
    )


def read_messages(spark: SparkSession, servers: str, **options) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**source_options(servers, **options))
    return message_values(reader.load())
