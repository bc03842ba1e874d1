"""One order for messages of several topics and partitions: broker time, then topic, partition and offset.

The broker's time is in milliseconds, so messages of two topics often share one. A stream carries (``seq``, ``place``) and
compares both, see ``place``; a replay of what lies there turns the same order into one number, see ``numbered``, which all
batch operators take as their ``seq``. Either way a message counts before another if, and only if, it is before it here.

Times within a partition do not fall where the topic has the broker's time (``LogAppendTime``); with times of the producer,
the order of a partition is that of its times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bits of a number for the messages of one millisecond; the rest holds times until the year 2248.
BITS = 20


def place() -> Column:
    """(topic, partition, offset) of a message as a text that sorts alike."""
    digits = lambda name, n: F.lpad(F.col(name).cast("string"), n, "0")
    # a space sorts before all that a topic's name may hold, so a name that begins another one stays first
    return F.concat(F.coalesce("topic", F.lit("")), F.lit(" "), digits("partition", 10), digits("offset", 20))


def numbered(records: DataFrame, arrived: str = "arrived") -> DataFrame:
    """``records`` (topic, partition, offset and ``arrived`` in microseconds) with ``seq``, a number in the order of arrival.

    A number is the millisecond and the place within it: the rank among the messages of the millisecond, so the records are
    moved and sorted once. More than 2 ** 20 messages in a millisecond are an error, which bounds what is ranked together.
    A message delivered twice keeps one number; records without topic, partition, offset or time have none, and are last.
    Columns of other names stay as they are.
    """
    place = ("topic", "partition", "offset")
    ms = F.call_function("div", F.col(arrived) - F.pmod(F.col(arrived), F.lit(1000)), F.lit(1000).cast("long"))
    whole = F.col(arrived).isNotNull() & F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull()
    # records without a number are not ranked; a hash deals them to many tasks
    timed = records.drop("seq").withColumn("_ms", F.when(whole, ms))
    spare = F.when(F.col("_ms").isNull(), F.xxhash64(arrived, *place))
    spot = F.dense_rank().over(W.partitionBy("_ms", spare).orderBy(*place)).cast("long") - 1
    fits = F.when(spot < (1 << BITS), spot).otherwise(F.raise_error(F.lit("more messages in a millisecond than numbers")).cast("long"))
    seq = F.when(F.col("_ms").isNotNull(), F.shiftleft("_ms", BITS) + fits)
    return timed.select(*[c for c in records.columns if c != "seq"], seq.alias("seq"))


def width(micros: int) -> int:
    """A width of time windows, given in microseconds, in numbers."""
    return micros // 1000 << BITS


def micros(number: Column) -> Column:
    """The time of a number, in microseconds."""
    return F.shiftright(number, BITS) * 1000
