"""Intermediate results in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from swapbook.session import checkpointed, work_dir


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once; the copy in ``spark.checkpoint.dir`` outlives a lost executor."""
    return checkpointed(df)


def stored(df: DataFrame) -> DataFrame:
    """The same as a Parquet table, for rows that are read several times and compress well."""
    path = work_dir(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that are worth a task of their own.
ROWS_PER_TASK = 20_000


def gathered(df: DataFrame) -> DataFrame:
    """``df`` kept, in no more partitions than its rows are worth.

    A copy has the partitions of its last shuffle, and each of them, even an empty one, writes files in every shuffle after it.
    """
    done = kept(df)
    return done.coalesce(max(1, -(-done.count() // ROWS_PER_TASK)))


@contextmanager
def bucketed(df: DataFrame, key: str) -> Iterator[DataFrame]:
    """``df`` as a table in the shared folder, in buckets of ``key``: joins on the key do not move its rows."""
    spark = df.sparkSession
    name, n = f"bucketed_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, key).write.bucketBy(n, key).option("path", work_dir(spark, "bucketed")).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        # the name only; the files stay with the other intermediate results
        spark.sql(f"DROP TABLE {name}")
