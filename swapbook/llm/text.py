"""Words, lines and word windows of a text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space; none for a null text."""
    return F.array_remove(F.split(whole(text), "[\\x20\\x09-\\x0D]+"), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def hashed(items: Column) -> Column:
    return F.transform(items, lambda x: F.xxhash64(x))


def windows(items: Column, length: int) -> Column:
    """A 64-bit hash of each run of ``length`` neighbours. Pass a plain column: it is looked up per element."""
    last = F.size(items) - length
    at = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(items, i + k) for k in range(length)]),
    )
    return F.when(last >= 0, at).otherwise(F.array().cast("array<bigint>"))
