"""Commit files: what has been written as a whole, on any file system that Spark knows.

A commit is one small JSON file, written beside its place and renamed, so it is there or not. Readers look at committed
parts only, and a writer that finds its commit does nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def put(spark: SparkSession, path: str, content: dict) -> None:
    """Write one commit; a file that is there is replaced."""
    fs, place = _at(spark, path)
    fs.mkdirs(place.getParent())
    beside = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    out.write(bytearray(json.dumps(content).encode() + b"\n"))
    out.close()
    if fs.exists(place):
        fs.delete(place, False)
    if not fs.rename(beside, place):
        raise OSError(f"{path} could not be committed")


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """A number that changes with the files below some paths."""
    found = []
    for path in paths:
        fs, place = _at(spark, path)
        files = fs.listFiles(place, True)
        while files.hasNext():
            status = files.next()
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return uuid.uuid5(uuid.NAMESPACE_URL, repr(sorted(found))).hex
