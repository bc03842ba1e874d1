"""The training-data pipeline: rules, line dedup, near-duplicates, mixing and encoding, each stage on what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swapbook.llm import bpe, line_dedup, mixing, near_dup, quality
from swapbook.llm.queries import tokenizer
from swapbook.session import work_dir

#: The verdicts of the rules, the near-duplicate search and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the outlier test of their language and source."""
    return quality.accepted(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the boilerplate lines of their source, taken as the site; lengths follow."""
    cleaned = line_dedup.drop_boilerplate(docs, host_col="source")
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cleaned


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return near_dup.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequence: a document as often as the mix takes it."""
    return mixing.curriculum(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of ids and decoded text per document of the sequence."""
    return bpe.digests(docs, tokenizer(spark))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_dup_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one's result is written as Parquet and read as the next one's input."""
    folder = work_dir(spark, "corpus")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
