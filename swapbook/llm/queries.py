"""Named queries of this folder: (spark, table folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swapbook.llm import (
    ann,
    bpe,
    chat,
    hard_negatives,
    lang_id,
    line_dedup,
    mixing,
    near_dup,
    pii,
    quality,
    ship,
    token_files,
    toxicity,
    whitening,
)
from swapbook.llm.oracle import SQL  # noqa: F401  the SQL of these queries
from swapbook.session import work_dir

#: The tokenizer, one of the public ones on this machine; a session may name another file.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Columns of ``labels`` in the order of the chain: low quality first, since junk is easier to tell.
CATEGORIES = ["low_quality", "toxic"]

# These run in Python workers; they travel with the job, so executors need not have the package installed.
for module in (ann, bpe, chat, hard_negatives, lang_id, near_dup, token_files, toxicity, whitening):
    ship.by_value(module.__name__)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        "page_id", line_dedup.host(F.col("url")).alias("host"), line_dedup.page_text(F.col("html")).alias("text")
    )
    return line_dedup.drop_boilerplate(pages, counts=True)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("positions")


def tokenizer(spark: SparkSession) -> str:
    return spark.conf.get("swapbook.tokenizer", TOKENIZER)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer(spark))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    return toxicity.score(docs, toxicity.learn(docs, labels, CATEGORIES), CATEGORIES)


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get("swapbook.pii.key", "key of the test tables")
    return pii.replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), key)


def transcripts(conversations: DataFrame) -> DataFrame:
    """Raw transcripts: the speaker is named in one of three styles before most turns, and in a quarter not at all."""
    style = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4))
    named = F.lit("")
    for role, names in chat.MARKERS.items():
        choice = F.when(style < 3, F.concat(F.initcap(F.get(F.array(*[F.lit(n) for n in names]), style.cast("int"))), F.lit(": ")))
        named = F.when(F.col("role") == role, F.coalesce(choice, F.lit(""))).otherwise(named)
    return conversations.select("conv_id", "turn", F.concat(named, F.coalesce("text", F.lit(""))).alias("text"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns that are recovered from raw transcripts of ``conversations``; roles serve as labels of the sample only."""
    rows = table(spark, sf_dir, "conversations")
    raw = transcripts(rows)
    parsed = chat.parse(chat.lines_of(raw), chat.learn(raw, rows))
    return chat.rendered(parsed).withColumnRenamed("conv", "conv_id")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("id") % 100 == 0)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written into the shared folder, then read back."""
    folder = work_dir(spark, "tokens")
    token_files.write(table(spark, sf_dir, "documents"), folder, tokenizer(spark))
    return token_files.read(spark, folder)


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_line_dedup": op2_line_dedup,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_language_id": op5_language_id,
    "op6_mixing": op6_mixing,
    "op7_bpe": op7_bpe,
    "op8_toxicity": op8_toxicity,
    "op9_pii_surrogates": op9_pii_surrogates,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_whitening": op12_whitening,
    "op13_token_files": op13_token_files,
}
