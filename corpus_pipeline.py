"""The corpus pipeline: stages over ``documents``, each written and reread.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame with the columns of ``documents`` (the last one the mixed
corpus, a row for each copy). Null and empty texts go at the first stage, which
knows no language for them; an empty table stays empty; repeated rows are near
copies of each other. n_chars follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewatch.llm import decontam, langid, mixing, paragraphs, setsketch
from pricewatch.llm.settle import settle, table
from pricewatch.llm.ship import ship


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are text of a learned language."""
    ship(spark)
    return langid.known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8)."""
    ship(spark)
    return setsketch.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has."""
    ship(spark)
    return paragraphs.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by benchmark items."""
    ship(spark)
    return decontam.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target takes it."""
    ship(spark)
    return mixing.mix(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing_sources),
]

# Language identification learns a filter, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
