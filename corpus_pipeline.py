"""Documents to training shards: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.decontamination import decontaminate
from millrace.llm.minhash import drop_near_duplicates
from millrace.llm.mixing import mix
from millrace.llm.queries import QUALITY_TARGETS
from millrace.llm.sharding import assign_shards
from millrace.llm.toxicity import drop_toxic
from millrace.queries.base import table
from millrace.session import written


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that a classifier of the labelled ones rejects."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: five-word shingles, 0.8 or more alike."""
    return drop_near_duplicates(docs, shingle_words=5, percent=80)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a test item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), shingle_words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the tokens of the domains match their targets."""
    return mix(docs, table(spark, sf_dir, "labels"), QUALITY_TARGETS, "quality")


def deal_to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's shard and its place there."""
    return assign_shards(docs, shards=24)


STAGES = [
    ("toxicity", remove_toxic),
    ("near duplicates", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("mixing", mix_sources),
    ("sharding", deal_to_shards),
]

# SQL has no classifiers and no iterated fits.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one keeps is written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, "stage")
    return docs
