"""From raw documents to training text: five stages, each written as Parquet and read back by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.llm.decontaminate import clean
from tideline.llm.language_id import accepted, held_out, train
from tideline.llm.lexicon_bpe import encoded
from tideline.llm.near_duplicates import one_of_each
from tideline.llm.secret_scan import without_secrets
from tideline.session import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be told: no letter, or no language with half of the weight."""
    return accepted(docs, train(docs.where(~held_out())))


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of copies and near copies, the one with the least id."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of the benchmark."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in the texts; every document stays."""
    return without_secrets(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add the token ids of each text."""
    return encoded(docs)


STAGES = [
    ("language", language),
    ("duplicates", duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("encoding", encoding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
