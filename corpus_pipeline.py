"""Corpus pipeline: quality, exact dedup, near dedup, mixing, encoding.

Each stage reads what its predecessor kept; ``run`` writes every stage's rows
as Parquet in the shared checkpoint folder and reads them back, so a lost
executor never repeats an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sylva.llm import exact_dedup, mixing, pieces, quality, simhash
from sylva.llm.common import documents, stored, tokenizer_path


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier, trained on the labels, does not reject."""
    return quality.keep_good(docs, quality.train(docs, quality.labels_of(spark, sf_dir)))


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_one(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the source, language and topic targets."""
    return mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids."""
    return pieces.with_ids(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality", classify),
    ("exact_dedup", dedup_exact),
    ("simhash", dedup_near),
    ("mixing", mix),
    ("pieces", encode),
]

#: Learned scores and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last one's rows."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
