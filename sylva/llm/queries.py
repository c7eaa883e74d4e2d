"""The queries of this subpackage, as the entry module registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, decontam, divergence, exact_dedup, licences, mixing, pieces, quality, secrets, simhash, suffix_dedup, token_store, topk
from .common import documents, tokenizer_path


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(documents(spark, sf_dir))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_sample(documents(spark, sf_dir))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.train(docs, quality.labels_of(spark, sf_dir)))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.write(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json")).read()


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(documents(spark, sf_dir))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 20 == 0)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(documents(spark, sf_dir))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_mixing,
        op3_licences,
        op4_quality,
        op5_token_store,
        op6_pieces,
        op7_secrets,
        op8_simhash,
        op9_topk,
        op10_suffix_dedup,
        op11_centroids,
        op12_divergence,
        op13_decontamination,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.ORACLE_SQL,
    "op9_topk": topk.ORACLE_SQL,
    "op10_suffix_dedup": suffix_dedup.ORACLE_SQL,
    "op11_centroids": centroids.ORACLE_SQL,
    "op12_divergence": divergence.ORACLE_SQL,
    "op13_decontamination": decontam.ORACLE_SQL,
}
