"""The packaged model documents as tables, one set per Spark session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .fixtures import MODEL_IDS, model_text
from .plans.model import Model
from .sources.model_docs import ModelTables, load_model_texts


def _kept(spark: SparkSession) -> dict:
    """What a session keeps of the packaged models; it goes with the session."""
    if not hasattr(spark, "_sylva_kept"):
        spark._sylva_kept = {}
    return spark._sylva_kept


def kept(spark: SparkSession, name: str, make):
    """``make()``, once per session."""
    held = _kept(spark)
    if name not in held:
        held[name] = make()
    return held[name]


def tables(spark: SparkSession) -> ModelTables:
    kept = _kept(spark)
    if "tables" not in kept:
        kept["tables"] = load_model_texts(spark, {m: model_text(m) for m in MODEL_IDS}).cache()
    return kept["tables"]


def model(spark: SparkSession, model_id: str) -> Model:
    kept = _kept(spark)
    if model_id not in kept:
        kept[model_id] = Model(tables(spark), model_id)
    return kept[model_id]
