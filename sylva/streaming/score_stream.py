"""Scoring and explaining streams.

Scoring and explanation are stateless per row, so the dense plans (one
``mapInArrow`` each) apply to a streaming DataFrame unchanged: no watermark,
no state store. ``run_available_now`` drives a file stream to completion with
``trigger(availableNow=True)`` into a Parquet sink with its own checkpoint, so
a restarted job resumes where it stopped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..plans.model import Model
from ..session import checkpoint_dir


def score_stream(stream: DataFrame, model: Model, prediction_type: str = "raw_formula_val", **inputs) -> DataFrame:
    """A streaming DataFrame with the model's prediction appended (dense plan)."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame")
    return model.predict(stream, prediction_type, plan="dense", **inputs)


def explain_stream(stream: DataFrame, model: Model, **inputs) -> DataFrame:
    """A streaming DataFrame with ``phi`` and ``explanation`` appended."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame")
    return model.explain(stream, plan="dense", **inputs)


def run_available_now(stream: DataFrame, spark: SparkSession, name: str = "stream") -> str:
    """Process everything available now into Parquet under the shared checkpoint folder.

    Returns the output folder; read it back with ``spark.read.parquet``.
    """
    base = checkpoint_dir(spark).rstrip("/") + f"/sylva-{name}-{uuid.uuid4().hex}"
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", base + "/_checkpoint")
        .option("path", base + "/out")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return base + "/out"
