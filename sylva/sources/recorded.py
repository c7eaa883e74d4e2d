"""Recorded predictions (A11, A12): the parity fixtures' file shape.

A recorded file is one JSON object: header fields plus an array ``rows`` of
per-row inputs and outputs. ``read_recorded`` parses it with Spark (schema
inferred from the file, or given) and explodes ``rows`` with their index.
``write_recorded`` writes rows as JSON lines (distributed) with the header
fields repeated as columns, which ``read_recorded(..., lines=True)`` reads back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_recorded(spark: SparkSession, path: str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """Return (header, rows). ``rows`` carries ``row_idx`` and the file path."""
    if lines:
        rows = spark.read.json(path)
        header_cols = [c for c in rows.columns if c.startswith("h_")]
        header = rows.select(*header_cols).distinct()
        return header, rows.drop(*header_cols)
    doc = spark.read.option("multiLine", True).json(path).withColumn("path", F.col("_metadata.file_path"))
    header = doc.drop("rows")
    rows = doc.select("path", F.posexplode("rows").alias("row_idx", "r")).select("path", "row_idx", "r.*")
    return header, rows


def write_recorded(rows: DataFrame, path: str, header: dict | None = None) -> None:
    """Write rows (plus header fields as ``h_<name>`` columns) as JSON lines."""
    out = rows
    for k, v in (header or {}).items():
        out = out.withColumn(f"h_{k}", F.lit(v))
    out.write.mode("overwrite").json(path)
