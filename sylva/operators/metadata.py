"""Model metadata as queries over the model tables.

All of these read the small ``models``/``features``/``leaves`` tables; they
are DataFrames so that many models are described by one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.model_docs import ModelTables


def model_summary(tables: ModelTables) -> DataFrame:
    """Counts per model and the one-line description."""
    counts = tables.features.groupBy("model_id").agg(
        F.count_if(F.col("kind") == "float").cast("int").alias("float_features_count"),
        F.count_if(F.col("kind") == "cat").cast("int").alias("cat_features_count"),
    )
    trees = tables.leaves.groupBy("model_id").agg(F.countDistinct("tree").cast("int").alias("tree_count"))
    out = tables.models.select("model_id", F.col("dims").alias("dimensions_count")).join(counts, "model_id", "left").join(
        trees, "model_id", "left"
    )
    out = out.fillna(0, ["float_features_count", "cat_features_count"])
    return out.withColumn(
        "summary",
        F.format_string(
            "trees=%d floats=%d cats=%d dim=%d",
            "tree_count",
            "float_features_count",
            "cat_features_count",
            "dimensions_count",
        ),
    )


def feature_listing(tables: ModelTables) -> DataFrame:
    """Float, cat and all names in order, and whether names are real."""
    f = tables.features

    def ordered(kind: str | None, order: str) -> Column:
        cond = F.lit(True) if kind is None else (F.col("kind") == kind)
        entries = F.collect_list(F.when(cond, F.struct(F.col(order).alias("o"), F.col("name").alias("n"))))
        return F.transform(F.array_sort(entries), lambda s: s["n"])

    return f.groupBy("model_id").agg(
        ordered("float", "kind_index").alias("float_names"),
        ordered("cat", "kind_index").alias("cat_names"),
        ordered(None, "position").alias("all_names"),
        (~F.bool_or(F.col("name").rlike(r"^[0-9]+$"))).alias("named"),
    )


def metadata_value(metadata: Column, key: str) -> Column:
    """The value for ``key``; absent and empty both give null."""
    return F.nullif(F.try_element_at(metadata, F.lit(key)), F.lit(""))


def metadata_present(metadata: Column, key: str) -> Column:
    """Whether ``key`` is present (even with an empty value)."""
    return F.map_contains_key(metadata, F.lit(key))


def class_names(metadata: Column) -> Column:
    """Labels parsed from ``class_params``; null when absent.

    A malformed ``class_params`` fails the query with a message.
    """
    raw = F.try_element_at(metadata, F.lit("class_params"))
    names = F.from_json(F.get_json_object(raw, "$.class_names"), "array<string>")
    return F.when(raw.isNull(), F.lit(None).cast("array<string>")).when(
        names.isNull(), F.raise_error(F.concat(F.lit("malformed class_params metadata: "), raw)).cast("array<string>")
    ).otherwise(names)


def labels_or_indexes(names: Column, k: Column) -> Column:
    """The class names when there is one per dimension, else 0..K-1 as text."""
    idx = F.transform(F.sequence(F.lit(0), k - 1), lambda i: i.cast("string"))
    return F.when(F.coalesce(F.size(names), F.lit(-1)) == k, names).otherwise(idx)


def metadata_lookup(tables: ModelTables, keys: list[str]) -> DataFrame:
    """B9-B12 for every model: one column per key plus labels."""
    m = tables.models
    cols = [metadata_value(F.col("metadata"), k).alias(k) for k in keys]
    cols += [metadata_present(F.col("metadata"), k).alias(f"has_{k}") for k in keys]
    return m.select(
        "model_id",
        *cols,
        class_names(F.col("metadata")).alias("class_names"),
        "label_kind",
        labels_or_indexes(F.col("class_names"), F.col("dims")).alias("labels"),
    )
