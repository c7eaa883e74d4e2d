"""Validation of predictions and explanations (G1-G8), as aggregates.

Each check is a DataFrame so that it runs where the data is; the result is one
row (or one row per model) of counts and maxima.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.model_docs import pow2

PARITY_TOL = 1e-6


def parity_report(a: DataFrame, b: DataFrame, keys: list[str], value: str, tol: float = PARITY_TOL) -> DataFrame:
    """Full outer join on keys (null equal to null), by what becomes of each pair of rows.

    Presence is told by markers, not by values, so a null value is no missing
    row. Two nulls, two NaN and two equal infinities agree; a null or a NaN on
    one side only is counted by itself. ``over_tolerance`` and ``max_abs_diff``
    are about pairs of numbers (an infinity against a number is over).
    """
    x = a.select(*keys, F.col(value).cast("double").alias("__a"), F.lit(True).alias("__in_a"))
    y = b.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(value).cast("double").alias("__b"), F.lit(True).alias("__in_b"))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    j = x.join(y, on, "full_outer")
    both = F.col("__in_a").isNotNull() & F.col("__in_b").isNotNull()
    valued = both & F.col("__a").isNotNull() & F.col("__b").isNotNull()
    numbers = valued & ~F.isnan("__a") & ~F.isnan("__b")
    d = F.when(numbers, F.when(F.col("__a") == F.col("__b"), 0.0).otherwise(F.abs(F.col("__a") - F.col("__b"))))
    return j.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("__in_b").isNull()).alias("only_left"),
        F.count_if(F.col("__in_a").isNull()).alias("only_right"),
        F.count_if(both & (F.col("__a").isNull() != F.col("__b").isNull())).alias("null_on_one_side"),
        F.count_if(valued & (F.isnan("__a") != F.isnan("__b"))).alias("nan_on_one_side"),
        F.count_if(d > tol).alias("over_tolerance"),
        F.coalesce(F.max(d), F.lit(0.0)).alias("max_abs_diff"),
    )


def probabilities_valid(prob: Column, softmax: bool) -> Column:
    """Softmax rows sum to 1 (1e-9); every probability is within [0, 1]."""
    in_range = F.forall(prob, lambda p: (p >= 0) & (p <= 1))
    if not softmax:
        return in_range
    total = F.aggregate(prob, F.lit(0.0), lambda s, p: s + p)
    return in_range & (F.abs(total - 1.0) <= 1e-9)


def max_abs_difference(a: Column, b: Column) -> Column:
    """Largest elementwise |a - b| of two arrays."""
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def contributions_well_formed(contributions: Column, n_features: int) -> Column:
    """Every feature present once, ranked by |phi| non-increasing."""
    n = F.size(contributions)
    ordered = ~F.exists(
        F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
        lambda i: (i < n) & (F.abs(contributions[i]["phi"]) > F.abs(contributions[i - 1]["phi"])),
    )
    distinct = F.size(F.array_distinct(F.transform(contributions, lambda c: c["name"]))) == n_features
    return (n == n_features) & distinct & ordered


def node_visits(leaves: DataFrame, covers: DataFrame, column: str = "leaves") -> DataFrame:
    """E2 against data: (tree, level, node, cover, n_rows) for one model.

    ``leaves`` has the leaf of every tree per row, ``covers`` the model's
    training cover of every node (``treeshap.node_cover``). Rows are counted per
    (tree, leaf) first and rolled up to the nodes from there.
    """
    per_leaf = leaves.select(F.posexplode(column).alias("tree", "leaf")).groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n"))
    depth = covers.groupBy("tree").agg(F.max("level").alias("depth"))
    levels = F.explode(F.sequence(F.lit(0), F.col("depth"))).alias("level")
    nodes = (
        per_leaf.join(F.broadcast(depth), "tree")  # one row per tree
        .select("tree", "leaf", "n", levels)
        .groupBy("tree", "level", F.col("leaf").bitwiseAND(pow2(F.col("level")) - 1).alias("node"))
        .agg(F.sum("n").alias("n_rows"))
    )
    return covers.join(nodes, ["tree", "level", "node"], "left").select(
        "tree", "level", "node", "cover", F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows")
    )


def label_count_coverage(df: DataFrame, label_count: str) -> DataFrame:
    """How many distinct label counts the rows cover."""
    return df.agg(F.countDistinct(label_count).alias("distinct_label_counts"))
