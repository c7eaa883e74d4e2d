"""Precomputed SHAP tables.

For an oblivious tree, a row's SHAP contribution from that tree depends only
on the leaf it reaches. So the table ``(model, tree, leaf, feature) -> phi[K]``
is computed once per model and explanation becomes a leaf walk plus a join.

* E1 zero leaf weights count as 1e-6 (before any roll-up);
* E2 ``node_cover``: cover of every node, a group-by on the leaf's low bits;
* E3 ``tree_expected``: cover-weighted mean of each tree's leaf values;
* E5/E6 ``shap_table``: trees are independent, so each is one row (splits, leaf
  values, and the covers of E2) that a pandas function solves. It integrates the
  path-dependent expectation over all feature subsets as a polynomial; cost
  per tree is about 4^depth * u * u/2 for u distinct features, at any depth;
* E7 only features the tree splits on get rows;
* E8 ``bias_row``: sum of tree expectations * scale + bias;
* E9 ``quantize_float16``: optional rounding through IEEE binary16.
"""

from __future__ import annotations

from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.model_docs import ModelTables, pow2

ZERO_WEIGHT = 1e-6


def repaired_leaves(tables: ModelTables) -> DataFrame:
    """Leaves with zero weights replaced by 1e-6."""
    return tables.leaves.withColumn(
        "weight", F.when(F.col("weight") == 0, F.lit(ZERO_WEIGHT)).otherwise(F.col("weight"))
    )


def tree_depths(tables: ModelTables) -> DataFrame:
    return tables.splits.groupBy("model_id", "tree").agg(F.count("*").cast("int").alias("depth"))


def node_cover(tables: ModelTables) -> DataFrame:
    """(model_id, tree, level, node, cover) for levels 0..depth."""
    lv = repaired_leaves(tables).join(tree_depths(tables), ["model_id", "tree"])
    return (
        lv.select("model_id", "tree", "leaf", "weight", F.explode(F.sequence(F.lit(0), F.col("depth"))).alias("level"))
        .select(
            "model_id",
            "tree",
            "level",
            F.col("leaf").bitwiseAND(pow2(F.col("level")) - 1).alias("node"),
            "weight",
        )
        .groupBy("model_id", "tree", "level", "node")
        .agg(F.sum("weight").alias("cover"))
    )


def tree_expected(tables: ModelTables) -> DataFrame:
    """(model_id, tree, class_idx, expected)."""
    return (
        repaired_leaves(tables)
        .select("model_id", "tree", "weight", F.posexplode("values").alias("class_idx", "v"))
        .groupBy("model_id", "tree", "class_idx")
        .agg((F.sum(F.col("v") * F.col("weight")) / F.sum("weight")).alias("expected"))
        .withColumn("class_idx", F.col("class_idx").cast("int"))
    )


def bias_row(tables: ModelTables) -> DataFrame:
    """(model_id, class_idx, bias) = sum of tree expectations * scale + bias[k]."""
    sums = tree_expected(tables).groupBy("model_id", "class_idx").agg(F.sum("expected").alias("s"))
    return sums.join(F.broadcast(tables.models.select("model_id", "scale", "bias")), "model_id").select(
        "model_id",
        "class_idx",
        (F.col("s") * F.col("scale") + F.element_at("bias", F.col("class_idx") + 1)).alias("bias"),
    )


#: (target leaf, leaf) pairs held at once while a tree is solved.
PAIR_BUDGET = 1 << 18


def leaf_shap(feats: np.ndarray, values: np.ndarray, covers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per-leaf SHAP values of one oblivious tree (unscaled), for any depth.

    feats (D,) feature per level, values (L, K), covers: per level 0..D the
    cover of its 2^level nodes (``node_cover``).
    Returns (features used, sorted; phi of shape (L, U, K)).

    For a target leaf h, a leaf l counts with ``prod(agree_j for j in S) *
    prod(share_j for j not in S)`` towards E[f | x_S]: ``agree_j`` says that l
    lies on h's side at all levels of feature j, ``share_j`` is the cover that
    l's side takes at those levels. Shapley's subset weights are the Beta
    integral of t^|S| (1-t)^(U-1-|S|), so the sum over all subsets is the
    integral over t of a polynomial of degree U-1, which Gauss-Legendre
    quadrature with ceil(U/2) points gives exactly.
    """
    depth = len(feats)
    n_leaves, k = values.shape
    leaves = np.arange(n_leaves)
    used, slot = np.unique(feats, return_inverse=True)
    u = len(used)
    share = np.ones((u, n_leaves))
    for d in range(depth):
        share[slot[d]] *= covers[d + 1][leaves & ((2 << d) - 1)] / covers[d][leaves & ((1 << d) - 1)]
    levels = [sum(1 << d for d in range(depth) if slot[d] == j) for j in range(u)]
    nodes, node_weights = np.polynomial.legendre.leggauss(max(1, -(-u // 2)))
    nodes, node_weights = (nodes + 1) / 2, node_weights / 2
    phi = np.zeros((n_leaves, u, k))
    step = max(1, PAIR_BUDGET // n_leaves)
    for first in range(0, n_leaves, step):
        apart = leaves[first : first + step, None] ^ leaves[None, :]
        agree = np.stack([(apart & m) == 0 for m in levels]).astype(np.float64) if u else np.zeros((0, *apart.shape))
        others = np.zeros_like(agree)  # integral of the product over the other features
        for t, w in zip(nodes, node_weights):
            parts = share[:, None, :] * (1 - t) + agree * t  # shares are positive, so these are too
            others += w * parts.prod(axis=0) / parts
        for j in range(u):
            phi[first : first + step, j] = ((agree[j] - share[j][None, :]) * others[j]) @ values
    return used, phi


SHAP_SCHEMA = T.StructType(
    [
        T.StructField("model_id", T.StringType()),
        T.StructField("tree", T.IntegerType()),
        T.StructField("leaf", T.IntegerType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("phi", T.ArrayType(T.DoubleType())),
    ]
)


def _solve_trees(batches):
    """One row per tree -> its SHAP rows."""
    for pdf in batches:
        for r in pdf.itertuples():
            feats = np.asarray(r.feats, dtype=np.int64)
            values = np.vstack([np.asarray(v, dtype=np.float64) for v in r.leaf_values])
            cover = np.asarray(r.covers, dtype=np.float64)  # level after level
            covers = [cover[(1 << d) - 1 : (2 << d) - 1] for d in range(len(feats) + 1)]
            used, phi = leaf_shap(feats, values, covers)
            phi = phi * float(r.scale)
            n_leaves, u, _ = phi.shape
            yield pd.DataFrame(
                {
                    "model_id": r.model_id,
                    "tree": int(r.tree),
                    "leaf": np.repeat(np.arange(n_leaves, dtype=np.int32), u),
                    "feature": np.tile(used.astype(np.int32), n_leaves),
                    "phi": list(phi.reshape(n_leaves * u, -1)),
                }
            )


def shap_table(tables: ModelTables) -> DataFrame:
    """(model_id, tree, leaf, feature, phi ARRAY<DOUBLE>) for float-only models.

    Splits, leaf values and the covers of E2 are brought together per tree (a
    row is bounded by 2^depth leaves), and each tree is solved by itself.
    Models with categorical features are left out (T10).
    """
    tree = ["model_id", "tree"]

    def in_order(rows: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
        entries = F.array_sort(F.collect_list(F.struct(*order, value)))
        return rows.groupBy(*tree).agg(F.transform(entries, lambda s: s[value]).alias(name))

    float_only = tables.models.filter(F.col("n_cat") == 0).select("model_id", "scale")
    # Work per tree is large next to its bytes, so the partition count is set
    # explicitly: adaptive execution would otherwise fold the small shuffle
    # into one task.
    spark = tables.models.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    rows = (
        in_order(tables.splits, ["level"], "feature", "feats")
        .join(in_order(tables.leaves, ["leaf"], "values", "leaf_values"), tree)
        .join(in_order(node_cover(tables), ["level", "node"], "cover", "covers"), tree)
        .join(F.broadcast(float_only), "model_id")  # one row per model
        .repartition(n, *tree)
    )
    return rows.select(*tree, "feats", "leaf_values", "covers", "scale").mapInPandas(_solve_trees, SHAP_SCHEMA)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _float16_round(phi: pd.Series) -> pd.Series:
    return pd.Series([np.asarray(v, dtype=np.float64).astype(np.float16).astype(np.float64) for v in phi])


def quantize_float16(shap: DataFrame) -> DataFrame:
    """Round every phi through IEEE binary16, as the compact format stores it."""
    return shap.withColumn("phi", _float16_round(F.col("phi")))
