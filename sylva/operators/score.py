"""Scoring by joins (D1, D2, D13): the relational plan.

Features are unpivoted to long rows and equi-joined to the ``splits`` table;
the leaf index is ``sum(2^level)`` over true tests; joined to ``leaves`` and
summed per row and class. It is the independent twin of the dense kernel
(``operators/kernel.py``) in parity checks. Model tables are taken in ranges of
trees that fit the broadcast bound, and the ranges' sums are added, so a model
of any size is scored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.model_docs import pow2

# ----------------------------------------------------------------------------
# Relational plan
# ----------------------------------------------------------------------------


# Input kinds in the long form: float feature, category, target statistic.
KIND_FLOAT, KIND_CAT, KIND_STAT = 0, 1, 2


def slot_key(model_idx: Column, kind: Column, idx: Column) -> Column:
    """One BIGINT join key for (model, input kind, index): Spark's fast single-long hash join."""
    return model_idx.cast("long") * F.lit(1 << 34) + kind.cast("long") * F.lit(1 << 32) + idx.cast("long")


def leaf_key(model_idx: Column, tree: Column, leaf: Column, depth: int, start: int = 0) -> Column:
    """One BIGINT key for (model, tree, leaf); trees count from ``start``, leaves are below 2^depth.

    ``check_keys`` makes sure that a range's trees x leaves fit beside the model.
    """
    return model_idx.cast("long") * F.lit(1 << 40) + (tree.cast("long") - F.lit(start)) * F.lit(1 << depth) + leaf.cast("long")


def check_keys(n_models: int, n_trees: int, depth: int) -> None:
    if n_trees << depth > 1 << 40 or n_models > 1 << 23:
        raise ValueError(f"{n_models} models with {n_trees} trees of depth {depth} a range do not fit the leaf key")


def model_index(ids: list[str]) -> Column:
    """model_id -> its position in ``ids`` (a literal map; one entry per model)."""
    return F.element_at(F.create_map(*[x for i, m in enumerate(ids) for x in (F.lit(m), F.lit(i))]), F.col("model_id"))


def _long_inputs(
    model_idx: int, floats: list[Column], cats: list[Column], stats: list[tuple[int, Column]] | None = None
) -> list[Column]:
    """One struct per model input: (slot, model_idx, x, s)."""

    def entry(kind: int, idx: int, x: Column | None, s: Column | None) -> Column:
        return F.struct(
            F.lit((model_idx << 34) + (kind << 32) + idx).cast("long").alias("slot"),
            F.lit(model_idx).alias("model_idx"),
            (x if x is not None else F.lit(None)).cast("float").alias("x"),
            (s if s is not None else F.lit(None)).cast("string").alias("s"),
        )

    out = [entry(KIND_FLOAT, i, c, None) for i, c in enumerate(floats)]
    out += [entry(KIND_CAT, j, None, c) for j, c in enumerate(cats)]
    out += [entry(KIND_STAT, sid, c, None) for sid, c in stats or []]
    return out


# Expanded rows (input rows x split rows per input row) one task should hold
# in its per-(row, tree) aggregate, relative to an input partition.
EXPANSION_PER_TASK = 1024
# Expanded rows one task takes, whatever the size of the input.
EXPANDED_ROWS_PER_TASK = 4_000_000


def partition_by_keys(df: DataFrame, keys: list[str], expansion: int = 1, partitions: int | None = None) -> DataFrame:
    """Hash-partition rows on their key once, before the in-partition expansion.

    The count is explicit, so adaptive execution cannot fold the shuffle into
    a few partitions (size before the expansion says nothing about the work
    after it). By default it is ``spark.sql.shuffle.partitions`` times
    ``ceil(expansion / EXPANSION_PER_TASK)``, where ``expansion`` is the split
    rows each input row turns into (trees x depth summed over models): the
    per-task aggregate then stays about as large as for a 1024-split model.
    Larger inputs get a partition for every ``EXPANDED_ROWS_PER_TASK`` expanded
    rows, so that aggregate does not grow with the input; the rows are counted
    for it. ``partitions`` overrides all this.
    """
    if partitions is None:
        factor = max(1, -(-expansion // EXPANSION_PER_TASK))
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * factor
        partitions = max(partitions, -(-df.count() * expansion // EXPANDED_ROWS_PER_TASK))
    return df.repartition(partitions, *keys)


def unique_keys(df: DataFrame, keys: list[str]) -> Column:
    """A check over rows partitioned by ``keys``: fails on a repeated key, else null (bits of two rows must not add up)."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return F.when(n > 1, F.raise_error(F.lit(f"key columns {keys} are not unique")))


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on the key columns with null equal to null; the left side's columns first."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"__{k}"]) for k in keys]
    return left.join(renamed, on, how).drop(*[f"__{k}" for k in keys])


def with_stumps(tables, ids: list[str]) -> DataFrame:
    """The split table, with a never-taken split for each tree that has none.

    A split-less tree sends every row to leaf 0; the added row makes it show up
    in the per-(row, tree) aggregate like any other tree.
    """
    sel = F.col("model_id").isin(ids)
    splits = tables.splits.filter(sel)
    bare = tables.leaves.filter(sel).select("model_id", "tree").distinct().join(splits.select("model_id", "tree").distinct(), ["model_id", "tree"], "left_anti")
    if bare.isEmpty():  # a look at the model tables only; the usual plan stays as it is
        return splits
    stumps = bare.join(F.broadcast(tables.models.filter(sel).select("model_id", "n_float")), "model_id").select(
        "model_id",
        "tree",
        F.lit(0).alias("level"),
        F.when(F.col("n_float") > 0, "float").otherwise("onehot").alias("split_type"),
        F.lit(0).alias("feature"),
        F.lit(float("inf")).cast("float").alias("border"),
        F.lit(None).cast("string").alias("value"),
        F.lit(None).cast("int").alias("stat_id"),
    )
    return splits.select(*stumps.columns).unionByName(stumps)


def unpivot_inputs(
    df: DataFrame, keys: list[str], inputs: list[tuple[list[Column], list[Column], list[tuple[int, Column]]]]
) -> DataFrame:
    """Rows -> (keys..., slot, model_idx, x, s), one row per model input.

    ``inputs[i]`` holds model i's (float columns, cat columns, [(stat id,
    statistic column)]), already cast and null-handled. One generator for all
    models keeps the row partitioning.
    """
    structs = [s for i, parts in enumerate(inputs) for s in _long_inputs(i, *parts)]
    return df.select(*keys, F.explode(F.array(*structs)).alias("__i")).select(*keys, "__i.*")


def leaf_index_relational(long: DataFrame, keys: list[str], splits: DataFrame, ids: list[str]) -> DataFrame:
    """D1, relational: (model_idx, keys..., tree, leaf).

    ``splits`` is the model table, broadcast-hinted by the caller after its
    size is checked. Target statistics arrive already looked up per row, so
    every test is a compare on the joined row.
    """
    kind = (
        F.when(F.col("split_type") == "float", F.lit(KIND_FLOAT))
        .when(F.col("split_type") == "onehot", F.lit(KIND_CAT))
        .otherwise(F.lit(KIND_STAT))
    )
    idx = F.when(F.col("split_type") == "target_stat", F.col("stat_id")).otherwise(F.col("feature"))
    s = splits.filter(F.col("model_id").isin(ids)).select(
        slot_key(model_index(ids), kind, idx).alias("slot"),
        (kind == KIND_CAT).alias("is_cat"),
        "tree",
        "level",
        pow2(F.col("level")).alias("bitval"),  # computed on the small table, not per joined row
        "border",
        "value",
    )
    j = long.join(s, "slot")
    bit = F.when(F.col("is_cat"), F.col("s") == F.col("value")).otherwise(~F.isnan("x") & (F.col("x") > F.col("border")))
    leaf = F.sum(F.when(bit, F.col("bitval")).otherwise(0)).cast("int")
    return j.groupBy("model_idx", *keys, "tree").agg(leaf.alias("leaf"))


def leaf_sums(leaf_rows: DataFrame, keys: list[str], leaves: DataFrame, ids: list[str], depth: int, start: int) -> DataFrame:
    """(model_idx, keys..., class_idx, s): leaf values of one range of trees, added per row and class."""
    lv = leaves.filter(F.col("model_id").isin(ids)).select(
        leaf_key(model_index(ids), F.col("tree"), F.col("leaf"), depth, start).alias("lkey"), "values"
    )
    return (
        leaf_rows.select("model_idx", *keys, leaf_key(F.col("model_idx"), F.col("tree"), F.col("leaf"), depth, start).alias("lkey"))
        .join(lv, "lkey")
        .select("model_idx", *keys, F.posexplode("values").alias("class_idx", "v"))
        .groupBy("model_idx", *keys, "class_idx")
        .agg(F.sum("v").alias("s"))
    )


def raw_relational(per_class: DataFrame, keys: list[str], models: DataFrame, ids: list[str]) -> DataFrame:
    """D2, relational: (model_id, keys..., class_idx, raw) in long form, from the sums over all trees."""
    m = F.broadcast(
        models.filter(F.col("model_id").isin(ids)).select(model_index(ids).alias("model_idx"), "model_id", "scale", "bias")
    )
    return per_class.join(m, "model_idx").select(
        "model_id",
        *keys,
        F.col("class_idx").cast("int").alias("class_idx"),
        (F.col("scale") * F.col("s") + F.element_at("bias", F.col("class_idx") + 1)).alias("raw"),
    )
