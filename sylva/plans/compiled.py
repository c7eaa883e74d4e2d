"""A model as the dense (Arrow) plans use it: a header, and blocks of trees.

The header holds names, labels, scale and bias. The trees stay in the model
tables; for a job they are taken in ranges of trees whose values fit
``BLOCK_VALUES``, and every range becomes one broadcast block of NumPy arrays.
Spark keeps broadcasts on the executors' disks; a task maps one block at a time
(``operators/kernel.py``), so neither the driver nor a task ever holds more of a
model than one block, whatever its size.

Splits are rewritten over *virtual features*: float features first, then one
0/1 column per (categorical feature, one-hot value) and one column per target
statistic. Every split then becomes ``v > border`` on float32.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.model_docs import ModelTables

# Leaf and SHAP values (doubles) of one block: 16M doubles = 128 MB. A 785-tree,
# depth-6, 5-class model holds 0.25M leaf values.
BLOCK_VALUES = 16 * 1024 * 1024


@dataclass
class ModelHeader:
    """All of a model but its trees."""

    model_id: str
    loss_function: str | None
    scale: float
    bias: np.ndarray  # (K,)
    dims: int
    n_trees: int
    max_depth: int
    float_names: list[str]
    cat_names: list[str]
    all_names: list[str]
    class_names: list[str] | None
    label_kind: str | None
    metadata: dict[str, str]
    virtual: list[tuple] = field(default_factory=list)  # ("float", i) | ("onehot", j, value) | ("stat", sid, j)
    stat_priors: dict[int, float] = field(default_factory=dict)
    stat_sizes: dict[int, int] = field(default_factory=dict)

    @property
    def n_float(self) -> int:
        return len(self.float_names)

    @property
    def n_cat(self) -> int:
        return len(self.cat_names)

    def summary(self) -> str:
        """The one-line description."""
        return f"trees={self.n_trees} floats={self.n_float} cats={self.n_cat} dim={self.dims}"


def model_row(tables: ModelTables, model_id: str):
    m = tables.models.filter(F.col("model_id") == model_id).collect()
    if not m:
        rej = tables.rejected.filter(F.col("model_id") == model_id).collect()
        reason = rej[0]["reason"] if rej else "no such model"
        raise KeyError(f"model {model_id!r}: {reason}")
    return m[0]


def model_header(tables: ModelTables, model_id: str) -> ModelHeader:
    """Names, labels, constants and virtual features of one model (four small jobs)."""
    row = model_row(tables, model_id)
    mine = F.col("model_id") == model_id
    feats = tables.features.filter(mine).select("position", "name", "kind", "kind_index").collect()
    stats = (
        tables.target_stats.filter(mine)
        .groupBy("stat_id", "cat_index")
        .agg(F.first("prior_value").alias("prior"), F.count("*").alias("n"))
        .collect()
    )
    float_names = [r["name"] for r in sorted((r for r in feats if r["kind"] == "float"), key=lambda r: r["kind_index"])]
    cat_names = [r["name"] for r in sorted((r for r in feats if r["kind"] == "cat"), key=lambda r: r["kind_index"])]
    virtual: list[tuple] = [("float", i) for i in range(len(float_names))]
    if cat_names:
        tests = tables.splits.filter(mine & (F.col("split_type") != "float")).select("split_type", "feature", "value", "stat_id").distinct()
        stat_cat = {r["stat_id"]: r["cat_index"] for r in stats}
        virtual += sorted(
            {
                ("onehot", r["feature"], r["value"]) if r["split_type"] == "onehot" else ("stat", r["stat_id"], stat_cat.get(r["stat_id"], r["feature"]))
                for r in tests.collect()
            },
            key=repr,
        )
    return ModelHeader(
        model_id=model_id,
        loss_function=row["loss_function"],
        scale=float(row["scale"]),
        bias=np.asarray(row["bias"], dtype=np.float64),
        dims=row["dims"],
        n_trees=row["n_trees"],
        max_depth=row["max_depth"],
        float_names=float_names,
        cat_names=cat_names,
        all_names=[r["name"] for r in sorted(feats, key=lambda r: r["position"])],
        class_names=list(row["class_names"]) if row["class_names"] is not None else None,
        label_kind=row["label_kind"],
        metadata=dict(row["metadata"] or {}),
        virtual=virtual,
        stat_priors={r["stat_id"]: float(r["prior"]) for r in stats},
        stat_sizes={r["stat_id"]: int(r["n"]) for r in stats},
    )


def _range(df: DataFrame, start: int, end: int, *columns: str) -> dict[str, np.ndarray]:
    """The rows of trees [start, end) as NumPy columns, by Arrow; ``tree`` counts from the range's start."""
    got = df.filter((F.col("tree") >= start) & (F.col("tree") < end)).select((F.col("tree") - start).alias("tree"), *columns).toArrow()
    out = {}
    for name in ("tree", *columns):
        column = got.column(name).combine_chunks()
        if str(column.type).startswith("list"):
            flat = column.flatten().to_numpy(zero_copy_only=False)
            out[name] = flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
        else:
            out[name] = column.to_numpy(zero_copy_only=False)
    return out


def _split_arrays(splits: DataFrame, virtual: list[tuple], start: int, end: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(trees, depth) virtual feature and border per level; levels that a tree lacks get a border of +inf."""
    feat = np.zeros((end - start, depth), dtype=np.int32)
    border = np.full((end - start, depth), np.inf, dtype=np.float32)
    if len(virtual) and all(v[0] == "float" for v in virtual):
        s = _range(splits, start, end, "level", "feature", "border")
        feat[s["tree"], s["level"]] = s["feature"]
        border[s["tree"], s["level"]] = s["border"]
        return feat, border
    index = {v[:2] if v[0] == "stat" else v: i for i, v in enumerate(virtual)}
    s = _range(splits, start, end, "level", "split_type", "feature", "border", "value", "stat_id")
    for t, d, kind, f, b, value, sid in zip(*(s[c] for c in ("tree", "level", "split_type", "feature", "border", "value", "stat_id"))):
        key = ("float", int(f)) if kind == "float" else ("onehot", int(f), value) if kind == "onehot" else ("stat", int(sid))
        feat[t, d] = index[key]
        border[t, d] = 0.5 if kind == "onehot" else b
    return feat, border


def _leaf_array(leaves: DataFrame, start: int, end: int, n_leaves: int, dims: int) -> np.ndarray:
    rows = _range(leaves, start, end, "leaf", "values")
    out = np.zeros((end - start, n_leaves, dims))
    out[rows["tree"], rows["leaf"]] = rows["values"].reshape(-1, dims)
    return out


def _shap_arrays(shap: DataFrame, start: int, end: int, n_leaves: int, depth: int, dims: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per tree: the features it uses, and phi as (used, leaf, K)."""
    rows = _range(shap, start, end, "leaf", "feature", "phi")
    out = []
    order = np.argsort(rows["tree"], kind="stable")
    ends = np.searchsorted(rows["tree"][order], np.arange(end - start + 1))
    for t in range(end - start):
        mine = order[ends[t] : ends[t + 1]]
        used, slot = np.unique(rows["feature"][mine], return_inverse=True)
        phi = np.zeros((len(used), n_leaves, dims))
        if len(mine):
            phi[slot, rows["leaf"][mine]] = rows["phi"][mine]
        out.append((used.astype(np.int64), phi))
    return out


@dataclass
class Forest:
    """Where the trees of a walk come from: tables of one model or sidecar, by tree."""

    n_trees: int
    max_depth: int
    dims: int
    virtual: list[tuple]
    splits: DataFrame  # tree, level, split_type, feature, border (value, stat_id)
    leaves: DataFrame | None = None  # tree, leaf, values
    shaps: list[DataFrame] = field(default_factory=list)  # tree, leaf, feature, phi

    def ranges(self, block_values: int) -> list[tuple[int, int]]:
        """Tree ranges [start, end) of at most ``block_values`` values (one tree at least)."""
        per_tree = (1 << self.max_depth) * self.dims * (int(self.leaves is not None) + max(1, self.max_depth) * len(self.shaps))
        step = max(1, block_values // max(1, per_tree))
        return [(s, min(s + step, self.n_trees)) for s in range(0, self.n_trees, step)]

    def blocks(self, block_values: int | None = None) -> Iterator[dict]:
        """The blocks one after another; each is let go before the next is read."""
        for start, end in self.ranges(BLOCK_VALUES if block_values is None else block_values):
            feat, border = _split_arrays(self.splits, self.virtual, start, end, self.max_depth)
            n_leaves = 1 << self.max_depth
            yield {
                "start": start,
                "feat": feat,
                "border": border,
                "leaves": None if self.leaves is None else _leaf_array(self.leaves, start, end, n_leaves, self.dims),
                "shaps": [_shap_arrays(s, start, end, n_leaves, self.max_depth, self.dims) for s in self.shaps],
            }

    def broadcast(self, block_values: int | None = None) -> list[Broadcast]:
        sc = self.splits.sparkSession.sparkContext
        return [sc.broadcast(b) for b in self.blocks(block_values)]


def forest_of(tables: ModelTables, header: ModelHeader, shaps: list[DataFrame] | None = None) -> Forest:
    """A model's own trees, with SHAP tables (tree, leaf, feature, phi) beside them."""
    mine = F.col("model_id") == header.model_id
    return Forest(
        header.n_trees, header.max_depth, header.dims, header.virtual, tables.splits.filter(mine), tables.leaves.filter(mine), shaps or []
    )
