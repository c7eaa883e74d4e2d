"""Write the model documents used by tests and registered queries.

Nothing here is trained. Trees are drawn from a seeded generator so the
documents are reproducible:

* leaf values are multiples of 1/1024 and leaf weights small integers (some
  zero), so every sum over trees is exact in any order;
* borders are float32 and many are taken from real column values at sf0.01,
  which exercises the strict ``x > border`` rule;
* every model has trees that split twice on one feature.

Run ``python tools/make_models.py`` to rewrite ``sylva/fixtures/*.json``.
"""

from __future__ import annotations

import json
from pathlib import Path

import numpy as np
import pyarrow.compute as pc
import pyarrow.parquet as pq

DATA = Path("/root/testdata/sf0.01")
OUT = Path(__file__).resolve().parent.parent / "sylva" / "fixtures"


def column_values(table: str, column: str) -> np.ndarray:
    t = pq.read_table(DATA / f"{table}.parquet", columns=[column])
    return np.asarray(t[column].to_numpy(zero_copy_only=False))


def month_values() -> np.ndarray:
    t = pq.read_table(DATA / "orders.parquet", columns=["o_orderdate"])
    return np.asarray(pc.month(t["o_orderdate"]).to_numpy(), dtype=np.float64)


def embedding_values(i: int) -> np.ndarray:
    t = pq.read_table(DATA / "embeddings.parquet", columns=["embedding"])
    return np.asarray([row[i] for row in t["embedding"].to_pylist()], dtype=np.float64)


def border_from(rng: np.random.Generator, values: np.ndarray) -> float:
    """A float32 border: half the time an actual data value, else a quantile."""
    if rng.random() < 0.5:
        v = float(values[rng.integers(0, len(values))])
    else:
        v = float(np.quantile(values, rng.uniform(0.05, 0.95)))
    return float(np.float32(v))


def leaf_block(rng: np.random.Generator, depth: int, k: int, spread: int) -> tuple[list, list]:
    n = 1 << depth
    values = (rng.integers(-spread, spread + 1, size=n * k) / 1024.0).tolist()
    weights = rng.integers(0, 12, size=n).astype(float)
    weights[rng.random(n) < 0.15] = 0.0
    return values, weights.tolist()


def float_model(
    rng,
    *,
    names,
    values,
    k,
    n_trees,
    depth,
    loss,
    scale,
    bias,
    metadata,
    spread=1024,
):
    trees = []
    n_f = len(names)
    for t in range(n_trees):
        feats = rng.integers(0, n_f, size=depth)
        if t % 3 == 0 and depth >= 2:  # a repeated feature in every third tree
            feats[1] = feats[0]
        splits = [
            {"split_type": "float", "float_feature_index": int(f), "border": border_from(rng, values[f])}
            for f in feats
        ]
        lv, lw = leaf_block(rng, depth, k, spread)
        trees.append({"splits": splits, "leaf_values": lv, "leaf_weights": lw})
    return {
        "loss_function": loss,
        "features_info": {
            "float_features": [
                {"feature_id": n, "flat_feature_index": i} for i, n in enumerate(names)
            ],
            "categorical_features": [],
        },
        "oblivious_trees": trees,
        "scale_and_bias": [scale, bias],
        "metadata": metadata,
    }


def class_params(names, kind):
    return json.dumps({"class_names": names, "class_label_type": kind})


def churn_model(rng):
    """M2: two floats, two categoricals (one-hot and target-statistic splits)."""
    floats = ["o_totalprice", "c_acctbal"]
    cats = ["o_orderpriority", "c_mktsegment"]
    fvals = [column_values("orders", "o_totalprice"), column_values("customer", "c_acctbal")]
    prio = sorted(set(column_values("orders", "o_orderpriority").tolist()))
    seg = sorted(set(column_values("customer", "c_mktsegment").tolist()))
    cat_levels = [prio, seg]
    stats = []
    for sid, (ci, levels) in enumerate([(0, prio), (1, seg)]):
        counts = rng.integers(20, 200, size=len(levels))
        sums = np.floor(counts * rng.uniform(0.1, 0.9, size=len(levels)))
        stats.append(
            {
                "stat_id": sid,
                "cat_feature_index": ci,
                "prior": 0.5,
                "prior_weight": 1.0,
                "keys": levels,
                "sums": sums.tolist(),
                "counts": counts.astype(float).tolist(),
            }
        )
    stat_values = [
        np.array([(s + 0.5) / (c + 1.0) for s, c in zip(st["sums"], st["counts"])]) for st in stats
    ]
    trees = []
    depth = 4
    for t in range(80):
        splits = []
        for d in range(depth):
            kind = rng.choice(["float", "float", "onehot", "target_stat"])
            if kind == "float":
                f = int(rng.integers(0, 2))
                splits.append({"split_type": "float", "float_feature_index": f, "border": border_from(rng, fvals[f])})
            elif kind == "onehot":
                c = int(rng.integers(0, 2))
                splits.append(
                    {
                        "split_type": "onehot",
                        "cat_feature_index": c,
                        "value": cat_levels[c][int(rng.integers(0, len(cat_levels[c])))],
                    }
                )
            else:
                sid = int(rng.integers(0, 2))
                sv = stat_values[sid]
                b = float(np.float32(sv[int(rng.integers(0, len(sv)))]))
                splits.append(
                    {"split_type": "target_stat", "cat_feature_index": stats[sid]["cat_feature_index"],
                     "stat_id": sid, "border": b}
                )
        if t % 4 == 0:
            splits[1] = dict(splits[0])
            if "border" in splits[1] and splits[1]["split_type"] == "float":
                splits[1]["border"] = border_from(rng, fvals[splits[1]["float_feature_index"]])
        lv, lw = leaf_block(rng, depth, 1, 512)
        trees.append({"splits": splits, "leaf_values": lv, "leaf_weights": lw})
    return {
        "loss_function": "Logloss",
        "features_info": {
            "float_features": [{"feature_id": n, "flat_feature_index": i} for i, n in enumerate(floats)],
            "categorical_features": [
                {"feature_id": n, "flat_feature_index": 2 + i} for i, n in enumerate(cats)
            ],
        },
        "oblivious_trees": trees,
        "scale_and_bias": [1.0, [-0.125]],
        "target_stats": stats,
        "metadata": {
            "class_params": class_params([0, 1], "Integer"),
            "model_guid": "churn-0001",
            "train_finish_time": "2026-01-05T10:00:00Z",
        },
    }


def main() -> None:
    OUT.mkdir(parents=True, exist_ok=True)
    order_vals = [
        column_values("orders", "o_totalprice"),
        column_values("customer", "c_acctbal"),
        column_values("customer", "c_nationkey").astype(np.float64),
        month_values(),
    ]
    m1_args = dict(
        names=["o_totalprice", "c_acctbal", "c_nationkey", "o_month"],
        values=order_vals,
        k=3,
        n_trees=50,
        depth=4,
        loss="MultiClass",
        scale=1.0,
        bias=[0.25, -0.125, 0.0],
    )
    m1 = float_model(
        np.random.default_rng(101),
        **m1_args,
        metadata={
            "class_params": class_params(["F", "O", "P"], "String"),
            "model_guid": "iris-like-0001",
            "train_finish_time": "2026-01-05T10:00:00Z",
            "params": json.dumps({"loss_function": "MultiClass", "depth": 4, "iterations": 50}),
            "empty_key": "",
        },
    )
    m1i = float_model(
        np.random.default_rng(101),
        **m1_args,
        metadata={"class_params": class_params([0, 1, 2], "Integer"), "model_guid": "iris-like-0002"},
    )
    part_vals = [column_values("part", "p_size").astype(np.float64), column_values("part", "p_retailprice")]
    m3_vals = [embedding_values(i) for i in range(64)]
    m3 = float_model(
        np.random.default_rng(303),
        names=[""] * 64,
        values=m3_vals,
        k=4,
        n_trees=60,
        depth=4,
        loss="MultiLogloss",
        scale=1.0,
        bias=[0.0, 0.0625, -0.0625, 0.125],
        metadata={"class_params": class_params([0, 1, 2, 3], "Integer")},
    )
    m4 = float_model(
        np.random.default_rng(404),
        names=["p_size", "p_retailprice"],
        values=part_vals,
        k=1,
        n_trees=20,
        depth=3,
        loss="RMSE",
        scale=0.5,
        bias=[1.5],
        metadata={},
        spread=256,
    )
    m5 = float_model(
        np.random.default_rng(505),
        names=["p_size", "p_retailprice"],
        values=part_vals,
        k=2,
        n_trees=20,
        depth=3,
        loss="RMSEWithUncertainty",
        scale=1.0,
        bias=[2.0, -0.5],
        metadata={},
        spread=256,
    )
    m2 = churn_model(np.random.default_rng(202))
    for name, doc in [("m1", m1), ("m1i", m1i), ("m2", m2), ("m3", m3), ("m4", m4), ("m5", m5)]:
        (OUT / f"{name}.json").write_text(json.dumps(doc, indent=1) + "\n")
        print(name, len(doc["oblivious_trees"]), "trees")


if __name__ == "__main__":
    main()
