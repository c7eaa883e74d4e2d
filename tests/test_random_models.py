"""Seeded random models and rows: every plan agrees with a plain-Python walk.

Random depths (1-5, mixed within a model), feature counts, class counts,
zero weights, repeated split features, and rows that sit exactly on borders
or hold NaN/null.
"""

import json

import numpy as np

from sylva.operators import explain as X
from sylva.plans.model import Model, score_many
from sylva.sources.model_docs import load_model_texts


def random_model(rng, n_f, k):
    trees = []
    for _ in range(int(rng.integers(3, 9))):
        depth = int(rng.integers(1, 6))
        trees.append(
            {
                "splits": [
                    {"float_feature_index": int(rng.integers(0, n_f)), "border": float(np.float32(rng.integers(-4, 5) / 2))}
                    for _ in range(depth)
                ],
                "leaf_values": (rng.integers(-512, 513, size=(1 << depth) * k) / 256.0).tolist(),
                "leaf_weights": rng.integers(0, 4, size=1 << depth).astype(float).tolist(),
            }
        )
    return {
        "features_info": {"float_features": [{"feature_id": f"x{i}"} for i in range(n_f)]},
        "oblivious_trees": trees,
        "scale_and_bias": [float(rng.choice([0.5, 1.0, 2.0])), (rng.integers(-4, 5, size=k) / 4).tolist()],
    }


def walk(doc, row):
    scale, bias = doc["scale_and_bias"]
    k = len(bias)
    total = np.zeros(k)
    for t in doc["oblivious_trees"]:
        leaf = 0
        for lv, s in enumerate(t["splits"]):
            x = row[s["float_feature_index"]]
            x = np.float32(0.0 if x is None else x)
            if not np.isnan(x) and x > np.float32(s["border"]):
                leaf |= 1 << lv
        total += np.asarray(t["leaf_values"][leaf * k : (leaf + 1) * k])
    return scale * total + np.asarray(bias)


def test_random_models(spark):
    rng = np.random.default_rng(2024)
    docs = {f"r{i}": random_model(rng, int(rng.integers(1, 5)), int(rng.integers(1, 4))) for i in range(4)}
    tables = load_model_texts(spark, {mid: json.dumps(d) for mid, d in docs.items()}).cache()
    n_f_max = 4
    values = [None, float("nan"), -2.0, -0.5, 0.0, 0.5, 1.0, 1.5, 2.0, 0.25, -1.75]
    rows = [(i, *[values[int(rng.integers(0, len(values)))] for _ in range(n_f_max)]) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, " + ", ".join(f"x{i} double" for i in range(n_f_max))).cache()
    relational = {
        (r["model_id"], r["k"], r["class_idx"]): r["raw"] for r in score_many(df, tables, list(docs), ["k"]).collect()
    }
    for mid, doc in docs.items():
        m = Model(tables, mid)
        dense = {r["k"]: r["raw"] for r in m.raw(df).select("k", "raw").collect()}
        for r in rows:
            want = walk(doc, r[1:])
            assert np.array_equal(np.asarray(dense[r[0]]), want), (mid, r)
            assert [relational[(mid, r[0], c)] for c in range(len(want))] == list(want)
        ex = m.explain(df).select("k", "explanation").collect()
        for r in ex:
            for c, e in enumerate(r["explanation"]):
                assert abs(e["raw"] - dense[r["k"]][c]) < 1e-9
        rel = X.phi_relational(df, m.explainer(), ["k"]).select("k", "phi").collect()
        dense_phi = {r["k"]: r["phi"] for r in m.explain(df).select("k", "phi").collect()}
        assert all(np.allclose(r["phi"], dense_phi[r["k"]], atol=1e-12) for r in rel)
