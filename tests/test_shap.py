"""SHAP tables and explanations."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import doc
from sylva import catalog
from sylva.operators import treeshap as TS
from sylva.operators.checks import contributions_well_formed


def brute_tree(feats, values, w, n_features):
    """Shapley values over all features of the path-dependent expectation, by recursion."""
    depth = len(feats)
    n_leaves = 1 << depth

    def cover(node, d):
        return sum(w[l] for l in range(n_leaves) if (l & ((1 << d) - 1)) == node)

    def expect(h, subset):
        def rec(d, node, p):
            if d == depth:
                return p * values[node]
            if feats[d] in subset:
                return rec(d + 1, node | (((h >> d) & 1) << d), p)
            c = cover(node, d)
            hi = node | (1 << d)
            return rec(d + 1, node, p * cover(node, d + 1) / c) + rec(d + 1, hi, p * cover(hi, d + 1) / c)

        return rec(0, 0, 1.0)

    phi = np.zeros((n_leaves, n_features, values.shape[1]))
    for h in range(n_leaves):
        for i in range(n_features):
            others = [j for j in range(n_features) if j != i]
            for r in range(len(others) + 1):
                for s in itertools.combinations(others, r):
                    wt = math.factorial(r) * math.factorial(n_features - r - 1) / math.factorial(n_features)
                    phi[h, i] += wt * (expect(h, set(s) | {i}) - expect(h, set(s)))
    return phi


@pytest.mark.parametrize("seed", range(6))
def test_leaf_shap_matches_brute_force(seed):
    rng = np.random.default_rng(seed)
    depth = int(rng.integers(1, 5))
    feats = rng.integers(0, 4, size=depth)
    values = rng.normal(size=(1 << depth, 2))
    w = rng.integers(0, 5, size=1 << depth).astype(float)
    w[w == 0] = TS.ZERO_WEIGHT
    leaves = np.arange(1 << depth)
    covers = [np.bincount(leaves & ((1 << d) - 1), weights=w) for d in range(depth + 1)]
    used, phi = TS.leaf_shap(feats, values, covers)
    full = np.zeros((1 << depth, 4, 2))
    full[:, used, :] = phi
    assert np.abs(full - brute_tree(feats, values, w, 4)).max() < 1e-12
    expected = (values * w[:, None]).sum(0) / w.sum()
    assert np.abs(full.sum(axis=1) + expected - values).max() < 1e-12  # efficiency


def test_cover_expected_bias(tables):
    d = doc("m4")
    one = tables.only("m4")
    cover = {(r["tree"], r["level"], r["node"]): r["cover"] for r in TS.node_cover(one).collect()}
    w = np.array(d["oblivious_trees"][0]["leaf_weights"])
    w = np.where(w == 0, TS.ZERO_WEIGHT, w)
    assert math.isclose(cover[(0, 0, 0)], w.sum())
    assert math.isclose(cover[(0, 1, 1)], w[1::2].sum())
    assert math.isclose(cover[(0, 3, 5)], w[5])
    ex = {r["tree"]: r["expected"] for r in TS.tree_expected(one).collect()}
    v = np.array(d["oblivious_trees"][0]["leaf_values"])
    assert math.isclose(ex[0], (v * w).sum() / w.sum())
    bias = TS.bias_row(one).first()["bias"]
    assert math.isclose(bias, sum(ex.values()) * 0.5 + 1.5)


def test_shap_table_is_sparse_and_scaled(tables):
    one = tables.only("m4")
    st = TS.shap_table(one)
    d = doc("m4")
    per_tree = {r["tree"]: r["n"] for r in st.groupBy("tree").agg(F.countDistinct("feature").alias("n")).collect()}
    for t, tree in enumerate(d["oblivious_trees"]):
        assert per_tree[t] == len({s["float_feature_index"] for s in tree["splits"]})
    # efficiency per leaf includes the scale
    ex = {r["tree"]: r["expected"] for r in TS.tree_expected(one).collect()}
    sums = {(r["tree"], r["leaf"]): r["s"] for r in st.groupBy("tree", "leaf").agg(F.sum(F.col("phi")[0]).alias("s")).collect()}
    for (t, leaf), s in sums.items():
        v = d["oblivious_trees"][t]["leaf_values"][leaf]
        assert abs(s + 0.5 * ex[t] - 0.5 * v) < 1e-12


def test_explain_dense_relational_additive(spark, orders):
    m = catalog.model(spark, "m1")
    dense = m.explain(m.raw(orders))
    rel = m.explain(orders, plan="relational", keys=["o_orderkey"]).select("o_orderkey", F.col("phi").alias("phi_r"))
    rows = dense.join(rel, "o_orderkey").collect()
    assert len(rows) == orders.count()
    for r in rows:
        assert np.allclose(r["phi"], r["phi_r"], atol=1e-12)
        for k, e in enumerate(r["explanation"]):
            assert abs(e["raw"] - r["raw"][k]) < 1e-9  # G3
            assert e["class"] == ["F", "O", "P"][k]
            assert [c["name"] for c in e["contributions"]][0] in ("o_totalprice", "c_acctbal", "c_nationkey", "o_month")
    ok = dense.select(F.explode("explanation").alias("e")).filter(contributions_well_formed(F.col("e.contributions"), 4)).count()
    assert ok == 3 * len(rows)  # G7


def test_quantized_drift(spark, orders):
    m = catalog.model(spark, "m1")
    a = m.explain(orders).select("o_orderkey", F.flatten("phi").alias("a"))
    b = m.explain(orders, quantize="float16").select("o_orderkey", F.flatten("phi").alias("b"))
    drift = a.join(b, "o_orderkey").select(F.array_max(F.zip_with("a", "b", lambda x, y: F.abs(x - y))).alias("d"))
    assert drift.agg(F.max("d")).first()[0] < 5e-3  # G4


def test_label_fallback_and_cat_guard(spark):
    assert catalog.model(spark, "m4").explainer().class_names == ["0"]
    with pytest.raises(ValueError, match="categorical"):
        catalog.model(spark, "m2").explainer()
    assert catalog.model(spark, "m2").has_explainer() is False
    assert catalog.model(spark, "m4").has_explainer() is True  # its table was built above


def test_relational_explanation_in_ranges_of_trees(spark, orders, tables, monkeypatch):
    from sylva.plans import compiled as C
    from sylva.plans.model import Model

    want = {r["o_orderkey"]: r["phi"] for r in catalog.model(spark, "m1").explain(orders).select("o_orderkey", "phi").collect()}
    monkeypatch.setattr(C, "BLOCK_VALUES", 16 * 4 * 3 * 9)  # 9 trees a range
    got = Model(tables, "m1").explain(orders, plan="relational", keys=["o_orderkey"]).select("o_orderkey", "phi").collect()
    assert len(got) == len(want)
    for r in got:
        assert np.allclose(r["phi"], want[r["o_orderkey"]], atol=1e-12)


def test_explainer_checks_its_names(spark):
    from sylva.operators.explain import Explainer

    ex = catalog.model(spark, "m1").explainer()
    for bad in ({"feature_names": ["a"]}, {"class_names": ["x", "y"]}):
        with pytest.raises(ValueError, match="where the table has"):
            ex.named(ex.header, **bad)
    with pytest.raises(ValueError, match="bias values"):
        Explainer(ex.header, ex.forest, [0.0])
    renamed = ex.named(ex.header, ["p", "q", "r", "s"], ["A", "B", "C"])
    assert renamed.feature_names[3] == "s" and renamed.class_names == ["A", "B", "C"]
