"""One input rule on every surface, documents as a library exports them, and the relational plan's edge rows."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sylva.operators import explain as X
from sylva.operators import treeshap as TS
from sylva.plans.model import Model, score_many
from sylva.sources.model_docs import load_model_texts


def doc(trees, n_f=1, bias=(0.0,), cats=0, **more):
    return json.dumps(
        {
            "features_info": {
                "float_features": [{"feature_id": f"x{i}"} for i in range(n_f)],
                "categorical_features": [{"feature_id": f"c{i}"} for i in range(cats)],
            },
            "oblivious_trees": trees,
            "scale_and_bias": [1.0, list(bias)],
            **more,
        }
    )


def split(border, feature=0):
    return {"float_feature_index": feature, "border": border}


STEP = {"splits": [split(-0.5)], "leaf_values": [1.0, 2.0], "leaf_weights": [1.0, 1.0]}
STUMP = {"splits": [], "leaf_values": [10.0], "leaf_weights": [2.0]}


def test_nan_and_null_through_sql_agree_with_the_dataframe(spark):
    m = Model.from_text(spark, doc([STEP]), "step")
    rows = spark.createDataFrame([(1, float("nan")), (2, None), (3, 0.0), (4, -1.0)], "k int, x0 double")
    rows.createOrReplaceTempView("input_rows")
    for options in ({}, {"null_mode": "nan"}, {"nan_mode": "max"}, {"null_mode": "nan", "nan_mode": "max"}):
        name = m.register_udf(spark, "step_fn", **options)
        sql = {r[0]: r[1][0] for r in spark.sql(f"SELECT k, {name}(x0) FROM input_rows").collect()}
        frame = {r["k"]: r["raw"][0] for r in m.raw(rows, **options).collect()}
        assert sql == frame
    assert frame[1] == 2.0 and m.raw(rows).where("k = 1").first()["raw"] == [1.0]


def test_sql_function_refuses_text_and_unwanted_nulls(spark):
    m = Model.from_text(spark, doc([STEP]), "step")
    name = m.register_udf(spark, "step_strict", null_mode="error", nan_mode="error")
    with pytest.raises(Exception, match="float feature"):
        spark.sql(f"SELECT {name}('hello')").collect()
    with pytest.raises(Exception, match="null value"):
        spark.sql(f"SELECT {name}(CAST(NULL AS DOUBLE))").collect()


@pytest.mark.parametrize("bad", [None, [], [1.0, 2.0]])
def test_wrong_arrays_are_refused_by_both_plans(spark, bad):
    m = Model.from_text(spark, doc([STEP]), "step")
    rows = spark.createDataFrame([(1, bad)], "k int, x array<double>")
    with pytest.raises(Exception, match="float values where the model takes 1"):
        m.raw(rows, features="x").collect()
    with pytest.raises(Exception, match="float values where the model takes 1"):
        m.raw_long(rows, keys=["k"], features="x").collect()


def test_null_and_unknown_maps_are_refused_by_both_plans(spark):
    m = Model.from_text(spark, doc([STEP]), "step")
    for row, why in ((None, "lacks feature x0"), ({"x0": 1.0, "y": 2.0}, "does not know: y")):
        rows = spark.createDataFrame([(1, row)], "k int, m map<string,double>")
        with pytest.raises(Exception, match=why):
            m.raw(rows, row_map="m").collect()
        with pytest.raises(Exception, match=why):
            m.raw_long(rows, keys=["k"], row_map="m").collect()


def test_relational_plan_keeps_null_keys_and_bare_trees(spark):
    m = Model.from_text(spark, doc([STEP, STUMP]), "bare")
    rows = spark.createDataFrame([(None, 1.0), (1, -1.0), (2, 3.0)], "k int, x0 double")
    want = {r["k"]: r["raw"] for r in m.raw(rows).collect()}
    assert want == {None: [12.0], 1: [11.0], 2: [12.0]}
    assert {r["k"]: r["raw"] for r in m.raw(rows, plan="relational", keys=["k"]).collect()} == want
    assert {r["k"]: r["phi"] for r in m.explain(rows, plan="relational", keys=["k"]).collect()} == {
        r["k"]: r["phi"] for r in m.explain(rows).collect()
    }
    only = Model.from_text(spark, doc([STUMP]), "stump")
    assert {r["raw"] for r in only.raw_long(rows, keys=["k"]).collect()} == {10.0}


def test_relational_plan_refuses_repeated_keys(spark):
    m = Model.from_text(spark, doc([STEP]), "step")
    rows = spark.createDataFrame([(1, 1.0), (1, -1.0)], "k int, x0 double")
    with pytest.raises(Exception, match="not unique"):
        m.raw_long(rows, keys=["k"]).collect()


def test_planning_the_relational_score_runs_nothing_of_the_input(spark):
    m = Model.from_text(spark, doc([STEP]), "step")
    bomb = spark.range(3).select(F.col("id").alias("k"), F.raise_error(F.lit("was run")).cast("double").alias("x0"))
    score_many(bomb.join(bomb.select("k"), "k"), m.tables, ["step"], ["k"])


def test_statistic_without_keys_scores_its_prior(spark):
    tree = {"splits": [{"split_type": "target_stat", "cat_feature_index": 0, "stat_id": 0, "border": 0.3}], "leaf_values": [1.0, 2.0], "leaf_weights": [1.0, 1.0]}
    stat = {"stat_id": 0, "cat_feature_index": 0, "prior": 0.5, "prior_weight": 1.0, "keys": [], "sums": [], "counts": []}
    m = Model.from_text(spark, doc([tree], n_f=0, cats=1, target_stats=[stat]), "prior")
    rows = spark.createDataFrame([(1, "a"), (2, None)], "k int, c0 string")
    assert [r["raw"] for r in m.raw(rows).collect()] == [[2.0], [2.0]]
    assert [r["raw"] for r in m.raw_long(rows, keys=["k"]).collect()] == [2.0, 2.0]


def test_hashed_one_hot_values_are_rejected(spark):
    tree = {"splits": [{"split_type": "OneHotFeature", "cat_feature_index": 0, "value": 12345}], "leaf_values": [1.0, 2.0], "leaf_weights": [1.0, 1.0]}
    tables = load_model_texts(spark, {"hashed": doc([tree], n_f=0, cats=1)})
    assert "hashed categories" in tables.rejected.first()["reason"]


def test_metadata_of_an_export(spark):
    info = {
        "class_params": json.dumps({"class_names": ["no", "yes"], "class_label_type": "String"}),
        "params": {"loss_function": {"type": "MultiLogloss", "params": {}}},
        "model_guid": "g-1",
    }
    tree = {**STEP, "leaf_values": [1.0, -1.0, 2.0, 3.0]}
    m = Model.from_text(spark, doc([tree], bias=(0.0, 0.0), model_info=info), "export")
    got = m.tables.models.first()
    assert got["class_names"] == ["no", "yes"] and got["loss_function"] == "MultiLogloss" and got["metadata"]["model_guid"] == "g-1"
    rows = spark.createDataFrame([(1.0,)], "x0 double")
    assert m.predict(rows, "class").first()["prediction"] == [1.0, 1.0]  # multi-label, not argmax


@pytest.mark.parametrize("depth", [8, 12])
def test_deep_trees_are_explained(depth):
    rng = np.random.default_rng(depth)
    feats = rng.integers(0, depth - 2, size=depth)
    values = rng.normal(size=(1 << depth, 2))
    w = rng.integers(1, 5, size=1 << depth).astype(float)
    used, phi = TS.leaf_shap(feats, values, [np.bincount(np.arange(len(w)) & ((1 << d) - 1), weights=w) for d in range(len(feats) + 1)])
    expected = (values * w[:, None]).sum(0) / w.sum()
    assert np.abs(phi.sum(axis=1) + expected - values).max() < 1e-9  # efficiency
    # one leaf against the definition, by a walk per subset
    h, j = int(rng.integers(0, 1 << depth)), int(rng.integers(0, len(used)))
    if depth > 8:
        return

    def expect(subset):
        def at(d, leaves):
            if d == depth:
                return values[leaves[0]]
            sides = [leaves[(leaves >> d) & 1 == b] for b in (0, 1)]
            if feats[d] in subset:
                return at(d + 1, sides[h >> d & 1])
            total = w[leaves].sum()
            return sum(w[s].sum() / total * at(d + 1, s) for s in sides)

        return at(0, np.arange(1 << depth))

    others = [f for f in used if f != used[j]]
    want = np.zeros(2)
    for bits in range(1 << len(others)):
        s = {f for i, f in enumerate(others) if bits >> i & 1}
        want += math.factorial(len(s)) * math.factorial(len(others) - len(s)) / math.factorial(len(used)) * (expect(s | {used[j]}) - expect(s))
    assert np.abs(phi[h, j] - want).max() < 1e-9


def test_wide_models_are_explained(spark):
    n = 2000
    trees = [{"splits": [split(0.0, f)], "leaf_values": [-1.0, 1.0 + f % 3], "leaf_weights": [1.0, 1.0]} for f in range(0, n, 500)]
    m = Model.from_text(spark, doc(trees, n_f=n), "wide")
    rows = spark.createDataFrame([([1.0] * n,)], "x array<double>")
    got = m.explain(rows, features="x").first()["explanation"][0]
    assert got["raw"] == sum(1.0 + f % 3 for f in range(0, n, 500))
    top = got["contributions"][:4]
    assert [abs(c["phi"]) for c in top] == sorted((abs(c["phi"]) for c in got["contributions"]), reverse=True)[:4]
    assert set(got["contributions"][0].__fields__) == {"feature", "name", "phi"}


def test_ranking_breaks_ties_by_feature(spark):
    trees = [{"splits": [split(0.0, f)], "leaf_values": [-1.0, 1.0], "leaf_weights": [1.0, 1.0]} for f in (2, 0, 1)]
    m = Model.from_text(spark, doc(trees, n_f=3), "ties")
    rows = spark.createDataFrame([(1.0, 1.0, -1.0)], "x0 double, x1 double, x2 double")
    e = m.explain(rows).select(X.F.col("explanation")[0]["contributions"].alias("c")).first()["c"]
    assert [c["feature"] for c in e] == [0, 1, 2] and [c["phi"] for c in e] == [1.0, 1.0, -1.0]
