"""Model documents as tables: loading, rejection, metadata."""

import json

import pytest
from pyspark.sql import functions as F

from sylva.fixtures import model_path, model_text
from sylva.operators import metadata as MD
from sylva.plans.model import Model
from sylva.sources.model_docs import load_model_texts, load_models


def test_tables_shapes(tables):
    m = {r["model_id"]: r for r in tables.models.collect()}
    assert m["m1"]["n_trees"] == 50 and m["m1"]["dims"] == 3 and m["m1"]["n_float"] == 4
    assert m["m2"]["n_cat"] == 2 and m["m2"]["dims"] == 1
    assert m["m4"]["scale"] == 0.5 and m["m4"]["bias"] == [1.5]
    assert tables.splits.filter("model_id = 'm1'").count() == 50 * 4
    assert tables.leaves.filter("model_id = 'm3'").count() == 60 * 16
    # leaf values are sliced leaf-major: K values per leaf
    assert tables.leaves.filter("model_id = 'm1'").select(F.min(F.size("values"))).first()[0] == 3


def test_load_from_path(spark):
    t = load_models(spark, [model_path("m4"), model_path("m5")])
    assert sorted(r["model_id"] for r in t.models.collect()) == ["m4", "m5"]
    m = Model.load(spark, model_path("m4"))
    assert m.header.summary() == "trees=20 floats=2 cats=0 dim=1"


def test_rejects_bad_documents(spark):
    good = json.loads(model_text("m4"))
    uneven = json.loads(model_text("m4"))
    uneven["oblivious_trees"][3]["leaf_values"] = uneven["oblivious_trees"][3]["leaf_values"][:-1]
    bad_index = json.loads(model_text("m4"))
    bad_index["oblivious_trees"][0]["splits"][0]["float_feature_index"] = 9
    bad_bias = json.loads(model_text("m4"))
    bad_bias["scale_and_bias"] = [1.0, [0.0, 1.0]]
    docs = {
        "good": json.dumps(good),
        "garbage": "\x00\x01not json at all",
        "truncated": model_text("m4")[:500],
        "empty": json.dumps({"oblivious_trees": [], "scale_and_bias": [1, [0]]}),
        "uneven": json.dumps(uneven),
        "bad_index": json.dumps(bad_index),
        "bad_bias": json.dumps(bad_bias),
    }
    t = load_model_texts(spark, docs)
    assert [r["model_id"] for r in t.models.collect()] == ["good"]
    reasons = {r["model_id"]: r["reason"] for r in t.rejected.collect()}
    assert reasons["garbage"] == "unparseable document"
    assert reasons["truncated"] == "unparseable document"
    assert reasons["empty"] == "model has no trees"
    assert "2^depth" in reasons["uneven"]
    assert "unknown feature" in reasons["bad_index"]
    assert "bias size" in reasons["bad_bias"]
    with pytest.raises(Exception, match="cannot load model"):
        load_model_texts(spark, {"garbage": "{"}, on_error="raise").models.collect()


def test_unnamed_features_get_positions(tables):
    names = [r["name"] for r in tables.features.filter("model_id = 'm3'").orderBy("position").collect()]
    assert names == [str(i) for i in range(64)]


def test_summary_and_listing(tables):
    s = {r["model_id"]: r for r in MD.model_summary(tables).collect()}
    assert s["m1"]["summary"] == "trees=50 floats=4 cats=0 dim=3"
    assert s["m2"]["summary"] == "trees=80 floats=2 cats=2 dim=1"
    f = {r["model_id"]: r for r in MD.feature_listing(tables).collect()}
    assert f["m2"]["float_names"] == ["o_totalprice", "c_acctbal"]
    assert f["m2"]["cat_names"] == ["o_orderpriority", "c_mktsegment"]
    assert f["m2"]["all_names"] == ["o_totalprice", "c_acctbal", "o_orderpriority", "c_mktsegment"]
    assert f["m1"]["named"] is True and f["m3"]["named"] is False


def test_metadata_lookup(tables, spark):
    rows = {r["model_id"]: r for r in MD.metadata_lookup(tables, ["model_guid", "empty_key", "nope"]).collect()}
    m1 = rows["m1"]
    assert m1["model_guid"] == "iris-like-0001"
    assert m1["empty_key"] is None and m1["has_empty_key"] is True  # empty reads as absent
    assert m1["nope"] is None and m1["has_nope"] is False
    assert m1["class_names"] == ["F", "O", "P"] and m1["label_kind"] == "string"
    assert rows["m1i"]["class_names"] == ["0", "1", "2"] and rows["m1i"]["label_kind"] == "int"
    assert rows["m4"]["class_names"] is None and rows["m4"]["labels"] == ["0"]
    # binary model: 2 names, 1 dimension -> indexes
    assert rows["m2"]["labels"] == ["0"]
    bad = spark.createDataFrame([({"class_params": "{not json"},)], "metadata map<string,string>")
    with pytest.raises(Exception, match="malformed class_params"):
        bad.select(MD.class_names(F.col("metadata"))).collect()


def test_missing_path_fails(spark):
    with pytest.raises(Exception, match="(?i)path does not exist|PATH_NOT_FOUND"):
        Model.load(spark, "/nonexistent/model.json")


def test_rejections_carry_a_code(spark):
    import json

    from helpers import doc
    from sylva.sources.model_docs import REASONS, load_model_texts

    def broken(mid, change):
        d = json.loads(json.dumps(doc(mid)))
        change(d)
        return json.dumps(d)

    onehot = lambda d: next(s for t in d["oblivious_trees"] for s in t["splits"] if s.get("split_type") == "onehot")
    stat = lambda d: next(s for t in d["oblivious_trees"] for s in t["splits"] if s.get("split_type") == "target_stat")
    docs = {
        "UNPARSEABLE": "{",
        "NO_TREES": broken("m4", lambda d: d.update(oblivious_trees=[])),
        "LEAF_SHAPE": broken("m4", lambda d: d["oblivious_trees"][1]["leaf_weights"].pop()),
        "HASHED_ONEHOT": broken("m2", lambda d: onehot(d).update(split_type="OneHotFeature")),
        "BAD_SPLIT": broken("m4", lambda d: d["oblivious_trees"][0]["splits"][0].update(float_feature_index=99)),
        "BARE_SPLIT": broken("m2", lambda d: onehot(d).pop("value")),
        "BIAS_SHAPE": broken("m4", lambda d: d["scale_and_bias"][1].append(0.0)),
        "stat": broken("m2", lambda d: stat(d).pop("stat_id")),
    }
    got = {r["model_id"]: (r["code"], r["reason"]) for r in load_model_texts(spark, docs).rejected.collect()}
    assert got == {k: (c, REASONS[c]) for k in docs for c in [k if k in REASONS else "BARE_SPLIT"]}


def test_rows_get_scores_or_reasons_where_no_document_is_good(spark):
    from sylva.plans.model import score_wanted
    from sylva.sources.model_docs import load_model_texts

    rows = spark.createDataFrame([(1, "cut"), (2, "who"), (3, None)], "k int, wanted string")
    got = score_wanted(rows, load_model_texts(spark, {"cut": "{"}), "wanted").collect()
    assert sorted((r["k"], r["raw"], r["code"]) for r in got) == [(1, None, "UNPARSEABLE"), (2, None, "NO_MODEL"), (3, None, "NO_NAME")]
