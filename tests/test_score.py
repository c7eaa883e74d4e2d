"""Scoring and links against a plain-Python tree walk."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import doc, walk
from sylva import catalog
from sylva.functions import links
from sylva.plans.model import score_many

SF = "/root/testdata/sf0.001"


def _rows(df, key, col):
    return {r[key]: r[col] for r in df.select(key, col).collect()}


def test_dense_matches_python_walk(spark, orders):
    m = catalog.model(spark, "m1")
    got = _rows(m.raw(orders), "o_orderkey", "raw")
    src = orders.collect()
    assert len(got) == len(src) > 0
    for r in src[:300]:
        want = walk("m1", [r["o_totalprice"], r["c_acctbal"], r["c_nationkey"], r["o_month"]])
        assert np.allclose(got[r["o_orderkey"]], want, rtol=0, atol=1e-12)


def test_categorical_matches_python_walk(spark, orders):
    m = catalog.model(spark, "m2")
    got = _rows(m.raw(orders), "o_orderkey", "raw")
    for r in orders.collect()[:300]:
        want = walk("m2", [r["o_totalprice"], r["c_acctbal"]], [r["o_orderpriority"], r["c_mktsegment"]])
        assert np.allclose(got[r["o_orderkey"]], want, rtol=0, atol=1e-12)


def test_relational_equals_dense(spark, orders, tables):
    long = score_many(orders, tables, ["m1", "m2"], ["o_orderkey"])
    m1 = catalog.model(spark, "m1").raw(orders).select("o_orderkey", F.posexplode("raw").alias("class_idx", "raw"))
    rel = long.filter("model_id = 'm1'").select("o_orderkey", "class_idx", F.col("raw").alias("r2"))
    j = m1.join(rel, ["o_orderkey", "class_idx"], "full_outer")
    assert j.filter(F.col("raw").isNull() | F.col("r2").isNull() | (F.col("raw") != F.col("r2"))).count() == 0
    nested = catalog.model(spark, "m2").raw(orders, plan="relational", keys=["o_orderkey"])
    dense = catalog.model(spark, "m2").raw(orders).withColumnRenamed("raw", "d")
    assert nested.join(dense.select("o_orderkey", "d"), "o_orderkey").filter("raw != d").count() == 0


def test_strict_border_and_float32(spark):
    """X equal to a float32 border goes left; doubles are narrowed first."""
    m = catalog.model(spark, "m4")
    first = doc("m4")["oblivious_trees"][0]["splits"][0]
    f0 = first["float_feature_index"]
    b = float(np.float32(first["border"]))
    vals = [b, float(np.nextafter(np.float32(b), np.float32(np.inf))), b + 1e-9]
    rows = []
    for i, v in enumerate(vals):
        x = [450.0, 950.0]
        x[f0] = v
        rows.append((i, x[0], x[1]))
    df = spark.createDataFrame(rows, "k long, p_size double, p_retailprice double")
    leaves = _rows(m.leaf_index(df), "k", "leaves")
    assert leaves[0][0] & 1 == 0  # equal -> not greater
    assert leaves[1][0] & 1 == 1
    assert leaves[2][0] & 1 == leaves[0][0] & 1  # b + 1e-9 narrows back to b


def test_null_and_nan_modes(spark):
    m = catalog.model(spark, "m4")
    df = spark.createDataFrame(
        [(1, None, 950.0), (2, float("nan"), 950.0), (3, 0.0, 950.0)], "k long, p_size double, p_retailprice double"
    )
    zero = _rows(m.raw(df), "k", "raw")
    assert zero[1] == zero[3]  # null -> 0.0
    assert np.allclose(zero[2], walk("m4", [float("nan"), 950.0]))  # NaN -> bit 0
    nan_max = _rows(m.raw(df, nan_mode="max"), "k", "raw")
    assert np.allclose(nan_max[2], walk("m4", [float("nan"), 950.0], nan_bit=1))
    with pytest.raises(Exception, match="null value"):
        m.raw(df, null_mode="error").collect()
    with pytest.raises(Exception, match="NaN value"):
        m.raw(df, nan_mode="error").collect()


def test_input_forms_agree(spark):
    """C1 named, C2 map, C5 positional give the same scores."""
    m = catalog.model(spark, "m4")
    part = spark.read.parquet(f"{SF}/part.parquet")
    named = _rows(m.raw(part), "p_partkey", "raw")
    mapped = part.select("p_partkey", F.create_map(F.lit("p_size"), F.col("p_size").cast("double"), F.lit("p_retailprice"), "p_retailprice").alias("r"))
    pos = part.select("p_partkey", F.array(F.col("p_size").cast("double"), "p_retailprice").alias("x"))
    assert _rows(m.raw(mapped, row_map="r"), "p_partkey", "raw") == named
    assert _rows(m.raw(pos, features="x"), "p_partkey", "raw") == named


def test_input_errors(spark):
    m = catalog.model(spark, "m4")
    part = spark.read.parquet(f"{SF}/part.parquet")
    with pytest.raises(KeyError, match="the float feature 'p_size' has no column"):
        m.raw(part.drop("p_size"))
    with pytest.raises(ValueError, match="is no feature of the model"):
        m.raw(part.select("p_size", "p_retailprice", "p_name"), strict=True)
    with pytest.raises(TypeError, match="non-numeric"):
        m.raw(part.withColumn("p_size", F.lit("hello")))
    short = part.select("p_partkey", F.array(F.col("p_size").cast("double")).alias("x"))
    with pytest.raises(Exception, match="row holds 1 float values where the model takes 2"):
        m.raw(short, features="x").collect()
    extra = part.select("p_partkey", F.create_map(F.lit("p_size"), F.lit(1.0), F.lit("p_retailprice"), F.lit(2.0), F.lit("bogus"), F.lit(3.0)).alias("r"))
    with pytest.raises(Exception, match="does not know: bogus"):
        m.raw(extra, row_map="r").collect()
    missing = part.select("p_partkey", F.create_map(F.lit("p_size"), F.lit(1.0)).alias("r"))
    with pytest.raises(Exception, match="lacks feature p_retailprice"):
        m.raw(missing, row_map="r").collect()
    with pytest.raises(ValueError, match="cat_features must be provided"):
        catalog.model(spark, "m2").raw(part.select(F.array(F.lit(1.0), F.lit(2.0)).alias("x")), features="x")


def test_prediction_types(spark):
    assert links.resolve_prediction_type("Probability") == "probability"
    assert links.resolve_prediction_type("raw_formula_val") == "raw_formula_val"
    with pytest.raises(ValueError, match="there is no prediction type"):
        links.resolve_prediction_type("Bogus")
    with pytest.raises(TypeError):
        links.resolve_prediction_type(3)
    m3 = catalog.model(spark, "m3")
    emb = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", F.col("embedding").alias("x"))
    with pytest.raises(ValueError, match="not defined for MultiLogloss"):
        m3.predict(emb, "log_probability", features="x")
    with pytest.raises(ValueError, match="2-dimensional"):
        catalog.model(spark, "m1").predict(emb, "rmse_with_uncertainty")
    with pytest.raises(TypeError, match="always returns"):
        m3.predict_proba(emb, features="x", prediction_type="raw_formula_val")
    assert links.output_dims("class", 3, "MultiClass") == 1
    assert links.output_dims("class", 4, "MultiLogloss") == 4


def test_link_values(spark):
    raw = [[2.0, 0.0, -1.0], [0.5, 0.5, 0.5]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "k int, raw array<double>")
    out = df.select(
        "k",
        links.apply_link(F.col("raw"), "probability", 3).alias("p"),
        links.apply_link(F.col("raw"), "multi_probability", 3).alias("mp"),
        links.apply_link(F.col("raw"), "class", 3).alias("c"),
        links.apply_link(F.col("raw"), "log_probability", 3).alias("lp"),
        links.apply_link(F.col("raw"), "exponent", 3).alias("e"),
    ).orderBy("k").collect()
    e = np.exp(np.array(raw[0]) - 2.0)
    assert np.allclose(out[0]["p"], e / e.sum())
    assert np.allclose(out[0]["mp"], 1 / (1 + np.exp(-np.array(raw[0]))))
    assert out[0]["c"] == [0.0] and out[1]["c"] == [0.0]  # ties -> first index
    assert np.allclose(out[0]["lp"], np.log(e / e.sum()))
    assert np.allclose(out[0]["e"], np.exp(raw[0]))
    b = spark.createDataFrame([([0.3],), ([-0.2],)], "raw array<double>")
    res = b.select(
        links.apply_link(F.col("raw"), "probability", 1).alias("p"),
        links.apply_link(F.col("raw"), "class", 1).alias("c"),
        links.expand_binary(links.apply_link(F.col("raw"), "probability", 1)).alias("pp"),
    ).collect()
    assert math.isclose(res[0]["p"][0], 1 / (1 + math.exp(-0.3)))
    assert res[0]["c"] == [1.0] and res[1]["c"] == [0.0]
    assert math.isclose(sum(res[0]["pp"]), 1.0)
    u = spark.createDataFrame([([1.0, 0.25],)], "raw array<double>")
    assert np.allclose(u.select(links.apply_link(F.col("raw"), "rmse_with_uncertainty", 2)).first()[0], [1.0, math.exp(0.5)])


def test_empty_input_gives_empty_output(spark, orders):
    m = catalog.model(spark, "m1")
    assert m.raw(orders.limit(0)).count() == 0


def test_sql_function(spark, orders):
    m = catalog.model(spark, "m1")
    m.register_udf(spark, "score_m1_proba", "probability")
    orders.createOrReplaceTempView("t_orders")
    got = _rows(spark.sql("SELECT o_orderkey, score_m1_proba(o_totalprice, c_acctbal, c_nationkey, o_month) AS p FROM t_orders"), "o_orderkey", "p")
    want = _rows(m.predict_proba(orders), "o_orderkey", "prediction")
    assert got.keys() == want.keys()
    assert all(np.allclose(got[k], want[k], atol=1e-12) for k in got)


def test_many_models_dense_equals_relational(spark, orders, tables):
    from sylva.plans.model import score_many_dense

    a = score_many_dense(orders, tables, ["m1", "m2"], ["o_orderkey"])
    b = score_many(orders, tables, ["m1", "m2"], ["o_orderkey"]).withColumnRenamed("raw", "r2")
    j = a.join(b, ["model_id", "o_orderkey", "class_idx"], "full_outer")
    assert j.count() == orders.count() * 4
    assert j.filter(F.col("raw").isNull() | F.col("r2").isNull() | (F.col("raw") != F.col("r2"))).count() == 0


def test_explain_map_ignores_unknown_keys(spark):
    m = catalog.model(spark, "m4")
    part = spark.read.parquet(f"{SF}/part.parquet")
    mapped = part.select(
        "p_partkey",
        F.create_map(F.lit("p_size"), F.col("p_size").cast("double"), F.lit("p_retailprice"), "p_retailprice", F.lit("extra"), F.lit(1.0)).alias("r"),
    )
    a = _rows(m.explain(mapped, row_map="r"), "p_partkey", "phi")
    b = _rows(m.explain(part), "p_partkey", "phi")
    assert a == b
    with pytest.raises(Exception, match="does not know: extra"):
        m.raw(mapped, row_map="r").collect()


def test_batches_are_taken_in_pieces(spark, orders, monkeypatch):
    """Row pieces inside a batch give the same scores as one pass, whatever the budgets."""
    from sylva.operators import kernel as K

    m = catalog.model(spark, "m1")
    walk = m._own_walk(list(range(4)), "raw", "leaves", {})
    x = np.random.default_rng(0).uniform(-1000, 500000, size=(2000, 4)).astype(np.float32)
    whole = K.run_walk(walk, x)
    monkeypatch.setattr(K, "INDEX_BUDGET", 5000)  # two trees at a time
    for got, want in zip(K.run_walk(walk, x), whole):
        assert np.array_equal(got, want)
    assert np.array_equal(np.vstack([K.run_walk(walk, x[i : i + 7])[0] for i in range(0, 2000, 7)]), whole[0])


def _bits(values):
    return {k: np.asarray(v, dtype=np.float64).tobytes() for k, v in values.items()}


@pytest.mark.parametrize("mid", ["m1", "m2"])
def test_scores_do_not_depend_on_the_block_size(spark, orders, tables, monkeypatch, mid):
    """Bits equal with 16M and with 64 values a block, on every surface; inexact leaf values."""
    import json

    from sylva.plans import compiled as C
    from sylva.plans.model import Model, score_many_dense
    from sylva.sources.model_docs import load_model_texts

    d = json.loads(json.dumps(doc(mid)))
    d["oblivious_trees"] = d["oblivious_trees"][:9]
    rng = np.random.default_rng(7)
    for tree in d["oblivious_trees"]:
        tree["leaf_values"] = [v * float(rng.uniform(0.9, 1.1)) for v in tree["leaf_values"]]
    texts = load_model_texts(spark, {mid: json.dumps(d)}).cache()
    names = [f["feature_id"] for kind in ("float_features", "categorical_features") for f in d["features_info"].get(kind) or []]

    def surfaces():
        m = Model(texts, mid)
        out = {"raw": _bits(_rows(m.raw(orders), "o_orderkey", "raw")), "leaves": _bits(_rows(m.leaf_index(orders), "o_orderkey", "leaves"))}
        name = m.register_udf(spark, f"blocks_{mid}")
        orders.createOrReplaceTempView("block_orders")
        out["sql"] = _bits(_rows(spark.sql(f"SELECT o_orderkey, {name}({', '.join(names)}) AS r FROM block_orders"), "o_orderkey", "r"))
        many = score_many_dense(orders, texts, [mid], ["o_orderkey"]).groupBy("o_orderkey").agg(F.array_sort(F.collect_list("raw")).alias("r"))
        out["many"] = _bits(_rows(many, "o_orderkey", "r"))
        if not m.header.n_cat:
            ex = m.explain(orders, raw_col="raw").cache()
            out["phi"], out["with raw"] = _bits(_rows(ex, "o_orderkey", "phi")), _bits(_rows(ex, "o_orderkey", "raw"))
            assert out["with raw"] == out["raw"]
            out["float16"] = _bits(_rows(m.explain(orders, quantize="float16"), "o_orderkey", "phi"))
        relational = _rows(m.raw(orders, plan="relational", keys=["o_orderkey"]), "o_orderkey", "raw")
        return out, relational

    big, rel_big = surfaces()
    monkeypatch.setattr(C, "BLOCK_VALUES", 64)  # one to four trees a block
    small, rel_small = surfaces()
    assert big == small and big["raw"] == big["sql"]
    assert rel_big.keys() == rel_small.keys()  # sums of a shuffle come in any order
    assert all(np.allclose(rel_big[k], rel_small[k], rtol=0, atol=1e-12) for k in rel_big)


def test_blocks_are_let_go_one_after_another(spark, tables, monkeypatch):
    from sylva.operators import kernel as K
    from sylva.plans import compiled as C
    from sylva.plans.model import Model

    monkeypatch.setattr(C, "BLOCK_VALUES", 200)
    walk = Model(tables, "m1")._own_walk(list(range(4)), "raw", None, {})
    assert len(walk.blocks) > 5
    for block in K._blocks(walk):
        assert block["leaves"].size <= 200 and sum("_value" in b.__dict__ for b in walk.blocks) <= 1
    assert not any("_value" in b.__dict__ for b in walk.blocks)


def test_wide_model_within_fixed_memory(spark):
    """5,000 features: pieces keep rows x features x classes within the budget; one Python step."""
    import json

    from sylva.operators import kernel as K
    from sylva.plans.model import Model

    n_f, k = 5000, 2
    rng = np.random.default_rng(3)
    trees = [
        {
            "splits": [{"float_feature_index": int(f), "border": 0.5} for f in rng.choice(n_f, 2, replace=False)],
            "leaf_values": (rng.integers(-64, 64, 4 * k) / 64).tolist(),
            "leaf_weights": [1.0, 2.0, 3.0, 4.0],
        }
        for _ in range(30)
    ]
    text = json.dumps({"features_info": {"float_features": [{"feature_id": f"w{i}"} for i in range(n_f)]}, "oblivious_trees": trees, "scale_and_bias": [1.0, [0.0] * k]})
    m = Model.from_text(spark, text, "wide")
    rows = spark.range(40).select("id", F.transform(F.sequence(F.lit(1), F.lit(n_f)), lambda i: (F.hash(i, "id") % 2).cast("float")).alias("x"))
    out = m.walk(rows, raw="raw", phis={"phi": None}, features="x", keep=["id"])
    walk = m._walks(list(range(n_f)), "raw", None, {"phi": m.explainer()})[0]
    assert K.OUTPUT_BUDGET // walk.width() * n_f * k * 2 <= K.OUTPUT_BUDGET  # two copies of the accumulator
    bias = m.explainer().bias
    got = out.select("raw", F.transform("phi", lambda p: F.aggregate(p, F.lit(0.0), lambda a, v: a + v)).alias("s"), F.size(F.col("phi")[0]).alias("f")).collect()
    assert len(got) == 40 and all(r["f"] == n_f and np.allclose(np.add(r["s"], bias), r["raw"], atol=1e-9) for r in got)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_large_statistic_with_a_hot_category(spark):
    """D12 above the broadcast bound: right for seen, frequent and unseen categories, no hot partition."""
    from sylva.functions.features import lookup_stat

    stats = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") / 8).alias("value"))
    bomb = spark.range(10).select(F.raise_error(F.lit("was run")).cast("string").alias("c"))
    lookup_stat(bomb, "c", stats, 5000, "s", -1.0, bound=100)  # planning runs nothing
    kind = F.when(F.col("id") % 2 == 0, "k7").when(F.col("id") % 3 == 0, "nobody").otherwise(F.concat(F.lit("k"), F.col("id") % 6000))
    rows = spark.range(0, 60000, 1, 6).select("id", kind.alias("c"))
    broadcast = lookup_stat(rows, "c", stats, 5000, "s", -1.0)
    split = lookup_stat(rows, "c", stats, 5000, "s", -1.0, bound=100)
    assert split.columns == broadcast.columns
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, broadcast.collect()))
    text = split._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sizes = [r["n"] for r in lookup_stat(rows, "c", stats, 5000, "s", -1.0, bound=100).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(sizes) == 8 and max(sizes) <= 2 * sorted(sizes)[4]
