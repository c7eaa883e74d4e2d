"""Data preparation (F1-F8) and label checks."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from sylva.operators import sampling as SP

SF = "/root/testdata/sf0.001"


def test_first_n_per_bucket(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("b"))
    got = SP.first_n_per_bucket(df, "b", "k", 3).orderBy("k").collect()
    assert [(r["b"], r["k"]) for r in got] == [(1, 0), (0, 1), (0, 2), (1, 3), (0, 4), (1, 6)]


def test_probe_rows_and_label_count(spark):
    df = spark.range(0, 200).withColumnRenamed("id", "k")
    keys = [r["k"] for r in SP.probe_rows(df, "k", stride=50, ranges=[(3, 5)]).orderBy("k").collect()]
    assert keys == [0, 3, 4, 5, 50, 100, 150]
    lab = spark.createDataFrame([([1, 0, 1, 1],)], "l array<int>")
    assert lab.select(SP.label_count(F.col("l"))).first()[0] == 3


def test_synthetic_rows_are_deterministic(spark):
    a = E.q_synthetic_rows(spark, SF).orderBy("o_orderkey").collect()
    o = spark.read.parquet(f"{SF}/orders.parquet").repartition(7)
    u = {r[0]: round(r[1], 6) for r in o.select("o_orderkey", SP.uniform(F.col("o_orderkey"), 0, E.SYNTHETIC_SEED) * 30.0).collect()}
    assert all(r["slack_days"] == u[r["o_orderkey"]] for r in a)
    assert {r["channel"] for r in a} == set(E.CHANNELS)
    assert {(r["label"], r["label_name"]) for r in a} == {(0, "normal"), (1, "rush")}


def test_rule_ignores_null_conditions(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0)], "k int, x double")
    got = SP.rule_labels(df, [(F.col("x") > 3, 1.0)], 0.5, ("no", "yes")).orderBy("k").collect()
    assert [(r["label"], r["label_name"]) for r in got] == [(0, "no"), (1, "yes")]


def test_multilabel_semantics(spark):
    """Softmax sums to 1, sigmoids are independent, buckets covered."""
    assert {r["model_id"]: r["n_rows"] == r["n_valid"] for r in E.q_probability_checks(spark, SF).collect()} == {"m1": True, "m3": True}
    assert E.q_type_difference(spark, SF).filter("max_diff > 0.001").count() > 0
    assert E.q_label_coverage(spark, SF).first()[0] >= 3
