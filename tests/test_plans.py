"""Physical-plan properties the design relies on (checked with the executed plan text)."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from sylva import catalog
from sylva.operators.sampling import first_n_per_bucket

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hash_shuffles(text: str) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", text))


def test_dense_scoring_has_no_shuffle_and_prunes_scan(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").withColumn("o_month", F.month("o_orderdate"))
    c = spark.read.parquet(f"{SF}/customer.parquet")
    rows = o.join(c, o.o_custkey == c.c_custkey).filter(F.col("o_orderstatus") == "F")
    text = plan(catalog.model(spark, "m1").predict_proba(rows, keep=["o_orderkey"]))
    assert "MapInArrow" in text
    assert hash_shuffles(text) == 0
    assert "EqualTo(o_orderstatus,F)" in text  # filter pushed into the scan
    orders_schema = re.search(r"ReadSchema: (struct<o_orderkey[^ ]*)", text).group(1)
    assert "o_orderpriority" not in orders_schema and "o_totalprice" in orders_schema


def test_relational_scoring_has_one_exchange(spark):
    text = plan(E.q_score_raw_relational(spark, SF))
    assert hash_shuffles(text) == 1
    assert "REPARTITION_BY_NUM" in text  # explicit count, not folded by AQE
    assert text.count("BroadcastHashJoin") >= 2


def test_first_n_per_bucket_limits_before_shuffle(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") % 2).alias("b"))
    text = plan(first_n_per_bucket(df, "b", "k", 3))
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_many_models_dense_has_no_shuffle(spark):
    text = plan(E.q_score_many_models_dense(spark, SF))
    assert hash_shuffles(text) == 0 and text.count("MapInArrow") == 1


def test_raw_and_contributions_come_from_one_step(spark):
    for q in (E.q_shap_additivity, E.q_quantized_drift, E.q_type_difference, E.q_top_class_label):
        text = plan(q(spark, SF))
        assert hash_shuffles(text) == 0 and text.count("MapInArrow") == 1


def test_partitions_grow_with_the_expanded_rows(spark):
    from sylva.operators import score as S

    small = spark.range(1000).select(F.col("id").alias("k"))
    large = spark.range(200_000).select(F.col("id").alias("k"))
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert S.partition_by_keys(small, ["k"], 500).rdd.getNumPartitions() == base
    assert S.partition_by_keys(large, ["k"], 500).rdd.getNumPartitions() == -(-200_000 * 500 // S.EXPANDED_ROWS_PER_TASK) > base
    assert S.partition_by_keys(large.limit(0), ["k"], 500).rdd.getNumPartitions() == base
    assert S.partition_by_keys(large, ["k"], 500, 3).rdd.getNumPartitions() == 3
