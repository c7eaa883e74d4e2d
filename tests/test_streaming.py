"""Streaming scoring equals batch scoring (availableNow file stream)."""


import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark):
    s = E.q_streaming_score(spark, SF)
    b = E.q_score_raw(spark, SF)
    assert s.count() == b.count() > 0
    assert s.exceptAll(b).count() == 0


def test_explain_stream(spark):
    from sylva import catalog
    from sylva.streaming.score_stream import explain_stream, run_available_now

    schema = spark.read.parquet(f"{SF}/part.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "part.parquet").parquet(SF)
    out = run_available_now(explain_stream(stream, catalog.model(spark, "m4")).select("p_partkey", "phi"), spark, "explain")
    got = spark.read.parquet(out)
    want = catalog.model(spark, "m4").explain(spark.read.parquet(f"{SF}/part.parquet")).select("p_partkey", "phi")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_checkpoint_dir_is_read_from_session(spark):
    from sylva.session import checkpoint_dir

    got = checkpoint_dir(spark)
    assert got and spark.sparkContext.getCheckpointDir() == got
