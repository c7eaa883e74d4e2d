"""The compact sidecar format."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from sylva import catalog
from sylva.operators import explain as X
from sylva.operators.treeshap import bias_row, quantize_float16, shap_table
from sylva.sources import sidecar as SC


def test_record_size_formula():
    # D=6, K=5: 6 + 24 + 6 + 1 + 1 + 64*6*5*2 = 3878 raw bytes -> 3880 aligned
    assert SC.record_dtype(6, 5).itemsize == 3880
    assert SC.header_size(5) == 56


def test_pack_guards():
    feats = np.zeros((1, 2), dtype=np.int64)
    borders = np.zeros((1, 2), dtype=np.float32)
    phi = np.zeros((1, 4, 2, 1))
    with pytest.raises(ValueError, match="above 255"):
        SC.pack(feats, borders, [np.array([0], np.uint8)], phi, np.zeros(1), 300)
    with pytest.raises(ValueError, match="float16"):
        SC.pack(feats, borders, [np.array([0], np.uint8)], phi + 1e6, np.zeros(1), 2)
    data = SC.pack(feats, borders, [np.array([0], np.uint8)], phi, np.zeros(1), 2)
    assert SC.unpack(data)["n_trees"] == 1
    with pytest.raises(SC.FormatError, match="MAGIC"):
        SC.unpack(b"X" * 64)
    bad_version = data[:8] + np.array([2], "<u4").tobytes() + data[12:]
    with pytest.raises(SC.FormatError, match="VERSION"):
        SC.unpack(bad_version)
    with pytest.raises(SC.FormatError, match="CUT"):
        SC.unpack(data[:-3])
    with pytest.raises(SC.FormatError, match="SHORT"):
        SC.unpack(SC.MAGIC[:6])


def test_roundtrip_and_explain(spark, tables, orders):
    one = tables.only("m1", "m4")
    out = tempfile.mkdtemp(prefix="sylva-sc-")
    written = SC.write_sidecar_files(SC.pack_sidecars(one, shap_table(one), bias_row(one)), out).collect()
    assert sorted(r["model_id"] for r in written) == ["m1", "m4"]
    with open(os.path.join(out, "junk.sidecar"), "wb") as fh:
        fh.write(b"not a sidecar file at all, but long enough for a header")
    st = SC.read_sidecars(spark, out)
    assert {r["model_id"]: r["reason"] for r in st.rejected.collect()}["junk"].startswith("[MAGIC]")
    q = quantize_float16(shap_table(tables.only("m1"))).select("tree", "leaf", "feature", F.col("phi").alias("q"))
    j = st.shap.filter("model_id = 'm1'").join(q, ["tree", "leaf", "feature"], "full_outer")
    assert j.filter(F.col("phi").isNull() | F.col("q").isNull() | (F.col("phi") != F.col("q"))).count() == 0
    assert all(SC.compatibility(st, tables).select(F.collect_list("compatible")).first()[0])
    # sidecar explanation equals the quantised-table explanation
    ex = X.sidecar_explainer(st, tables, "m1")
    a = X.phi_dense(orders, ex).select("o_orderkey", F.col("phi").alias("a"))
    b = catalog.model(spark, "m1").explain(orders, quantize="float16").select("o_orderkey", F.col("phi").alias("b"))
    rows = a.join(b, "o_orderkey").collect()
    assert rows and all(np.allclose(r["a"], r["b"], atol=1e-12) for r in rows)
    # a sidecar paired with the wrong model is refused
    wrong = SC.SidecarTables(st.headers.withColumn("model_id", F.lit("m5")), st.splits, st.shap, st.rejected)
    with pytest.raises(ValueError, match="does not match"):
        X.sidecar_explainer(wrong, tables, "m5")


def test_export_from_model_documents(spark):
    import shutil

    from sylva.fixtures import model_path

    folder = tempfile.mkdtemp(prefix="sylva-export-")
    for mid in ("m4", "m5"):
        shutil.copy(model_path(mid), folder)
    written = {r["model_id"]: r for r in SC.export_sidecars(spark, folder).collect()}
    assert set(written) == {"m4", "m5"}
    assert written["m4"]["path"].endswith("m4.shap.sidecar")
    st = SC.read_sidecars(spark, folder)
    h = {r["model_id"]: r for r in st.headers.collect()}
    assert h["m5"]["n_classes"] == 2 and h["m5"]["n_trees"] == 20 and h["m5"]["depth"] == 3


def test_table_route(spark, tables):
    one = tables.only("m4")
    st = SC.read_sidecar_table(SC.pack_sidecars(one, shap_table(one), bias_row(one)))
    assert st.headers.first()["n_trees"] == 20 and st.rejected.count() == 0


def test_data_source_writes_all_or_nothing(spark, tmp_path):
    from sylva.sources import sidecar_files as SF

    SF.register(spark)
    rows = spark.createDataFrame([("a", bytearray(b"one"), 1), ("b", bytearray(b"two"), 2)], "model_id string, sidecar binary, n long").repartition(2)
    out = tmp_path / "files"
    for target in (str(out), f"file:{out}", f"file://{out}"):  # a file of the same name is replaced
        rows.write.format(SF.NAME).mode("append").save(target)
    assert sorted(p.name for p in out.iterdir()) in (["_temporary", "a.sidecar", "b.sidecar"], ["a.sidecar", "b.sidecar"])
    assert not any((out / "_temporary").glob("*"))
    got = spark.read.format(SF.NAME).load(str(out)).collect()
    assert sorted((r["model_id"], bytes(r["content"])) for r in got) == [("a", b"one"), ("b", b"two")]
    bad = rows.withColumn("sidecar", F.when(F.col("model_id") == "b", F.raise_error(F.lit("broken off")).cast("binary")).otherwise(F.col("sidecar")))
    twice = rows.withColumn("model_id", F.lit("same"))
    for frame in (bad, twice, rows.withColumn("model_id", F.lit("x/y")), rows.drop("sidecar")):
        gone = tmp_path / "aborted"
        with pytest.raises(Exception):
            frame.write.format(SF.NAME).mode("append").save(str(gone))
        assert not [p for p in gone.rglob("*") if p.is_file()]
    with pytest.raises(Exception, match="append"):
        rows.write.format(SF.NAME).mode("overwrite").save(str(out))


def test_a_task_that_outlives_its_job_leaves_no_file(tmp_path):
    from pyspark.sql import Row
    from pyspark.sql import types as T

    from sylva.sources import sidecar_files as SF

    schema = T.StructType([T.StructField("model_id", T.StringType()), T.StructField("sidecar", T.BinaryType())])
    rows = [Row(model_id="a", sidecar=b"one"), Row(model_id="b", sidecar=b"two")]
    writer = SF._Writer(str(tmp_path / "out"), ".sidecar", schema)
    writer.abort([])
    with pytest.raises(OSError):
        writer.write(iter(rows))
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]
    writer = SF._Writer(str(tmp_path / "out"), ".sidecar", schema)
    writer.commit([writer.write(iter(rows[:1])), writer.write(iter(rows[1:])), writer.write(iter([]))])
    assert {p.name: p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()} == {"a.sidecar": b"one", "b.sidecar": b"two"}


def test_attach_at_load_and_share(spark, tables, orders, tmp_path):
    """A model loaded with a sidecar explains by it; other models may share the file."""
    from sylva.fixtures import model_path
    from sylva.plans.model import Model

    one = tables.only("m1")
    SC.write_sidecar_files(SC.pack_sidecars(one, shap_table(one), bias_row(one)), str(tmp_path))
    want = {r["o_orderkey"]: r["phi"] for r in catalog.model(spark, "m1").explain(orders, quantize="float16").collect()}
    plain = Model.load(spark, model_path("m1"))
    assert not plain.has_explainer()
    for place in (str(tmp_path), str(tmp_path / "m1.sidecar")):
        m = Model.load(spark, model_path("m1i"), sidecar=place)
        assert m.has_explainer() and m.attached.shap_id == "m1"
    got = m.explain(orders, raw_col="raw").collect()
    assert all(np.allclose(r["phi"], want[r["o_orderkey"]], atol=1e-12) for r in got)
    assert [e["class"] for e in got[0]["explanation"]] == ["0", "1", "2"]
    m.attach(SC.read_sidecars(spark, str(tmp_path)), "m1", ["a", "b", "c", "d"], ["x", "y", "z"])
    e = m.explain(orders.limit(1)).first()["explanation"][0]
    assert e["class"] == "x" and {c["name"] for c in e["contributions"]} == {"a", "b", "c", "d"}
    relational = {r["o_orderkey"]: r["phi"] for r in m.explain(orders, plan="relational", keys=["o_orderkey"]).select("o_orderkey", "phi").collect()}
    assert all(np.allclose(relational[k], want[k], atol=1e-12) for k in want)
    with pytest.raises(ValueError, match="FEATURES"):
        Model.load(spark, model_path("m4"), sidecar=str(tmp_path))
    with pytest.raises(ValueError, match="where the table has"):
        m.attach(SC.read_sidecars(spark, str(tmp_path)), "m1", ["a"])
    (tmp_path / "junk").mkdir()
    (tmp_path / "junk" / "x.sidecar").write_bytes(b"short")
    with pytest.raises(ValueError, match="no sidecar.*SHORT"):
        Model.load(spark, model_path("m1"), sidecar=str(tmp_path / "junk"))


def test_sharing_walks_the_table_once(spark):
    import __spark_entry__ as E

    df = E.q_shared_sidecar_explain(spark, "/root/testdata/sf0.001")
    assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
