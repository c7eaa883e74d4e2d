"""Recorded predictions round trip (A11, A12) and parity against them (G1)."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from sylva import catalog
from sylva.operators.checks import parity_report
from sylva.sources.recorded import read_recorded, write_recorded


def test_recorded_roundtrip_and_parity(spark):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet").orderBy("p_partkey").limit(15)
    m = catalog.model(spark, "m4")
    scored = m.raw(part).select("p_partkey", "p_size", "p_retailprice", "raw").collect()
    doc = {
        "model": "m4",
        "float_features_count": 2,
        "dimensions_count": 1,
        "rows": [{"features": [r["p_size"], r["p_retailprice"]], "raw": r["raw"]} for r in scored],
    }
    folder = tempfile.mkdtemp(prefix="sylva-rec-")
    path = os.path.join(folder, "m4_reference.json")
    with open(path, "w") as fh:
        json.dump(doc, fh, indent=2)
    header, rows = read_recorded(spark, path)
    assert header.first()["dimensions_count"] == 1
    assert rows.count() == 15
    # re-score the recorded features positionally and compare within 1e-6
    again = m.raw(rows, features="features", out_col="again")
    a = again.select("row_idx", F.posexplode("again").alias("class_idx", "v"))
    b = rows.select("row_idx", F.posexplode("raw").alias("class_idx", "v"))
    rep = parity_report(a, b, ["row_idx", "class_idx"], "v").first()
    assert rep["n_rows"] == 15 and rep["over_tolerance"] == 0 and rep["only_left"] == 0 and rep["only_right"] == 0
    out = os.path.join(folder, "lines")
    write_recorded(rows.select("row_idx", "features", "raw"), out, {"model": "m4"})
    h2, r2 = read_recorded(spark, out, lines=True)
    assert h2.first()["h_model"] == "m4" and r2.count() == 15
