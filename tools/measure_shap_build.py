"""Measure SHAP-table build time and storage for a model of a given shape.

SURVEY §6 comparison points: E6 build time for 785 trees, depth 6, K=5; the
SHAP table's size as Parquet and as a compact sidecar. The model is drawn
from a seeded generator (31 float features); nothing is trained.

Usage: python tools/measure_shap_build.py [trees] [depth] [classes] [cores]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from sylva.operators.treeshap import bias_row, shap_table  # noqa: E402
from sylva.sources import sidecar as SC  # noqa: E402
from sylva.sources.model_docs import load_model_texts  # noqa: E402


def model_doc(trees: int, depth: int, k: int, n_features: int = 31, seed: int = 7) -> str:
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        feats = rng.choice(n_features, size=depth, replace=True)
        out.append(
            {
                "splits": [{"float_feature_index": int(f), "border": float(np.float32(rng.normal()))} for f in feats],
                "leaf_values": (rng.integers(-1024, 1025, size=(1 << depth) * k) / 1024.0).tolist(),
                "leaf_weights": rng.integers(0, 50, size=1 << depth).astype(float).tolist(),
            }
        )
    return json.dumps(
        {
            "features_info": {"float_features": [{"feature_id": f"f{i}"} for i in range(n_features)]},
            "oblivious_trees": out,
            "scale_and_bias": [1.0, [0.0] * k],
        }
    )


def folder_bytes(path: str) -> int:
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if not f.startswith("."))


def main() -> None:
    trees, depth, k = (int(a) for a in (sys.argv[1:4] + ["785", "6", "5"][len(sys.argv[1:4]) :]))
    cores = sys.argv[4] if len(sys.argv) > 4 else "8"
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = load_model_texts(spark, {"big": model_doc(trees, depth, k)}).cache()
    tables.leaves.count()
    out = tempfile.mkdtemp(prefix="sylva-measure-")
    t0 = time.perf_counter()
    st = shap_table(tables)
    st.write.mode("overwrite").parquet(os.path.join(out, "shap"))
    build = time.perf_counter() - t0
    t0 = time.perf_counter()
    SC.write_sidecar_files(SC.pack_sidecars(tables, spark.read.parquet(os.path.join(out, "shap")), bias_row(tables)), os.path.join(out, "sc")).collect()
    pack = time.perf_counter() - t0
    print(
        json.dumps(
            {
                "trees": trees,
                "depth": depth,
                "classes": k,
                "cores": int(cores),
                "shap_table_build_sec": round(build, 2),
                "sidecar_pack_sec": round(pack, 2),
                "shap_parquet_bytes": folder_bytes(os.path.join(out, "shap")),
                "sidecar_bytes": folder_bytes(os.path.join(out, "sc")),
                "model_json_bytes": len(model_doc(trees, depth, k)),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
