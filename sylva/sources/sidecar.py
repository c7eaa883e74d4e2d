"""The compact binary SHAP format ("sidecar") as a Spark source and sink.

The primary sink for SHAP tables is Parquet. The
binary format exists for interchange with readers of the compact layout:

* ``pack_sidecars``  ``groupBy(model_id).applyInPandas``: one model -> one
  BINARY value. A sidecar is one file per model by definition; its size is
  bounded by the model (trees x 2^depth x depth x K x 2 bytes) and checked.
* ``write_sidecar_files`` writes those values as files under a shared folder,
  through the data source of ``sidecar_files`` (staged, then committed).
* ``read_sidecars``   ``spark.read.format("binaryFile")`` -> ``mapInPandas``
  decode (one task per file) -> header, split and SHAP tables; files failing a
  format guard become ``rejected`` rows.
"""

from __future__ import annotations

import posixpath
from dataclasses import dataclass

import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.model_docs import ModelTables, pow2

# Fixed values of the format: magic bytes, version, header sizes.
MAGIC = b"CBSHAP\x01\x00"
VERSION = 1
HEADER_FIXED = 36  # magic (8) + five uint32 (20) + reserved uint64 (8)
SUFFIX = ".sidecar"  # our file naming; any name can be read with ``glob``


def header_size(n_classes: int) -> int:
    return HEADER_FIXED + 4 * n_classes


def record_dtype(depth: int, n_classes: int) -> np.dtype:
    """One tree record: split features, borders, used features, count, pad, phi; 4-byte aligned."""
    n_leaves = 1 << depth
    fields = [
        ("split_features", "u1", (depth,)),
        ("split_borders", "<f4", (depth,)),
        ("used_features", "u1", (depth,)),
        ("n_used", "u1"),
        ("pad", "u1"),
        ("phi", "<f2", (n_leaves, depth, n_classes)),
    ]
    raw = np.dtype(fields).itemsize
    tail = (-raw) % 4
    if tail:
        fields.append(("tail", "u1", (tail,)))
    return np.dtype(fields)


def pack(
    feats: np.ndarray, borders: np.ndarray, used: list[np.ndarray], phi: np.ndarray, bias: np.ndarray, n_features: int
) -> bytes:
    """Encode one model. ``phi`` is (T, L, D, K): row i of a leaf belongs to ``used[t][i]``."""
    t_count, depth = feats.shape
    k = bias.shape[0]
    if n_features > 256 or (feats.size and feats.max() > 255):
        raise ValueError("feature index above 255 cannot be stored in the compact format")
    if not np.all(np.isfinite(phi)) or np.abs(phi).max(initial=0.0) > 65504.0:
        raise ValueError("SHAP value not representable as float16")
    header = np.zeros(1, dtype=[("magic", "S8"), ("dims", "<u4", (5,)), ("reserved", "<u8"), ("bias", "<f4", (k,))])
    header["magic"] = MAGIC
    header["dims"] = [VERSION, t_count, depth, n_features, k]
    header["bias"] = bias.astype(np.float32)
    recs = np.zeros(t_count, dtype=record_dtype(depth, k))
    recs["split_features"] = feats.astype(np.uint8)
    recs["split_borders"] = borders.astype(np.float32)
    for t in range(t_count):
        recs["used_features"][t, : len(used[t])] = used[t]
        recs["n_used"][t] = len(used[t])
    recs["phi"] = phi.astype(np.float16)
    return header.tobytes() + recs.tobytes()


class FormatError(ValueError):
    """A file that does not follow the layout; ``code`` names the rule it breaks."""

    def __init__(self, code: str, detail: str):
        super().__init__(f"[{code}] {detail}")
        self.code = code


#: The fixed part of the header: magic, version, trees, depth, features, classes, reserved.
_HEAD = struct.Struct("<8s5IQ")


def unpack(buf: bytes) -> dict:
    """Decode one file (A7 guards, A8 float16 via NumPy).

    The sizes that the header announces give the place where the file must
    end; anything shorter is refused before a record is touched.
    """
    if len(buf) < _HEAD.size:
        raise FormatError("SHORT", f"{len(buf)} bytes cannot hold the {_HEAD.size}-byte header")
    magic, version, trees, depth, features, classes, _ = _HEAD.unpack_from(buf)
    for code, found, wanted in (("MAGIC", magic, MAGIC), ("VERSION", version, VERSION)):
        if found != wanted:
            raise FormatError(code, f"found {found!r} where {wanted!r} belongs")
    record = record_dtype(depth, classes)
    bias_end = header_size(classes)
    end = bias_end + trees * record.itemsize
    if len(buf) < end:
        raise FormatError("CUT", f"the file ends at byte {len(buf)} of {end}")
    return {
        "version": version,
        "n_trees": trees,
        "depth": depth,
        "n_features": features,
        "n_classes": classes,
        "bias": np.frombuffer(buf[_HEAD.size : bias_end], "<f4").astype(np.float64),
        "records": np.frombuffer(buf[bias_end:end], record),
    }


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

PACKED_SCHEMA = T.StructType(
    [
        T.StructField("model_id", T.StringType()),
        T.StructField("sidecar", T.BinaryType()),
        T.StructField("n_bytes", T.LongType()),
    ]
)


def _pack_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("tree")
    feats = np.vstack([np.asarray(f, dtype=np.int64) for f in pdf["feats"]])
    borders = np.vstack([np.asarray(b, dtype=np.float32) for b in pdf["borders"]])
    t_count, depth = feats.shape
    k = int(pdf["dims"].iloc[0])
    used, phi = [], np.zeros((t_count, 1 << depth, depth, k))
    for t, entries in enumerate(pdf["entries"]):
        fs = sorted({int(e["feature"]) for e in entries})
        used.append(np.asarray(fs, dtype=np.uint8))
        slot = {f: i for i, f in enumerate(fs)}
        for e in entries:
            phi[t, int(e["leaf"]), slot[int(e["feature"])]] = np.asarray(e["phi"], dtype=np.float64)
    data = pack(feats, borders, used, phi, np.asarray(pdf["bias"].iloc[0], dtype=np.float64), int(pdf["n_float"].iloc[0]))
    return pd.DataFrame({"model_id": [pdf["model_id"].iloc[0]], "sidecar": [data], "n_bytes": [len(data)]})


def pack_sidecars(tables: ModelTables, shap: DataFrame, bias: DataFrame) -> DataFrame:
    """(model_id, sidecar BINARY, n_bytes) for every model in ``shap``.

    ``shap`` is the long SHAP table, ``bias`` the bias row (model_id, class_idx,
    bias). A model with mixed tree depths fails the job. One file is one model,
    so a group holds one model's table, as the format needs.
    """
    depth = tables.splits.groupBy("model_id", "tree").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("level", "feature", "border"))), lambda s: s["feature"]).alias("feats"),
        F.transform(F.array_sort(F.collect_list(F.struct("level", "feature", "border"))), lambda s: s["border"]).alias("borders"),
    )
    entries = shap.groupBy("model_id", "tree").agg(F.collect_list(F.struct("leaf", "feature", "phi")).alias("entries"))
    biases = bias.groupBy("model_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("class_idx", "bias"))), lambda s: s["bias"]).alias("bias")
    )
    info = tables.models.select("model_id", "n_float", "dims")
    levels = tables.splits.groupBy("model_id", "tree").agg(F.count("*").alias("d")).groupBy("model_id").agg(
        F.min("d").alias("least"), F.max("d").alias("most")
    )
    # part of a column that the packing reads, so that no optimizer rule can drop it
    one_depth = F.when(F.col("least") != F.col("most"), F.raise_error(F.lit("the compact format needs one depth for all trees")).cast("int")).otherwise(F.col("dims"))
    rows = (
        depth.join(entries, ["model_id", "tree"])
        .join(biases, "model_id")
        .join(info.join(levels, "model_id").select("model_id", "n_float", one_depth.alias("dims")), "model_id")
    )
    return rows.groupBy("model_id").applyInPandas(_pack_group, PACKED_SCHEMA)


def write_sidecar_files(packed: DataFrame, out_dir: str, suffix: str = SUFFIX) -> DataFrame:
    """Write each packed model to ``out_dir/<model_id><suffix>``, all or none (see ``sidecar_files``).

    Returns (model_id, path, n_bytes) of the files in the folder.
    """
    from .sidecar_files import NAME, register

    spark = packed.sparkSession
    register(spark)
    packed.select("model_id", "sidecar").write.format(NAME).option("suffix", suffix).mode("append").save(out_dir)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*" + suffix).load(out_dir)
    stem = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(F.substring_index(stem, ".", 1).alias("model_id"), "path", F.col("length").alias("n_bytes"))


DECODED_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("model_id", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("n_trees", T.LongType()),
        T.StructField("depth", T.LongType()),
        T.StructField("n_features", T.LongType()),
        T.StructField("n_classes", T.LongType()),
        T.StructField("bias", T.ArrayType(T.DoubleType())),
        T.StructField(
            "trees",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("feats", T.ArrayType(T.IntegerType())),
                        T.StructField("borders", T.ArrayType(T.FloatType())),
                        T.StructField("used", T.ArrayType(T.IntegerType())),
                        T.StructField("phi", T.ArrayType(T.DoubleType())),
                    ]
                )
            ),
        ),
    ]
)


def _decode(it):
    for pdf in it:
        out = []
        for path, content in zip(pdf["path"], pdf["content"]):
            mid = posixpath.basename(path).split(".")[0]
            try:
                d = unpack(bytes(content))
            except FormatError as e:
                out.append({f.name: None for f in DECODED_SCHEMA.fields} | {"path": path, "model_id": mid, "reason": str(e)})
                continue
            recs = d["records"]
            trees = []
            for r in recs:
                n = int(r["n_used"])
                trees.append(
                    {
                        "feats": r["split_features"].astype(np.int32).tolist(),
                        "borders": r["split_borders"].astype(np.float32).tolist(),
                        "used": r["used_features"][:n].astype(np.int32).tolist(),
                        # leaf-major, then used slot, then class; unused slots dropped
                        "phi": r["phi"][:, :n, :].astype(np.float64).reshape(-1).tolist(),
                    }
                )
            out.append(
                {
                    "path": path,
                    "model_id": mid,
                    "reason": None,
                    "version": d["version"],
                    "n_trees": d["n_trees"],
                    "depth": d["depth"],
                    "n_features": d["n_features"],
                    "n_classes": d["n_classes"],
                    "bias": d["bias"].tolist(),
                    "trees": trees,
                }
            )
        frame = pd.DataFrame(out, columns=[f.name for f in DECODED_SCHEMA.fields]).astype(object)
        yield frame.where(frame.notna(), None)


@dataclass
class SidecarTables:
    headers: DataFrame  # B14: model_id, path, version, n_trees, depth, n_features, n_classes, bias
    splits: DataFrame  # model_id, tree, level, split_type, feature, border
    shap: DataFrame  # model_id, tree, leaf, feature, phi ARRAY<DOUBLE>
    rejected: DataFrame  # model_id, path, reason


def read_sidecars(spark: SparkSession, path: str, glob: str = "*" + SUFFIX) -> SidecarTables:
    """Decode every sidecar under ``path`` matching ``glob``; ``model_id`` is the file stem."""
    from ..session import ship_package

    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    return _decoded_tables(files)


def read_sidecar_table(packed: DataFrame) -> SidecarTables:
    """Decode sidecars held in a table (model_id, sidecar BINARY), e.g. a Parquet copy of ``pack_sidecars``."""
    from ..session import ship_package

    ship_package(packed.sparkSession)
    files = packed.select(F.concat(F.col("model_id"), F.lit(SUFFIX)).alias("path"), F.col("sidecar").alias("content"))
    return _decoded_tables(files)


def _decoded_tables(files: DataFrame) -> SidecarTables:
    decoded = files.mapInPandas(_decode, DECODED_SCHEMA).cache()
    good = decoded.filter(F.col("reason").isNull())
    headers = good.select("model_id", "path", "version", "n_trees", "depth", "n_features", "n_classes", "bias")
    trees = good.select("model_id", "n_classes", "depth", F.posexplode("trees").alias("tree", "t"))
    splits = trees.select(
        "model_id",
        F.col("tree").cast("int").alias("tree"),
        F.posexplode(F.arrays_zip("t.feats", "t.borders")).alias("level", "s"),
    ).select(
        "model_id",
        "tree",
        F.col("level").cast("int").alias("level"),
        F.lit("float").alias("split_type"),
        F.col("s.feats").alias("feature"),
        F.col("s.borders").alias("border"),
    )
    k = F.col("n_classes").cast("int")
    n_used = F.size("t.used")
    shap = trees.select(
        "model_id",
        F.col("tree").cast("int").alias("tree"),
        "t.used",
        "t.phi",
        k.alias("k"),
        n_used.alias("u"),
        pow2(F.col("depth").cast("int")).alias("n_leaves"),
    ).select(
        "model_id",
        "tree",
        "used",
        "phi",
        "k",
        "u",
        F.explode(F.sequence(F.lit(0), F.col("n_leaves") - 1)).alias("leaf"),
    ).select(
        "model_id",
        "tree",
        "leaf",
        F.posexplode("used").alias("slot", "feature"),
        "phi",
        "k",
        "u",
    ).select(
        "model_id",
        "tree",
        F.col("leaf").cast("int").alias("leaf"),
        F.col("feature").cast("int").alias("feature"),
        F.slice("phi", (F.col("leaf") * F.col("u") + F.col("slot")) * F.col("k") + 1, F.col("k")).alias("phi"),
    )
    rejected = decoded.filter(F.col("reason").isNotNull()).select("model_id", "path", "reason")
    return SidecarTables(headers, splits, shap, rejected)


def compatibility(sidecars: SidecarTables, tables: ModelTables, attachments: DataFrame | None = None) -> DataFrame:
    """(model_id, shap_id, compatible, reason) for each model paired with a sidecar.

    ``attachments`` (model_id, shap_id) says which model is explained by which
    sidecar, any number of models by one; by default each sidecar goes with the
    model of its own id.
    """
    heads = sidecars.headers.select(F.col("model_id").alias("shap_id"), "n_features", "n_classes")
    pairs = heads.select(F.col("shap_id").alias("model_id"), "shap_id") if attachments is None else attachments.select("model_id", "shap_id")
    m = tables.models.select("model_id", "n_float", "n_cat", "dims")
    j = pairs.join(heads, "shap_id", "left").join(m, "model_id", "left")
    reason = F.coalesce(
        F.when(F.col("dims").isNull(), F.lit("NO_MODEL")),
        F.when(F.col("n_features").isNull(), F.lit("NO_SIDECAR")),
        F.when(F.col("n_cat") > 0, F.lit("CATEGORICAL_MODEL")),
        *[
            F.when(F.col(got) != F.col(want), F.format_string(f"{code}: %d in the sidecar, %d in the model", got, want))
            for code, got, want in (("FEATURES", "n_features", "n_float"), ("CLASSES", "n_classes", "dims"))
        ],
    )
    return j.select("model_id", "shap_id", reason.isNull().alias("compatible"), reason.alias("reason"))


def export_sidecars(spark: SparkSession, model_path: str, output_dir: str | None = None) -> DataFrame:
    """A10: model documents under ``model_path`` -> one sidecar file per float-only model.

    The default output folder is the models' own folder; files are named
    ``<model_id>.shap.sidecar``. Returns (model_id, path, n_bytes).
    """
    from ..operators.treeshap import bias_row, shap_table
    from .model_docs import load_models

    tables = load_models(spark, model_path, on_error="raise")
    out = output_dir or (posixpath.dirname(model_path) if model_path.endswith(".json") else model_path)
    return write_sidecar_files(pack_sidecars(tables, shap_table(tables), bias_row(tables)), out, f".shap{SUFFIX}")
