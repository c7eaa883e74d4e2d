"""The user-facing model: load, score, link, explain.

``Model`` is a thin handle on the long model tables plus, lazily, its header and
broadcast blocks of trees. Plans:

* ``plan='dense'``       the fused kernel: one ``mapInArrow`` over the caller's
                         partitions, no shuffle, any size of model (default,
                         also as ``'auto'``);
* ``plan='relational'``  joins and aggregates over the model tables.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import links
from ..functions.features import (
    NAN_MODES,
    NULL_MODES,
    _cat_input,
    _float_input,
    assemble,
    guard_inputs,
    lookup_stat,
    prune,
    row_checks,
    source_columns,
)
from ..operators import score as S
from ..operators.kernel import Walk, list_column, run_walk, walk_step
from ..sources.model_docs import ModelTables, load_model_texts, load_models
from ..session import durable
from . import compiled as C
from .compiled import ModelHeader, forest_of, model_header


class Model:
    def __init__(self, tables: ModelTables, model_id: str):
        self.tables = tables
        self.model_id = model_id
        self.attached = None
        self._header: ModelHeader | None = None
        self._explainers: dict = {}
        self._blocks: dict = {}

    # ---- loading (A1, A2) ----
    @classmethod
    def load(cls, spark: SparkSession, path: str, model_id: str | None = None, sidecar: str | None = None) -> "Model":
        """A1: the model of a document file; ``sidecar`` names a sidecar file (or folder) to attach."""
        tables = load_models(spark, path)
        if model_id is None:
            ids = [r["model_id"] for r in tables.models.select("model_id").collect()]
            if len(ids) != 1:
                rej = tables.rejected.collect()
                if rej:
                    raise ValueError(f"cannot load model from {path}: {rej[0]['reason']}")
                raise ValueError(f"{path} holds {len(ids)} models; pass model_id")
            model_id = ids[0]
        return cls(tables, model_id)._with_sidecar(spark, sidecar)

    @classmethod
    def from_text(cls, spark: SparkSession, text: str, model_id: str = "model", sidecar: str | None = None) -> "Model":
        return cls(load_model_texts(spark, {model_id: text}), model_id)._with_sidecar(spark, sidecar)

    def _with_sidecar(self, spark: SparkSession, path: str | None) -> "Model":
        if path is not None:
            from ..sources.sidecar import SUFFIX, read_sidecars

            sidecars = read_sidecars(spark, path, glob="*" if path.endswith(SUFFIX) else "*" + SUFFIX)
            ids = [r["model_id"] for r in sidecars.headers.select("model_id").collect()]
            if not ids:
                bad = sidecars.rejected.first()
                raise ValueError(f"no sidecar in {path}" + (f": {bad['reason']}" if bad else ""))
            self.attach(sidecars, ids[0] if len(ids) == 1 else self.model_id)
        return self

    def attach(self, sidecars, shap_id: str | None = None, feature_names: list[str] | None = None, class_names: list[str] | None = None) -> None:
        """Explain by the sidecar ``shap_id`` from now on; it may be another model's."""
        from ..operators.explain import sidecar_explainer

        self.attached = sidecar_explainer(sidecars, self.tables, self.model_id, shap_id, feature_names, class_names)

    # ---- metadata (B) ----
    @property
    def header(self) -> ModelHeader:
        if self._header is None:
            self._header = model_header(self.tables, self.model_id)
        return self._header

    def __repr__(self) -> str:
        return f"<Model {self.model_id} {self.header.summary()}>"

    # ---- the dense step ----
    def _own_walk(self, columns: list[int], raw: str | None, leaves: str | None, phis: dict) -> Walk:
        """Raw scores, leaves and the model's own SHAP tables, over one set of blocks."""
        h = self.header
        key = (raw is not None, tuple(ex.shap_id for ex in phis.values()), C.BLOCK_VALUES)
        if key not in self._blocks:
            forest = forest_of(self.tables, h, [ex.shap for ex in phis.values()])
            if raw is None:
                forest.leaves = None
            self._blocks[key] = forest.broadcast(C.BLOCK_VALUES)
        return Walk(columns, h.dims, h.n_float, self._blocks[key], h.scale, h.bias, raw, leaves, list(phis), h.n_trees)

    def _walks(self, columns: list[int], raw: str | None, leaves: str | None, phis: dict) -> list[Walk]:
        own = {c: ex for c, ex in phis.items() if ex in self._explainers.values()}
        walks = [self._own_walk(columns, raw, leaves, own)] if raw or leaves or own else []
        return walks + [ex.walk(columns, c) for c, ex in phis.items() if c not in own]

    def walk(
        self,
        df: DataFrame,
        *,
        raw: str | None = None,
        leaves: str | None = None,
        phis: dict | None = None,
        keep: list[str] | None = None,
        **inputs,
    ) -> DataFrame:
        """Any of raw scores, leaves and contributions, appended by one Python step.

        ``raw`` and ``leaves`` name output columns; ``phis`` maps output columns
        to explainers (or to what ``explainer`` takes). The leaf of each tree is
        found once for all outputs that use the model's own trees.
        """
        explainers = {c: self.explainer(e) if e is None or isinstance(e, str) else e for c, e in (phis or {}).items()}
        df = prune(df, self.header, keep, **inputs)
        if explainers and raw is None and leaves is None and inputs.get("row_map") is not None:
            inputs.setdefault("unknown_keys", "ignore")  # explain ignores names it does not know
        assembled, vcols, (columns,) = assemble(df, [self.header], self.tables.target_stats, **inputs)
        return walk_step(assembled, vcols, self._walks(columns, raw, leaves, explainers))

    # ---- scoring ----
    def _plan(self, plan: str) -> str:
        if plan not in ("auto", "dense", "relational"):
            raise ValueError("plan must be 'auto', 'dense' or 'relational'")
        return "dense" if plan == "auto" else plan

    def raw(
        self,
        df: DataFrame,
        *,
        plan: str = "auto",
        keys: list[str] | None = None,
        out_col: str = "raw",
        keep: list[str] | None = None,
        **inputs,
    ) -> DataFrame:
        """Append the K raw scores as ``out_col ARRAY<DOUBLE>``.

        ``keep`` limits the carried columns (plus the model's inputs), which
        prunes the scan; by default every column of ``df`` is carried.
        """
        if self._plan(plan) == "dense":
            return self.walk(df, raw=out_col, keep=keep, **inputs)
        if not keys:
            raise ValueError("the relational plan needs unique key columns (keys=[...])")
        # Partition once; the scores come back grouped on the same keys, so the
        # join below is co-partitioned and needs no further exchange.
        if keep is not None:
            df = prune(df, self.header, [*keys, *keep], **inputs)
        rows = S.partition_by_keys(df, keys, self.header.n_trees * max(1, self.header.max_depth))
        long = score_many(rows, self.tables, [self.model_id], keys, partitioned=True, **inputs)
        nested = long.groupBy(*keys).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("class_idx", "raw"))), lambda s: s["raw"]).alias(out_col)
        )
        return S.join_on_keys(rows, nested, keys, "inner")

    def raw_long(self, df: DataFrame, *, keys: list[str], null_mode: str = "zero", nan_mode: str = "min", **inputs) -> DataFrame:
        """D2 through the relational plan P4: (model_id, keys..., class_idx, raw)."""
        return score_many(df, self.tables, [self.model_id], keys, null_mode=null_mode, nan_mode=nan_mode, **inputs)

    def leaf_index(self, df: DataFrame, out_col: str = "leaves", keep: list[str] | None = None, **inputs) -> DataFrame:
        """Append the leaf reached in each tree as ``out_col ARRAY<INT>``."""
        return self.walk(df, leaves=out_col, keep=keep, **inputs)

    def predict(
        self,
        df: DataFrame,
        prediction_type: str = "raw_formula_val",
        *,
        out_col: str = "prediction",
        plan: str = "auto",
        keys: list[str] | None = None,
        keep: list[str] | None = None,
        **inputs,
    ) -> DataFrame:
        """One of the seven prediction types as ``out_col ARRAY<DOUBLE>``."""
        ptype = links.resolve_prediction_type(prediction_type)
        link = links.apply_link(F.col("__raw"), ptype, self.header.dims, self.header.loss_function)  # plan-time type check
        scored = self.raw(df, plan=plan, keys=keys, out_col="__raw", keep=keep, **inputs)
        return scored.withColumn(out_col, link).drop("__raw")

    def predict_proba(self, df: DataFrame, **kw) -> DataFrame:
        """Probabilities (sigmoid for one dimension, softmax otherwise)."""
        _reject_type("predict_proba", "probability", kw)
        return self.predict(df, "probability", **kw)

    def predict_multi_proba(self, df: DataFrame, **kw) -> DataFrame:
        """Independent per-label sigmoids."""
        _reject_type("predict_multi_proba", "multi_probability", kw)
        return self.predict(df, "multi_probability", **kw)

    # ---- explanation (E) ----
    def explainer(self, quantize: str | None = None):
        """The attached explainer, or the model's own SHAP table and bias row.

        ``None``: what is attached, else the exact table. ``'exact'`` always
        takes the model's own table, ``'float16'`` rounds it as the compact
        sidecar stores it (and the bias row through float32).
        """
        from ..operators.explain import Explainer
        from ..operators.treeshap import bias_row, quantize_float16, shap_table

        if quantize is None and self.attached is not None:
            return self.attached
        key = quantize or "exact"
        if key not in self._explainers:
            if key not in ("exact", "float16"):
                raise ValueError("quantize must be None, 'exact' or 'float16'")
            if self.header.n_cat:
                raise ValueError(
                    f"only models without categorical features can be explained; this one has {self.header.n_cat}"
                )
            one = self.tables.only(self.model_id)
            shap = shap_table(one)
            if key == "float16":
                shap = quantize_float16(shap)
            shap = durable(shap)
            rows = sorted(bias_row(one).collect(), key=lambda r: r["class_idx"])
            bias = [r["bias"] for r in rows]
            if key == "float16":
                bias = [float(np.float32(b)) for b in bias]
            forest = forest_of(self.tables, self.header, [shap])
            forest.leaves = None
            self._explainers[key] = Explainer(self.header, forest, bias, f"{self.model_id}:{key}")
        return self._explainers[key]

    def explain(
        self,
        df: DataFrame,
        *,
        plan: str = "dense",
        keys: list[str] | None = None,
        quantize: str | None = None,
        out_col: str = "phi",
        raw_col: str | None = None,
        keep: list[str] | None = None,
        **inputs,
    ) -> DataFrame:
        """Append ``phi`` (K x F) and the nested, ranked ``explanation``; with ``raw_col`` the raw scores too."""
        from ..operators import explain as X

        ex = self.explainer(quantize)
        if plan == "dense":
            out = self.walk(df, raw=raw_col, phis={out_col: ex}, keep=keep, **inputs)
        elif plan == "relational":
            if not keys:
                raise ValueError("the relational plan needs unique key columns (keys=[...])")
            if raw_col is not None:
                raise ValueError("raw_col needs plan='dense'")
            df = prune(df, self.header, keep if keep is None else [*keys, *keep], **inputs)
            if inputs.get("row_map") is not None:
                inputs.setdefault("unknown_keys", "ignore")
            out = X.phi_relational(df, ex, keys, out_col, **inputs)
        else:
            raise ValueError("plan must be 'dense' or 'relational'")
        return out.withColumn("explanation", X.explanation(F.col(out_col), ex))

    def has_explainer(self) -> bool:
        """A SHAP table is there, attached or built."""
        return self.attached is not None or bool(self._explainers)

    # ---- SQL surface (D14) ----
    def register_udf(
        self,
        spark: SparkSession,
        name: str | None = None,
        prediction_type: str = "raw_formula_val",
        null_mode: str = "zero",
        nan_mode: str = "min",
    ) -> str:
        """Register ``name(f1, .., fN[, c1, .., cM])`` returning ARRAY<DOUBLE>.

        An Arrow UDF; arguments follow the model's float then cat feature
        order. Nulls and NaN follow ``null_mode`` and ``nan_mode`` as on the
        DataFrame surface (Arrow keeps the two apart); anything but numbers in
        a float slot fails the query.
        """
        if null_mode not in NULL_MODES or nan_mode not in NAN_MODES:
            raise ValueError(f"null_mode must be one of {NULL_MODES}, nan_mode one of {NAN_MODES}")
        h = self.header
        ptype = links.resolve_prediction_type(prediction_type)
        links.apply_link(F.col("x"), ptype, h.dims, h.loss_function)  # validate now
        stats_bc = spark.sparkContext.broadcast(_stat_tables(self.tables, h))
        walk = self._own_walk(list(range(len(h.virtual))), "raw", None, {})
        virtual, n_float, loss = h.virtual, h.n_float, h.loss_function

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def score_udf(*cols: pa.Array) -> pa.Array:
            stats = stats_bc.value
            n = len(cols[0]) if cols else 0
            floats = [_arrow_floats(c, null_mode, nan_mode) for c in cols[:n_float]]
            cats = [_arrow_cats(c, null_mode) for c in cols[n_float:]]
            x = np.zeros((n, len(virtual)), dtype=np.float32)
            for i, v in enumerate(virtual):
                if v[0] == "float":
                    x[:, i] = floats[v[1]]
                elif v[0] == "onehot":
                    x[:, i] = cats[v[1]] == v[2]
                else:
                    keys, values, prior = stats[v[1]]
                    x[:, i] = _sorted_lookup(cats[v[2]], keys, values, prior)
            return list_column(numpy_link(run_walk(walk, x)[0], ptype, loss=loss))

        name = name or f"score_{self.model_id}"
        spark.udf.register(name, score_udf)
        return name


def _arrow_floats(c: pa.Array, null_mode: str, nan_mode: str) -> np.ndarray:
    """A float argument under the null and NaN rules of the DataFrame surface."""
    t = c.type
    if not (pa.types.is_floating(t) or pa.types.is_integer(t) or pa.types.is_decimal(t) or pa.types.is_null(t)):
        raise TypeError(f"a float feature got {t}")
    if null_mode == "error" and c.null_count:
        raise ValueError("null value for a float feature")
    x = c.cast(pa.float64()).fill_null(0.0 if null_mode == "zero" else float("nan")).to_numpy(zero_copy_only=False)
    if nan_mode == "error" and np.isnan(x).any():
        raise ValueError("NaN value for a float feature")
    if nan_mode == "max":
        x = np.where(np.isnan(x), np.inf, x)
    return x.astype(np.float32)


def _arrow_cats(c: pa.Array, null_mode: str) -> pd.Series:
    if null_mode == "error" and c.null_count:
        raise ValueError("null value for a cat feature")
    return c.cast(pa.string()).fill_null("").to_pandas()


def _reject_type(method: str, locked: str, kw: dict) -> None:
    """The convenience methods fix the prediction type."""
    if "prediction_type" in kw:
        raise TypeError(
            f"{method} always returns {locked!r}; use predict() for {kw['prediction_type']!r}"
        )


def _stat_tables(tables: ModelTables, header: ModelHeader) -> dict:
    """Target statistics for the SQL function: sorted keys and values as Arrow and NumPy arrays.

    A function has no join to fall back on, so a statistic above the broadcast
    bound is refused here; the DataFrame surface takes any size.
    """
    from ..functions.features import BROADCAST_STATS

    out = {}
    for sid, prior in header.stat_priors.items():
        if header.stat_sizes.get(sid, 0) > BROADCAST_STATS:
            raise ValueError(f"statistic {sid} of {header.model_id!r} is too large for a SQL function; score the DataFrame instead")
        mine = (F.col("model_id") == header.model_id) & (F.col("stat_id") == sid) & F.col("key").isNotNull()
        got = tables.target_stats.filter(mine).select("key", "value").toArrow().sort_by("key")
        out[sid] = (np.array(got.column("key").to_pylist(), dtype=object), got.column("value").to_numpy(), prior)
    return out


def _sorted_lookup(cats: pd.Series, keys: np.ndarray, values: np.ndarray, prior: float) -> np.ndarray:
    found = pd.Index(keys).get_indexer(cats.to_numpy(dtype=object))
    if not len(values):
        return np.full(len(cats), prior, dtype=np.float32)
    return np.where(found >= 0, values[found], prior).astype(np.float32)


def numpy_link(raw: np.ndarray, ptype: str, loss: str | None = None) -> np.ndarray:
    """The link functions for the UDF path (same rules as ``links.apply_link``)."""
    k = raw.shape[1]
    if ptype == "raw_formula_val":
        return raw
    if ptype == "multi_probability" or (ptype == "probability" and k == 1):
        return 1.0 / (1.0 + np.exp(-raw))
    if ptype == "probability":
        e = np.exp(raw - raw.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)
    if ptype == "class":
        if loss in links.MULTI_LABEL_LOSSES:
            return (raw > 0).astype(np.float64)
        if k == 1:
            return (raw > 0).astype(np.float64)
        return raw.argmax(axis=1).astype(np.float64)[:, None]
    if ptype == "exponent":
        return np.exp(raw)
    if ptype == "log_probability":
        m = raw.max(axis=1, keepdims=True)
        return raw - m - np.log(np.exp(raw - m).sum(axis=1, keepdims=True))
    if ptype == "rmse_with_uncertainty":
        return np.column_stack([raw[:, 0], np.exp(2.0 * raw[:, 1])])
    raise ValueError(ptype)


def raw_many(df: DataFrame, tables: ModelTables, model_ids: list[str], keys: list[str], **inputs) -> DataFrame:
    """D13, dense: all models in one Arrow step over shared features: (model_id, keys..., raw ARRAY<DOUBLE>).

    No shuffle at all; only the keys and the models' inputs are carried.
    """
    models = [Model(tables, mid) for mid in model_ids]
    assembled, vcols, places = assemble(df, [m.header for m in models], tables.target_stats, **inputs)
    rows = assembled.select(*dict.fromkeys([*keys, *vcols]))
    walks = [m._own_walk(columns, f"__raw{i}", None, {}) for i, (m, columns) in enumerate(zip(models, places))]
    scored = walk_step(rows, vcols, walks)
    cols = [F.struct(F.lit(mid).alias("model_id"), F.col(f"__raw{i}").alias("raw")) for i, mid in enumerate(model_ids)]
    return scored.select(*keys, F.explode(F.array(*cols)).alias("__m")).select("__m.model_id", *keys, "__m.raw")


def score_many_dense(df: DataFrame, tables: ModelTables, model_ids: list[str], keys: list[str], **inputs) -> DataFrame:
    """``raw_many`` in the long form of ``score_many``: (model_id, keys..., class_idx, raw)."""
    long = raw_many(df, tables, model_ids, keys, **inputs).select("model_id", *keys, F.posexplode("raw").alias("class_idx", "raw"))
    return long.withColumn("class_idx", F.col("class_idx").cast("int"))


def score_wanted(df: DataFrame, tables: ModelTables, wanted: str, keep: list[str] | None = None, **inputs) -> DataFrame:
    """Each row scored by the model that its ``wanted`` column names, or told why not: raw, code.

    ``code`` is null for scored rows; else the code of the rejected document
    (``model_docs.REASONS``), ``NO_MODEL`` for an id that no document has, or
    ``NO_NAME`` for a null id. One Arrow step; a model walks only its own rows.
    """
    ids = [r["model_id"] for r in tables.models.select("model_id").orderBy("model_id").collect()]
    models = [Model(tables, i) for i in ids]
    carried = [*(df.columns if keep is None else keep), wanted]
    raw = F.lit(None).cast("array<double>")
    out = df
    if models:
        assembled, vcols, places = assemble(df, [m.header for m in models], tables.target_stats, **inputs)
        walks = [m._own_walk(columns, f"__raw{i}", None, {}) for i, (m, columns) in enumerate(zip(models, places))]
        for walk, i in zip(walks, ids):
            walk.where = (wanted, i)
        out = walk_step(assembled.select(*dict.fromkeys([*carried, *vcols])), vcols, walks)
        raw = F.coalesce(*[F.col(f"__raw{i}") for i in range(len(ids))])
    codes = tables.rejected.select(F.col("model_id").alias("__rejected"), F.col("code").alias("__code"))
    known = F.col(wanted).isin(ids) if ids else F.lit(False)
    code = F.when(F.col(wanted).isNull(), "NO_NAME").when(known, F.lit(None)).otherwise(F.coalesce("__code", F.lit("NO_MODEL")))
    return out.join(codes, F.col(wanted) == F.col("__rejected"), "left").select(
        *dict.fromkeys(carried), raw.alias("raw"), code.alias("code")
    )


def _tree_ranges(headers: list[ModelHeader]) -> list[tuple[int, int]]:
    """Ranges of tree numbers whose leaf values, over all models, fit one broadcast."""
    per_tree = sum((1 << h.max_depth) * h.dims for h in headers)
    n = max(h.n_trees for h in headers)
    step = max(1, C.BLOCK_VALUES // max(1, per_tree))
    return [(s, min(s + step, n)) for s in range(0, n, step)]


def score_many(
    df: DataFrame,
    tables: ModelTables,
    model_ids: list[str],
    keys: list[str],
    *,
    null_mode: str = "zero",
    nan_mode: str = "min",
    features: str | None = None,
    cat_features: str | None = None,
    row_map: str | None = None,
    strict: bool = False,
    partitioned: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """D13 + P4: several models over the same rows, in long form.

    Output ``(model_id, keys..., class_idx, raw)``. Rows are hash-partitioned
    on ``keys`` once, up front, and checked there for repeated keys; the
    per-(row, tree) and per-(row, class) aggregates then run inside those
    partitions without another exchange. The model tables are broadcast range
    of trees by range of trees, each within ``BLOCK_VALUES``; with more than one
    range their sums are added by one more aggregate.
    """
    headers = [model_header(tables, mid) for mid in model_ids]
    expansion = sum(h.n_trees * max(1, h.max_depth) for h in headers)
    rows = df if partitioned else S.partition_by_keys(df, keys, expansion, partitions)
    rows = rows.withColumn("__unique", S.unique_keys(rows, keys))
    inputs = []
    for h in headers:
        fsrc, csrc, labels = source_columns(
            rows.drop("__unique"), h, features=features, cat_features=cat_features, row_map=row_map, strict=strict
        )
        fl = [_float_input(c, labels[i], null_mode, nan_mode) for i, c in enumerate(fsrc)]
        cl = [_cat_input(c, null_mode, labels[len(fsrc) + j]) for j, c in enumerate(csrc)]
        guard_inputs([*row_checks(h, features, cat_features, row_map), F.col("__unique")], fl, cl)
        stat_cols = []
        for _, sid, cat_index in (v for v in h.virtual if v[0] == "stat"):
            # One lookup per input row and statistic (not per split).
            val_col, cat_col = f"__s_{h.model_id}_{sid}", f"__c_{h.model_id}_{sid}"
            table = tables.target_stats.filter((F.col("model_id") == h.model_id) & (F.col("stat_id") == sid) & F.col("key").isNotNull())
            rows = lookup_stat(rows.withColumn(cat_col, cl[cat_index]), cat_col, table, h.stat_sizes.get(sid, 0), val_col, h.stat_priors[sid])
            rows = rows.drop(cat_col)
            stat_cols.append((sid, F.col(val_col)))
        inputs.append((fl, cl, stat_cols))
    long = S.unpivot_inputs(rows, keys, inputs)
    depth = max(h.max_depth for h in headers)
    splits, leaves = S.with_stumps(tables, model_ids), tables.leaves.filter(F.col("model_id").isin(model_ids))
    parts = []
    for start, end in _tree_ranges(headers):
        S.check_keys(len(headers), end - start, depth)
        some = (F.col("tree") >= start) & (F.col("tree") < end)
        leaf_rows = S.leaf_index_relational(long, keys, F.broadcast(splits.filter(some)), model_ids)
        parts.append(S.leaf_sums(leaf_rows, keys, F.broadcast(leaves.filter(some)), model_ids, depth, start))
    sums = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            sums = sums.unionByName(p)
        sums = sums.groupBy("model_idx", *keys, "class_idx").agg(F.sum("s").alias("s"))
    return S.raw_relational(sums, keys, tables.models, model_ids)
