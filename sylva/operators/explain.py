"""Explanation by table lookup.

* dense (default): the fused kernel (``operators/kernel.py``); per tree, the
  reached leaf's SHAP rows are gathered from broadcast blocks of the table;
* relational: leaf rows (row, tree, leaf) join the SHAP table on (tree, leaf)
  and are summed per (row, class, feature), inside the partitions of the
  up-front repartition on the row key.

Both return ``phi ARRAY<ARRAY<DOUBLE>>`` (K arrays of F contributions, class
major); ``explanation`` nests it with names, bias and raw, ranked by |phi|.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.features import assemble
from ..plans import compiled as C
from ..plans.compiled import Forest, ModelHeader
from . import score as S
from .kernel import Walk, walk_step


class Explainer:
    """A SHAP table and bias row, with the names that go with them.

    ``forest`` has the splits that decide the leaf and one SHAP table; ``bias``
    is a list of K doubles. Names default to the model's; labels fall back to
    indexes when the model's do not match K (binary models: 2 labels, 1
    dimension). Names or labels given by hand must match in number.
    """

    def __init__(
        self,
        header: ModelHeader,
        forest: Forest,
        bias: list[float],
        shap_id: str | None = None,
        feature_names: list[str] | None = None,
        class_names: list[str] | None = None,
    ):
        if header.n_cat:
            raise ValueError(
                f"only models without categorical features can be explained; this one has {header.n_cat}"
            )
        self.header = header
        self.forest = forest
        self.shap_id = shap_id or header.model_id
        self.bias = [float(b) for b in bias]
        k = forest.dims
        for what, names, n in (("bias values", self.bias, k), ("class names", class_names, k), ("feature names", feature_names, header.n_float)):
            if names is not None and len(names) != n:
                raise ValueError(f"{len(names)} {what} where the table has {n}")
        self.feature_names = list(feature_names or header.float_names)
        names = class_names or header.class_names
        self.class_names = [str(c) for c in names] if names and len(names) == k else [str(i) for i in range(k)]
        self._blocks: dict = {}

    @property
    def shap(self) -> DataFrame:
        """tree, leaf, feature, phi."""
        return self.forest.shaps[0]

    def walk(self, columns: list[int], out_col: str) -> Walk:
        size = C.BLOCK_VALUES
        if size not in self._blocks:
            self._blocks[size] = self.forest.broadcast(size)
        return Walk(columns, self.forest.dims, self.header.n_float, self._blocks[size], phi_cols=[out_col], n_trees=self.forest.n_trees)

    def named(self, header: ModelHeader, feature_names: list[str] | None = None, class_names: list[str] | None = None) -> "Explainer":
        """The same table (and blocks) under another model's names."""
        other = Explainer(header, self.forest, self.bias, self.shap_id, feature_names, class_names)
        other._blocks = self._blocks
        return other


def phi_dense(df: DataFrame, explainer: Explainer, out_col: str = "phi", **inputs) -> DataFrame:
    """E10, dense: append ``phi ARRAY<ARRAY<DOUBLE>>`` (K x F)."""
    assembled, vcols, (columns,) = assemble(df, [explainer.header], None, **inputs)
    return walk_step(assembled, vcols, [explainer.walk(columns, out_col)])


def explain_many(df: DataFrame, explainers: dict[str, Explainer], keys: list[str], **inputs) -> DataFrame:
    """Rows explained for several models, in one Arrow step: (model_id, keys..., explanation).

    Explainers that share a table are walked once, whatever their names.
    """
    tables: dict[int, tuple[Explainer, str]] = {}
    for ex in explainers.values():
        tables.setdefault(id(ex.forest), (ex, f"__phi{len(tables)}"))
    distinct = list(tables.values())
    assembled, vcols, places = assemble(df, [ex.header for ex, _ in distinct], None, **inputs)
    walked = walk_step(assembled, vcols, [ex.walk(columns, col) for (ex, col), columns in zip(distinct, places)])
    each = [
        F.struct(F.lit(mid).alias("model_id"), explanation(F.col(tables[id(ex.forest)][1]), ex).alias("explanation"))
        for mid, ex in explainers.items()
    ]
    return walked.select(*keys, F.explode(F.array(*each)).alias("__e")).select("__e.model_id", *keys, "__e.explanation")


def phi_relational(
    df: DataFrame, explainer: Explainer, keys: list[str], out_col: str = "phi", **inputs
) -> DataFrame:
    """E10, relational: keys + ``phi ARRAY<ARRAY<DOUBLE>>`` via joins and sums.

    The split and SHAP tables are broadcast range of trees by range of trees,
    each within the bound; the ranges' sums are added.
    """
    from ..functions.features import _float_input, guard_inputs, row_checks, source_columns

    m, forest = explainer.header, explainer.forest
    depth = max(1, forest.max_depth)
    rows = S.partition_by_keys(df, keys, forest.n_trees * depth)
    given = {k: v for k, v in inputs.items() if k in ("features", "row_map", "strict")}
    fsrc, _, labels = source_columns(rows, m, **given)
    null_mode = inputs.get("null_mode", "zero")
    nan_mode = inputs.get("nan_mode", "min")
    fl = [_float_input(c, labels[i], null_mode, nan_mode) for i, c in enumerate(fsrc)]
    checks = row_checks(m, given.get("features"), None, given.get("row_map"), inputs.get("unknown_keys", "error"))
    checked = rows.withColumn("__unique", S.unique_keys(rows, keys))
    guard_inputs([*checks, F.col("__unique")], fl, [])
    long = S.unpivot_inputs(checked, keys, [(fl, [], [])])
    parts = []
    for start, end in forest.ranges(C.BLOCK_VALUES):
        S.check_keys(1, end - start, forest.max_depth)
        some = (F.col("tree") >= start) & (F.col("tree") < end)
        given = {"model_id": F.lit(m.model_id), "value": F.lit(None).cast("string"), "stat_id": F.lit(None).cast("int")}  # float splits only
        sp = F.broadcast(forest.splits.filter(some).withColumns(given))
        leaf_rows = S.leaf_index_relational(long, keys, sp, [m.model_id])
        shap = forest.shaps[0].filter(some).select(
            S.leaf_key(F.lit(0), F.col("tree"), F.col("leaf"), forest.max_depth, start).alias("lkey"), "feature", "phi"
        )
        parts.append(
            leaf_rows.select(*keys, S.leaf_key(F.col("model_idx"), F.col("tree"), F.col("leaf"), forest.max_depth, start).alias("lkey"))
            .join(F.broadcast(shap), "lkey")
            .select(*keys, "feature", F.posexplode("phi").alias("class_idx", "v"))
            .groupBy(*keys, "class_idx", "feature")
            .agg(F.sum("v").alias("v"))
        )
    summed = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            summed = summed.unionByName(p)
        summed = summed.groupBy(*keys, "class_idx", "feature").agg(F.sum("v").alias("v"))
    per = summed.groupBy(*keys, "class_idx").agg(F.map_from_entries(F.collect_list(F.struct("feature", "v"))).alias("m"))
    filled = per.select(
        *keys,
        "class_idx",
        F.transform(F.sequence(F.lit(0), F.lit(m.n_float - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0.0))).alias("p"),
    )
    nested = filled.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("class_idx", "p"))), lambda s: s["p"]).alias(out_col)
    )
    # Rows whose trees all reach leaves without table rows (no features) still get zeros.
    zeros = F.array_repeat(F.array_repeat(F.lit(0.0), m.n_float), forest.dims)
    return S.join_on_keys(rows, nested, keys, "left").withColumn(out_col, F.coalesce(F.col(out_col), zeros))


def explanation(phi: Column, explainer: Explainer) -> Column:
    """ARRAY<STRUCT<class, raw, bias, contributions ARRAY<STRUCT<feature, name, phi>>>>.

    Contributions are ranked by |phi| descending, ties by feature index. The
    expression has the same size for any number of features and classes.
    """
    names = F.array(*[F.lit(n) for n in explainer.feature_names])
    classes = F.array(*[F.lit(c) for c in explainer.class_names])
    bias = F.array(*[F.lit(float(b)) for b in explainer.bias])

    def ranked(row: Column) -> Column:
        keyed = F.transform(row, lambda v, i: F.struct((-F.abs(v)).alias("by"), i.alias("feature"), v.alias("phi")))
        return F.transform(
            F.sort_array(keyed),
            lambda e: F.struct(e["feature"].alias("feature"), F.get(names, e["feature"]).alias("name"), e["phi"].alias("phi")),
        )

    return F.transform(
        phi,
        lambda row, c: F.struct(
            F.get(classes, c).alias("class"),
            (F.aggregate(row, F.lit(0.0), lambda a, v: a + v) + F.get(bias, c)).alias("raw"),
            F.get(bias, c).alias("bias"),
            ranked(row).alias("contributions"),
        ),
    )


def sidecar_explainer(
    sidecars, tables, model_id: str, shap_id: str | None = None, feature_names: list[str] | None = None, class_names: list[str] | None = None
) -> Explainer:
    """An explainer whose leaf walk and table come from a decoded sidecar.

    The sidecar's own splits and borders decide the leaf (as its readers do);
    names and class labels come from the paired model, or are given. Several
    models may share the sidecar ``shap_id`` (default: the model's own id).
    """
    from ..plans.compiled import model_header
    from ..sources.sidecar import compatibility

    shap_id = shap_id or model_id
    spark = sidecars.headers.sparkSession
    pair = spark.createDataFrame([(model_id, shap_id)], "model_id string, shap_id string")
    found = compatibility(sidecars, tables, pair).collect()[0]
    if not found["compatible"]:
        raise (KeyError if found["reason"] == "NO_SIDECAR" else ValueError)(
            f"sidecar {shap_id!r} does not match model {model_id!r}: {found['reason']}"
        )
    header = model_header(tables, model_id)
    h = sidecars.headers.filter(F.col("model_id") == shap_id).first()
    mine = F.col("model_id") == shap_id
    forest = Forest(
        h["n_trees"], h["depth"], h["n_classes"], [("float", i) for i in range(header.n_float)],
        sidecars.splits.filter(mine), None, [sidecars.shap.filter(mine)],
    )
    return Explainer(header, forest, list(h["bias"]), shap_id, feature_names, class_names)


def attached_explainers(sidecars, tables, attachments: DataFrame) -> dict[str, Explainer]:
    """One explainer per row of ``attachments`` (model_id, shap_id); models of one sidecar share its table.

    Fails on the first pair that does not match, with its reason.
    """
    first: dict[str, Explainer] = {}
    out = {}
    for model_id, shap_id in attachments.select("model_id", "shap_id").collect():  # one row per model
        own = sidecar_explainer(sidecars, tables, model_id, shap_id)
        out[model_id] = first[shap_id].named(own.header) if shap_id in first else first.setdefault(shap_id, own)
    return out


def explainable(tables, shap: DataFrame) -> DataFrame:
    """(model_id, has_explainer): whether the SHAP table holds rows of the model."""
    known = shap.select("model_id").distinct().withColumn("has_explainer", F.lit(True))
    return tables.models.select("model_id").join(known, "model_id", "left").select("model_id", F.coalesce("has_explainer", F.lit(False)).alias("has_explainer"))
