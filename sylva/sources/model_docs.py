"""Model documents as Spark tables (A1-A5).

A model document is the JSON export of an oblivious-tree ensemble. One Spark
job reads any number of them (a directory, a glob, or a column of document
text) with an explicit schema and explodes them into long tables keyed by
``model_id``:

* ``models``       one row per model: loss, scale, bias, counts, labels, metadata
* ``splits``       one row per (model, tree, level)
* ``leaves``       one row per (model, tree, leaf): K values and the leaf weight
* ``features``     one row per (model, position): name, kind, per-kind index
* ``target_stats`` one row per (model, stat, category key)
* ``rejected``     one row per document that failed to parse or validate

Documents are small (a few MB for a large model), so none of this is on the
data path. The tables are what the scoring, explanation and metadata operators
join against.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

_FEATURE = T.StructType(
    [
        T.StructField("feature_id", T.StringType()),
        T.StructField("flat_feature_index", T.IntegerType()),
    ]
)
_SPLIT = T.StructType(
    [
        T.StructField("split_type", T.StringType()),
        T.StructField("float_feature_index", T.IntegerType()),
        T.StructField("cat_feature_index", T.IntegerType()),
        T.StructField("border", T.DoubleType()),
        T.StructField("value", T.StringType()),
        T.StructField("stat_id", T.IntegerType()),
    ]
)
_TREE = T.StructType(
    [
        T.StructField("splits", T.ArrayType(_SPLIT)),
        T.StructField("leaf_values", T.ArrayType(T.DoubleType())),
        T.StructField("leaf_weights", T.ArrayType(T.DoubleType())),
    ]
)
_STAT = T.StructType(
    [
        T.StructField("stat_id", T.IntegerType()),
        T.StructField("cat_feature_index", T.IntegerType()),
        T.StructField("prior", T.DoubleType()),
        T.StructField("prior_weight", T.DoubleType()),
        T.StructField("keys", T.ArrayType(T.StringType())),
        T.StructField("sums", T.ArrayType(T.DoubleType())),
        T.StructField("counts", T.ArrayType(T.DoubleType())),
    ]
)

# The document schema. ``scale_and_bias`` mixes a number with an array, so it
# is read as JSON text and taken apart with get_json_object.
MODEL_SCHEMA = T.StructType(
    [
        T.StructField("model_id", T.StringType()),
        T.StructField("loss_function", T.StringType()),
        T.StructField(
            "features_info",
            T.StructType(
                [
                    T.StructField("float_features", T.ArrayType(_FEATURE)),
                    T.StructField("categorical_features", T.ArrayType(_FEATURE)),
                ]
            ),
        ),
        T.StructField("oblivious_trees", T.ArrayType(_TREE)),
        T.StructField("scale_and_bias", T.StringType()),
        T.StructField("target_stats", T.ArrayType(_STAT)),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        # a library export keeps its metadata here; nested values arrive as JSON text
        T.StructField("model_info", T.MapType(T.StringType(), T.StringType())),
    ]
)

# Split kinds: ours are the short names, the long ones are accepted as aliases.
SPLIT_KINDS = {
    "float": "float",
    "FloatFeature": "float",
    "onehot": "onehot",
    "target_stat": "target_stat",
}


@dataclass
class ModelTables:
    """Long tables for a set of models; every table carries ``model_id``."""

    models: DataFrame
    splits: DataFrame
    leaves: DataFrame
    features: DataFrame
    target_stats: DataFrame
    rejected: DataFrame

    def only(self, *model_ids: str) -> "ModelTables":
        keep = F.col("model_id").isin(list(model_ids))
        return ModelTables(
            *(getattr(self, n).filter(keep) for n in ("models", "splits", "leaves", "features", "target_stats", "rejected"))
        )

    def cache(self) -> "ModelTables":
        for n in ("models", "splits", "leaves", "features", "target_stats"):
            getattr(self, n).cache()
        return self


def read_model_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A1: read model documents from files; ``model_id`` defaults to the file stem."""
    schema = T.StructType(MODEL_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])
    raw = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
    stem = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(\.json)?$", 1)
    return raw.withColumn("model_id", F.coalesce(F.col("model_id"), stem))


def parse_model_column(df: DataFrame, doc_col: str = "doc", id_col: str = "model_id") -> DataFrame:
    """A2: model documents held as text in a table column (one per row)."""
    parsed = F.from_json(F.col(doc_col), MODEL_SCHEMA, {"mode": "PERMISSIVE"})
    return df.select(
        F.col(id_col).alias("__id"),
        parsed.alias("__m"),
        F.col(doc_col).alias("__doc"),
    ).select(
        F.coalesce(F.col("__id"), F.col("__m.model_id")).alias("model_id"),
        *[F.col(f"__m.{f.name}").alias(f.name) for f in MODEL_SCHEMA.fields if f.name != "model_id"],
        F.when(F.col("__m").isNull() | F.col("__m.oblivious_trees").isNull(), F.col("__doc")).alias(CORRUPT),
    )


def models_from_texts(spark: SparkSession, docs: dict[str, str]) -> DataFrame:
    """Build a document DataFrame from in-memory JSON texts (e.g. package files)."""
    df = spark.createDataFrame(list(docs.items()), "model_id string, doc string")
    return parse_model_column(df)


def pow2(c: Column) -> Column:
    """2^c for a small integer column (shiftleft takes only a literal shift)."""
    return F.pow(F.lit(2.0), c).cast("int")


def _depth(tree: Column) -> Column:
    return F.size(tree["splits"])


#: Why a document is refused: the code of its first fault, and what it says.
REASONS = {
    "UNPARSEABLE": "unparseable document",
    "NO_TREES": "model has no trees",
    "LEAF_SHAPE": "leaf_values or leaf_weights do not match 2^depth",
    "HASHED_ONEHOT": "one-hot splits hold hashed categories, which cannot be compared with text",
    "BAD_SPLIT": "split refers to an unknown feature or split type",
    "BARE_SPLIT": "categorical split without its value, or without its statistic and border",
    "BIAS_SHAPE": "bias size differs from leaf dimension",
}


def _reject_code(doc: DataFrame) -> Column:
    """A4/A5: the code of the first reason a document cannot be used, or null."""
    trees = F.col("oblivious_trees")
    n_float = F.coalesce(F.size("features_info.float_features"), F.lit(0))
    n_cat = F.coalesce(F.size("features_info.categorical_features"), F.lit(0))
    first_leaves = F.size(trees[0]["leaf_values"])
    k = (first_leaves / pow2(F.size(trees[0]["splits"]))).cast("int")
    bias = F.from_json(F.get_json_object("scale_and_bias", "$[1]"), "array<double>")
    bad_shape = F.exists(
        trees,
        lambda t: (F.size(t["leaf_values"]) % pow2(_depth(t)) != 0)
        | (F.size(t["leaf_values"]) != k * pow2(_depth(t)))
        | (F.size(t["leaf_weights"]) != pow2(_depth(t))),
    )
    bad_index = F.exists(
        trees,
        lambda t: F.exists(
            t["splits"],
            lambda s: F.when(
                F.coalesce(s["split_type"], F.lit("float")).isin("float", "FloatFeature"),
                s["float_feature_index"].isNull()
                | (s["float_feature_index"] < 0)
                | (s["float_feature_index"] >= n_float)
                | s["border"].isNull(),
            ).otherwise(
                s["cat_feature_index"].isNull()
                | (s["cat_feature_index"] < 0)
                | (s["cat_feature_index"] >= n_cat)
                | ~F.coalesce(s["split_type"], F.lit("")).isin(*SPLIT_KINDS)
            ),
        ),
    )
    any_split = lambda test: F.exists(trees, lambda t: F.exists(t["splits"], test))
    bare = any_split(
        lambda s: ((s["split_type"] == "onehot") & s["value"].isNull())
        | ((s["split_type"] == "target_stat") & (s["stat_id"].isNull() | s["border"].isNull()))
    )
    tests = {
        "UNPARSEABLE": F.col(CORRUPT).isNotNull() | trees.isNull(),
        "NO_TREES": F.size(trees) == 0,
        "LEAF_SHAPE": bad_shape,
        "HASHED_ONEHOT": any_split(lambda s: F.coalesce(s["split_type"] == "OneHotFeature", F.lit(False))),
        "BAD_SPLIT": bad_index,
        "BARE_SPLIT": bare,
        "BIAS_SHAPE": F.coalesce(F.size(bias), F.lit(-1)) != k,
    }
    return F.coalesce(*[F.when(test, F.lit(code)) for code, test in tests.items()])


def explode_models(doc: DataFrame, on_error: str = "reject") -> ModelTables:
    """A3: explode parsed documents into long tables.

    ``on_error='reject'`` routes bad documents to ``rejected``; ``'raise'``
    fails the job when any document is bad.
    """
    from ..session import ship_package

    ship_package(doc.sparkSession)
    if CORRUPT not in doc.columns:
        doc = doc.withColumn(CORRUPT, F.lit(None).cast("string"))
    # Parse and validate once: every table below reads this cached result, so
    # the document text is not re-parsed per table or per referenced field.
    checked = doc.withColumn("__code", _reject_code(doc)).cache()
    texts = F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair])
    checked = checked.withColumn("__reason", F.when(F.col("__code").isNotNull(), F.element_at(texts, F.col("__code"))))
    if on_error == "raise":
        checked = checked.withColumn(
            "__reason",
            F.when(
                F.col("__reason").isNotNull(),
                F.raise_error(F.concat(F.lit("cannot load model "), F.coalesce("model_id", F.lit("?")), F.lit(": "), F.col("__reason"))),
            ),
        )
    elif on_error != "reject":
        raise ValueError("on_error must be 'reject' or 'raise'")
    rejected = checked.filter(F.col("__reason").isNotNull()).select(
        "model_id", F.col("__reason").alias("reason"), F.col("__code").alias("code")
    )
    good = checked.filter(F.col("__reason").isNull()).drop("__reason", "__code", CORRUPT)

    trees = good.select("model_id", F.posexplode("oblivious_trees").alias("tree", "t"))
    k_col = (F.size("t.leaf_values") / pow2(F.size("t.splits"))).cast("int")

    splits = trees.select(
        "model_id", "tree", F.posexplode("t.splits").alias("level", "s")
    ).select(
        "model_id",
        F.col("tree").cast("int").alias("tree"),
        F.col("level").cast("int").alias("level"),
        F.coalesce(
            F.element_at(F.create_map(*[F.lit(x) for kv in SPLIT_KINDS.items() for x in kv]), F.col("s.split_type")),
            F.lit("float"),
        ).alias("split_type"),
        F.coalesce("s.float_feature_index", "s.cat_feature_index").alias("feature"),
        F.col("s.border").cast("float").alias("border"),
        F.col("s.value").alias("value"),
        F.col("s.stat_id").alias("stat_id"),
    )

    leaves = (
        trees.select(
            "model_id",
            F.col("tree").cast("int").alias("tree"),
            k_col.alias("k"),
            F.col("t.leaf_values").alias("lv"),
            F.posexplode("t.leaf_weights").alias("leaf", "weight"),
        )
        .select(
            "model_id",
            "tree",
            F.col("leaf").cast("int").alias("leaf"),
            F.slice("lv", F.col("leaf") * F.col("k") + 1, F.col("k")).alias("values"),
            F.col("weight").cast("double").alias("weight"),
        )
    )

    float_feats = good.select(
        "model_id", F.posexplode("features_info.float_features").alias("kind_index", "f")
    ).select("model_id", F.lit("float").alias("kind"), "kind_index", "f")
    cat_feats = good.select(
        "model_id", F.posexplode_outer("features_info.categorical_features").alias("kind_index", "f")
    ).filter(F.col("f").isNotNull()).select("model_id", F.lit("cat").alias("kind"), "kind_index", "f")
    n_float = F.size("features_info.float_features")
    feats = float_feats.unionByName(cat_feats)
    features = feats.select(
        "model_id",
        F.coalesce(
            F.col("f.flat_feature_index"),
            F.when(F.col("kind") == "float", F.col("kind_index")),
        ).cast("int").alias("position"),
        F.col("f.feature_id").alias("raw_name"),
        "kind",
        F.col("kind_index").cast("int").alias("kind_index"),
    )
    # Cat features without a flat index follow the floats.
    features = features.join(good.select("model_id", n_float.alias("__nf")), "model_id").select(
        "model_id",
        F.coalesce("position", F.col("__nf") + F.col("kind_index")).alias("position"),
        # Unnamed features are exported with an empty id; they are known by position.
        F.when(F.coalesce("raw_name", F.lit("")) == "", F.coalesce("position", F.col("__nf") + F.col("kind_index")).cast("string"))
        .otherwise(F.col("raw_name"))
        .alias("name"),
        "kind",
        "kind_index",
    )

    stats = good.select("model_id", F.explode("target_stats").alias("st")).select(
        "model_id",
        F.col("st.stat_id").alias("stat_id"),
        F.col("st.cat_feature_index").alias("cat_index"),
        F.col("st.prior").alias("prior"),
        F.col("st.prior_weight").alias("prior_weight"),
        F.arrays_zip(
            F.col("st.keys").alias("key"), F.col("st.sums").alias("sum"), F.col("st.counts").alias("count")
        ).alias("z"),
    )
    target_stats = stats.select(
        "model_id", "stat_id", "cat_index", "prior", "prior_weight", F.explode_outer("z").alias("e")  # a statistic without keys keeps its prior
    ).select(
        "model_id",
        "stat_id",
        "cat_index",
        F.col("e.key").alias("key"),
        # Smoothed target statistic: (sum + a * prior) / (count + a).
        ((F.col("e.sum") + F.col("prior_weight") * F.col("prior")) / (F.col("e.count") + F.col("prior_weight"))).alias(
            "value"
        ),
        F.col("prior").alias("prior_value"),
    )

    good = good.withColumn("metadata", F.coalesce("metadata", "model_info", F.create_map().cast("map<string,string>")))
    class_json = F.get_json_object(F.try_element_at("metadata", F.lit("class_params")), "$.class_names")
    loss = F.get_json_object(F.try_element_at("metadata", F.lit("params")), "$.loss_function")
    models = good.select(
        "model_id",
        # exports name the loss in their training parameters, as text or as {"type": ...}
        F.coalesce("loss_function", F.get_json_object(loss, "$.type"), loss).alias("loss_function"),
        F.get_json_object("scale_and_bias", "$[0]").cast("double").alias("scale"),
        F.from_json(F.get_json_object("scale_and_bias", "$[1]"), "array<double>").alias("bias"),
        n_float.alias("n_float"),
        F.coalesce(F.size("features_info.categorical_features"), F.lit(0)).alias("n_cat"),
        F.size("oblivious_trees").alias("n_trees"),
        (F.size(F.col("oblivious_trees")[0]["leaf_values"]) / pow2(F.size(F.col("oblivious_trees")[0]["splits"])))
        .cast("int")
        .alias("dims"),
        F.array_max(F.transform("oblivious_trees", lambda t: F.size(t["splits"]))).alias("max_depth"),
        F.from_json(class_json, "array<string>").alias("class_names"),
        F.when(class_json.isNull(), F.lit(None))
        .when(class_json.rlike(r'^\s*\[\s*"'), F.lit("string"))
        .otherwise(F.lit("int"))
        .alias("label_kind"),
        "metadata",
    )
    return ModelTables(models, splits, leaves, features, target_stats, rejected)


def load_models(spark: SparkSession, path: str | list[str], on_error: str = "reject") -> ModelTables:
    """A1 + A3: one job loads every model document under ``path``."""
    return explode_models(read_model_files(spark, path), on_error)


def load_model_texts(spark: SparkSession, docs: dict[str, str], on_error: str = "reject") -> ModelTables:
    """A2 + A3: model documents given as text, keyed by model id."""
    return explode_models(models_from_texts(spark, docs), on_error)
