"""

Every query reads the given tables (orders, customer, part, embeddings) and
scores, links, explains or checks *all* of their rows with the model documents
in ``sylva/fixtures``. The oracle SQL walks the same trees in DuckDB from
``VALUES`` tables rendered from the same documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva import catalog
from sylva import oracle as O

try:
    import corpus_pipeline
    from sylva.llm import queries as llm
except ImportError as e:
    if e.name not in ("corpus_pipeline", "sylva.llm"):
        raise
    llm = None

SF_SMOKE = "/root/testdata/sf0.001"

# ---------------------------------------------------------------------------
# Inputs
# ---------------------------------------------------------------------------

#: Length of the vectors in ``embeddings``: m3 takes all of it.
N_EMB = 64
M1_FLOATS = ["o_totalprice", "c_acctbal", "c_nationkey", "o_month"]
M2_FLOATS = ["o_totalprice", "c_acctbal"]
M2_CATS = ["o_orderpriority", "c_mktsegment"]
PART_FLOATS = ["p_size", "p_retailprice"]

ORDERS_ROWS_SQL = (
    "SELECT o.o_orderkey AS row_key, CAST(o.o_totalprice AS FLOAT) AS f0, CAST(c.c_acctbal AS FLOAT) AS f1, "
    "CAST(c.c_nationkey AS FLOAT) AS f2, CAST(month(o.o_orderdate) AS FLOAT) AS f3, "
    "o.o_orderpriority AS c0, c.c_mktsegment AS c1 "
    "FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"
)
ORDERS_ROWS_NULLS_SQL = (
    "SELECT o.o_orderkey AS row_key, "
    "COALESCE(CASE WHEN o.o_orderkey % 7 = 0 THEN NULL WHEN o.o_orderkey % 11 = 0 THEN CAST('NaN' AS FLOAT) ELSE CAST(o.o_totalprice AS FLOAT) END, 0) AS f0, "
    "COALESCE(CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE CAST(c.c_acctbal AS FLOAT) END, 0) AS f1, "
    "CAST(c.c_nationkey AS FLOAT) AS f2, "
    "COALESCE(CASE WHEN o.o_orderkey % 13 = 0 THEN CAST('NaN' AS FLOAT) ELSE CAST(month(o.o_orderdate) AS FLOAT) END, 0) AS f3 "
    "FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"
)
PART_ROWS_SQL = "SELECT p_partkey AS row_key, CAST(p_size AS FLOAT) AS f0, CAST(p_retailprice AS FLOAT) AS f1 FROM part"
EMB_ROWS_SQL = (
    "SELECT vec_id AS row_key, " + ", ".join(f"CAST(embedding[{i + 1}] AS FLOAT) AS f{i}" for i in range(N_EMB)) + " FROM embeddings"
)


def orders_rows(spark: SparkSession, sf: str) -> DataFrame:
    o = spark.read.parquet(f"{sf}/orders.parquet")
    c = spark.read.parquet(f"{sf}/customer.parquet")
    return o.join(c, o.o_custkey == c.c_custkey, "left").select(
        "o_orderkey",
        "o_totalprice",
        "c_acctbal",
        "c_nationkey",
        F.month("o_orderdate").alias("o_month"),
        "o_orderpriority",
        "c_mktsegment",
    )


def part_rows(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", "p_size", "p_retailprice")


def emb_rows(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/embeddings.parquet").select(
        "vec_id", F.col("embedding").alias("x")
    )


def _long(df: DataFrame, key: str, col: str, name: str, digits: int | None = None) -> DataFrame:
    out = df.select(key, F.posexplode(col).alias("class_idx", name))
    out = out.withColumn("class_idx", F.col("class_idx").cast("int"))
    if digits is not None:
        out = out.withColumn(name, F.round(name, digits) + 0.0)  # + 0.0 folds -0.0 into 0.0
    return out


# ---------------------------------------------------------------------------
# Scoring (D1, D2, D12, D13, T3/T4)
# ---------------------------------------------------------------------------


def q_score_raw(spark, sf):
    m = catalog.model(spark, "m1")
    return _long(m.raw(orders_rows(spark, sf), keep=["o_orderkey"]), "o_orderkey", "raw", "raw")


def q_score_raw_relational(spark, sf):
    m = catalog.model(spark, "m1")
    return m.raw_long(orders_rows(spark, sf), keys=["o_orderkey"]).select("o_orderkey", "class_idx", "raw")


def q_leaf_index(spark, sf):
    m = catalog.model(spark, "m1")
    return m.leaf_index(orders_rows(spark, sf), keep=["o_orderkey"]).select(
        "o_orderkey", F.posexplode("leaves").alias("tree", "leaf")
    ).withColumn("tree", F.col("tree").cast("int"))


def q_score_categorical(spark, sf):
    m = catalog.model(spark, "m2")
    return _long(m.raw(orders_rows(spark, sf), keep=["o_orderkey"]), "o_orderkey", "raw", "raw")


def q_score_many_models(spark, sf):
    from sylva.plans.model import score_many

    return score_many(orders_rows(spark, sf), catalog.tables(spark), ["m1", "m2"], ["o_orderkey"]).select(
        "model_id", "o_orderkey", "class_idx", "raw"
    )


def q_score_many_models_dense(spark, sf):
    from sylva.plans.model import score_many_dense

    return score_many_dense(orders_rows(spark, sf), catalog.tables(spark), ["m1", "m2"], ["o_orderkey"]).select(
        "model_id", "o_orderkey", "class_idx", "raw"
    )


def q_null_and_nan_features(spark, sf):
    m = catalog.model(spark, "m1")
    k = F.col("o_orderkey")
    rows = orders_rows(spark, sf).select(
        "o_orderkey",
        F.when(k % 7 == 0, None).when(k % 11 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(k % 5 == 0, None).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        "c_nationkey",
        F.when(k % 13 == 0, F.lit(float("nan"))).otherwise(F.col("o_month").cast("double")).alias("o_month"),
    )
    return _long(m.raw(rows, null_mode="zero", nan_mode="min"), "o_orderkey", "raw", "raw")


def q_named_map_rows(spark, sf):
    m = catalog.model(spark, "m4")
    rows = part_rows(spark, sf).select(
        "p_partkey",
        F.create_map(
            F.lit("p_size"), F.col("p_size").cast("double"), F.lit("p_retailprice"), F.col("p_retailprice")
        ).alias("row"),
    )
    return _long(m.raw(rows, row_map="row"), "p_partkey", "raw", "raw")


def q_positional_rows(spark, sf):
    m = catalog.model(spark, "m3")
    return _long(m.raw(emb_rows(spark, sf), features="x"), "vec_id", "raw", "raw")


def q_arity_quarantine(spark, sf):
    from sylva.functions.features import arity_quarantine

    # Rows whose positional array is too long, or null, are set aside, not scored.
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    longer = F.concat("embedding", F.array(F.lit(0.0).cast("float")))
    rows = e.select("vec_id", F.when(F.col("vec_id") % 3 == 0, longer).when(F.col("vec_id") % 5 != 0, F.col("embedding")).alias("x"))
    good, bad = arity_quarantine(rows, "x", catalog.model(spark, "m3").header.n_float, ["vec_id"])
    scored = _long(catalog.model(spark, "m3").raw(good, features="x"), "vec_id", "raw", "raw")
    return scored.select("vec_id", "class_idx", "raw", F.lit(None).cast("int").alias("got")).unionByName(
        bad.select("vec_id", F.lit(None).cast("int").alias("class_idx"), F.lit(None).cast("double").alias("raw"), "got")
    )


def q_score_sql_function(spark, sf):
    m = catalog.model(spark, "m1")
    name = m.register_udf(spark, "score_m1")
    orders_rows(spark, sf).createOrReplaceTempView("sylva_m1_rows")
    df = spark.sql(f"SELECT o_orderkey, {name}(o_totalprice, c_acctbal, c_nationkey, o_month) AS raw FROM sylva_m1_rows")
    return _long(df, "o_orderkey", "raw", "raw")


def _raw_oracle(model_id, rows_sql, floats, cats=None, key="o_orderkey"):
    return O.with_clause(O.scoring_ctes(model_id, rows_sql, floats, cats)) + (
        f"SELECT row_key AS {key}, class_idx, raw FROM raw"
    )


F4 = ["f0", "f1", "f2", "f3"]

# ---------------------------------------------------------------------------
# Links (D5-D11)
# ---------------------------------------------------------------------------


def q_link_probability_binary(spark, sf):
    m = catalog.model(spark, "m2")
    return _long(m.predict_proba(orders_rows(spark, sf), keep=["o_orderkey"]), "o_orderkey", "prediction", "p", 6).drop("class_idx")


def q_link_probability_multiclass(spark, sf):
    m = catalog.model(spark, "m1")
    return _long(m.predict_proba(orders_rows(spark, sf), keep=["o_orderkey"]), "o_orderkey", "prediction", "p", 6)


def q_link_multi_probability(spark, sf):
    m = catalog.model(spark, "m3")
    return _long(m.predict_multi_proba(emb_rows(spark, sf), features="x"), "vec_id", "prediction", "p", 6)


def q_link_class(spark, sf):
    m = catalog.model(spark, "m1")
    return _long(m.predict(orders_rows(spark, sf), "Class", keep=["o_orderkey"]), "o_orderkey", "prediction", "class").drop("class_idx")


def q_link_class_binary(spark, sf):
    m = catalog.model(spark, "m2")
    return _long(m.predict(orders_rows(spark, sf), "class", keep=["o_orderkey"]), "o_orderkey", "prediction", "class").drop("class_idx")


def q_link_exponent(spark, sf):
    m = catalog.model(spark, "m4")
    return _long(m.predict(part_rows(spark, sf), "exponent"), "p_partkey", "prediction", "v", 6).drop("class_idx")


def q_link_log_probability(spark, sf):
    m = catalog.model(spark, "m1")
    return _long(m.predict(orders_rows(spark, sf), "LogProbability", keep=["o_orderkey"]), "o_orderkey", "prediction", "v", 6)


def q_link_uncertainty(spark, sf):
    m = catalog.model(spark, "m5")
    p = m.predict(part_rows(spark, sf), "rmse_with_uncertainty")
    return p.select(
        "p_partkey", F.round(p.prediction[0], 6).alias("mean"), F.round(p.prediction[1], 6).alias("variance")
    )


def q_expand_binary(spark, sf):
    from sylva.functions.links import expand_binary

    m = catalog.model(spark, "m2")
    p = m.predict_proba(orders_rows(spark, sf), keep=["o_orderkey"])
    return _long(p.withColumn("pp", expand_binary(F.col("prediction"))), "o_orderkey", "pp", "p", 6)


def q_threshold_labels(spark, sf):
    from sylva.functions.links import threshold_labels

    m = catalog.model(spark, "m3")
    p = m.predict_multi_proba(emb_rows(spark, sf), features="x")
    return _long(p.withColumn("lab", threshold_labels(F.col("prediction"), 0.5)), "vec_id", "lab", "label")


def q_top_class_label(spark, sf):
    from sylva.functions.links import argmax_class, class_label
    from sylva.operators.metadata import labels_or_indexes
    from sylva.plans.model import raw_many

    # Both models in one step; each row takes its labels from its model's row of the models table.
    tables = catalog.tables(spark)
    raws = raw_many(orders_rows(spark, sf), tables, ["m1", "m1i"], ["o_orderkey"])
    labels = tables.models.filter(F.col("model_id").isin("m1", "m1i")).select(
        "model_id", labels_or_indexes(F.col("class_names"), F.col("dims")).alias("labels")
    )
    return raws.join(F.broadcast(labels), "model_id").select(  # one row per model
        "model_id", "o_orderkey", class_label(argmax_class(F.col("raw")), F.col("labels")).alias("label")
    )


def _link_oracle(model_id, rows_sql, floats, select_sql, cats=None):
    return O.with_clause(O.scoring_ctes(model_id, rows_sql, floats, cats)) + select_sql


SOFTMAX_SQL = (
    "sm AS (SELECT row_key, class_idx, raw, MAX(raw) OVER (PARTITION BY row_key) AS mx FROM raw), "
    "se AS (SELECT row_key, class_idx, raw, mx, EXP(raw - mx) AS e, SUM(EXP(raw - mx)) OVER (PARTITION BY row_key) AS tot FROM sm) "
)


def _softmax_oracle(model_id, rows_sql, floats, key, value_sql, name):
    base = O.with_clause(O.scoring_ctes(model_id, rows_sql, floats))
    return base.rstrip("\n") + ",\n" + SOFTMAX_SQL + f"SELECT row_key AS {key}, class_idx, ROUND({value_sql}, 6) + 0.0 AS {name} FROM se"


def _argmax_sql(key: str) -> str:
    return (
        f"SELECT row_key AS {key}, CAST(MIN(class_idx) FILTER (WHERE raw = mx) AS DOUBLE) AS class FROM "
        "(SELECT row_key, class_idx, raw, MAX(raw) OVER (PARTITION BY row_key) AS mx FROM raw) GROUP BY row_key"
    )


def _oracles_scoring() -> dict[str, str]:
    orders_cats = ["c0", "c1"]
    return {
        "score_raw": _raw_oracle("m1", ORDERS_ROWS_SQL, F4),
        "score_raw_relational": _raw_oracle("m1", ORDERS_ROWS_SQL, F4),
        "leaf_index": O.with_clause(O.scoring_ctes("m1", ORDERS_ROWS_SQL, F4))
        + "SELECT row_key AS o_orderkey, CAST(tree AS INTEGER) AS tree, leaf FROM leafidx",
        "score_categorical": _raw_oracle("m2", ORDERS_ROWS_SQL, ["f0", "f1"], orders_cats),
        "score_many_models": "SELECT * FROM ("
        + _raw_oracle("m1", ORDERS_ROWS_SQL, F4).replace("SELECT row_key AS o_orderkey", "SELECT 'm1' AS model_id, row_key AS o_orderkey")
        + ") UNION ALL SELECT * FROM ("
        + _raw_oracle("m2", ORDERS_ROWS_SQL, ["f0", "f1"], orders_cats).replace(
            "SELECT row_key AS o_orderkey", "SELECT 'm2' AS model_id, row_key AS o_orderkey"
        )
        + ")",
        "null_and_nan_features": _raw_oracle("m1", ORDERS_ROWS_NULLS_SQL, F4),
        "named_map_rows": _raw_oracle("m4", PART_ROWS_SQL, ["f0", "f1"], key="p_partkey"),
        "positional_rows": _raw_oracle("m3", EMB_ROWS_SQL, [f"f{i}" for i in range(N_EMB)], key="vec_id"),
        "score_sql_function": _raw_oracle("m1", ORDERS_ROWS_SQL, F4),
        "arity_quarantine": O.with_clause(
            O.scoring_ctes("m3", EMB_ROWS_SQL + " WHERE vec_id % 3 <> 0 AND vec_id % 5 <> 0", [f"f{i}" for i in range(N_EMB)])
        )
        + "SELECT row_key AS vec_id, class_idx, raw, CAST(NULL AS INTEGER) AS got FROM raw "
        "UNION ALL SELECT vec_id, CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE), CASE WHEN vec_id % 3 = 0 THEN 65 ELSE -1 END FROM embeddings WHERE vec_id % 3 = 0 OR vec_id % 5 = 0",
        "link_probability_binary": _link_oracle(
            "m2", ORDERS_ROWS_SQL, ["f0", "f1"],
            "SELECT row_key AS o_orderkey, ROUND(1.0 / (1.0 + EXP(-raw)), 6) AS p FROM raw", orders_cats,
        ),
        "link_probability_multiclass": _softmax_oracle("m1", ORDERS_ROWS_SQL, F4, "o_orderkey", "e / tot", "p"),
        "link_multi_probability": _link_oracle(
            "m3", EMB_ROWS_SQL, [f"f{i}" for i in range(N_EMB)],
            "SELECT row_key AS vec_id, class_idx, ROUND(1.0 / (1.0 + EXP(-raw)), 6) AS p FROM raw",
        ),
        "link_class": _link_oracle("m1", ORDERS_ROWS_SQL, F4, _argmax_sql("o_orderkey")),
        "link_class_binary": _link_oracle(
            "m2", ORDERS_ROWS_SQL, ["f0", "f1"],
            "SELECT row_key AS o_orderkey, CASE WHEN raw > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS class FROM raw", orders_cats,
        ),
        "link_exponent": _link_oracle(
            "m4", PART_ROWS_SQL, ["f0", "f1"], "SELECT row_key AS p_partkey, ROUND(EXP(raw), 6) AS v FROM raw"
        ),
        "link_log_probability": _softmax_oracle("m1", ORDERS_ROWS_SQL, F4, "o_orderkey", "raw - mx - LN(tot)", "v"),
        "link_uncertainty": _link_oracle(
            "m5", PART_ROWS_SQL, ["f0", "f1"],
            "SELECT row_key AS p_partkey, ROUND(MAX(raw) FILTER (WHERE class_idx = 0), 6) AS mean, "
            "ROUND(EXP(2.0 * MAX(raw) FILTER (WHERE class_idx = 1)), 6) AS variance FROM raw GROUP BY row_key",
        ),
        "expand_binary": _link_oracle(
            "m2", ORDERS_ROWS_SQL, ["f0", "f1"],
            "SELECT row_key AS o_orderkey, 0 AS class_idx, ROUND(1.0 - 1.0 / (1.0 + EXP(-raw)), 6) AS p FROM raw "
            "UNION ALL SELECT row_key, 1, ROUND(1.0 / (1.0 + EXP(-raw)), 6) FROM raw", orders_cats,
        ),
        "threshold_labels": _link_oracle(
            "m3", EMB_ROWS_SQL, [f"f{i}" for i in range(N_EMB)],
            "SELECT row_key AS vec_id, class_idx, CAST(1.0 / (1.0 + EXP(-raw)) >= 0.5 AS INTEGER) AS label FROM raw",
        ),
        "top_class_label": "SELECT * FROM ("
        + _link_oracle("m1", ORDERS_ROWS_SQL, F4, "SELECT 'm1' AS model_id, o_orderkey, ['F','O','P'][CAST(class AS INTEGER) + 1] AS label FROM (" + _argmax_sql("o_orderkey") + ")")
        + ") UNION ALL SELECT * FROM ("
        + _link_oracle("m1i", ORDERS_ROWS_SQL, F4, "SELECT 'm1i' AS model_id, o_orderkey, ['0','1','2'][CAST(class AS INTEGER) + 1] AS label FROM (" + _argmax_sql("o_orderkey") + ")")
        + ")",
    }


# ---------------------------------------------------------------------------
# Explanation
# ---------------------------------------------------------------------------


def _phi_long(df: DataFrame, key: str, names: list[str]) -> DataFrame:
    """(key, class_idx, feature name, phi rounded to 6 places) from phi K x F."""
    fnames = F.array(*[F.lit(n) for n in names])
    per_class = df.select(key, F.posexplode("phi").alias("class_idx", "row"))
    return per_class.select(
        key,
        F.col("class_idx").cast("int").alias("class_idx"),
        F.posexplode("row").alias("fi", "v"),
    ).select(key, "class_idx", F.element_at(fnames, F.col("fi") + 1).alias("feature"), (F.round("v", 6) + 0.0).alias("phi"))


def q_explain_contributions(spark, sf):
    m = catalog.model(spark, "m1")
    return _phi_long(m.explain(orders_rows(spark, sf), keep=["o_orderkey"]), "o_orderkey", M1_FLOATS)


def q_explain_relational(spark, sf):
    m = catalog.model(spark, "m4")
    out = m.explain(part_rows(spark, sf), plan="relational", keys=["p_partkey"])
    return _phi_long(out, "p_partkey", PART_FLOATS)


def q_explain_ranked(spark, sf):
    # Ranks go by |phi| as computed; a tie at 9 places goes by the feature's index on both sides.
    ex = catalog.model(spark, "m1").explain(orders_rows(spark, sf), keep=["o_orderkey"])
    per_class = ex.select("o_orderkey", F.posexplode("explanation").alias("class_idx", "e"))
    ranked = F.sort_array(
        F.transform(
            "e.contributions",
            lambda c: F.struct((-F.round(F.abs(c["phi"]), 9)).alias("by"), c["feature"].alias("i"), c["name"].alias("name"), c["phi"].alias("phi")),
        )
    )
    return per_class.select(
        "o_orderkey", F.col("class_idx").cast("int").alias("class_idx"), F.posexplode(ranked).alias("rank", "c")
    ).select(
        "o_orderkey", "class_idx", (F.col("rank") + 1).cast("int").alias("rank"), F.col("c.name").alias("feature"),
        (F.round("c.phi", 6) + 0.0).alias("phi"),
    )


def q_shap_additivity(spark, sf):
    # One walk gives the raw scores and the contributions; no nested explanation is built.
    m = catalog.model(spark, "m1")
    both = m.walk(orders_rows(spark, sf), raw="raw", phis={"phi": None}, keep=["o_orderkey"])
    bias = F.array(*[F.lit(b) for b in m.explainer().bias])
    gap = F.zip_with(
        F.zip_with("phi", bias, lambda p, b: F.aggregate(p, b, lambda a, v: a + v)), "raw", lambda told, raw: F.abs(told - raw)
    )
    per_class = both.select("o_orderkey", F.posexplode(F.arrays_zip(F.col("raw").alias("raw"), gap.alias("gap"))).alias("class_idx", "c"))
    return per_class.select(
        "o_orderkey", F.col("class_idx").cast("int").alias("class_idx"), F.col("c.raw").alias("raw"), (F.col("c.gap") <= 1e-9).alias("additive")
    )


def _explain_base(model_id, rows_sql, floats):
    return O.with_clause(O.scoring_ctes(model_id, rows_sql, floats) + O.shap_ctes(model_id, include_model=False) + [
        "contrib AS (SELECT l.row_key, s.class_idx, s.feature, SUM(s.phi) AS phi FROM leafidx l "
        "JOIN shap s ON s.tree = l.tree AND s.leaf = l.leaf GROUP BY l.row_key, s.class_idx, s.feature)"
    ])


def _explain_base_float16(model_id, rows_sql, floats):
    """As ``_explain_base`` but each table value rounded through binary16 (round half to even)."""
    q = "pow(2.0, greatest(floor(log2(abs(phi))), -14) - 10)"
    return O.with_clause(O.scoring_ctes(model_id, rows_sql, floats) + O.shap_ctes(model_id, include_model=False) + [
        f"shap16 AS (SELECT tree, leaf, feature, class_idx, CASE WHEN phi = 0 THEN 0.0 ELSE round_even(phi / {q}, 0) * {q} END AS phi FROM shap)",
        "contrib AS (SELECT l.row_key, s.class_idx, s.feature, SUM(s.phi) AS phi FROM leafidx l "
        "JOIN shap16 s ON s.tree = l.tree AND s.leaf = l.leaf GROUP BY l.row_key, s.class_idx, s.feature)"
    ])


def _names_sql(names):
    return "[" + ", ".join("'" + n + "'" for n in names) + "]"


def _oracles_explain() -> dict[str, str]:
    m1 = _explain_base("m1", ORDERS_ROWS_SQL, F4)
    m4 = _explain_base("m4", PART_ROWS_SQL, ["f0", "f1"])
    return {
        "explain_contributions": m1
        + f"SELECT row_key AS o_orderkey, CAST(class_idx AS INTEGER) AS class_idx, {_names_sql(M1_FLOATS)}[feature + 1] AS feature, "
        "ROUND(phi, 6) + 0.0 AS phi FROM contrib",
        "explain_relational": m4
        + f"SELECT row_key AS p_partkey, CAST(class_idx AS INTEGER) AS class_idx, {_names_sql(PART_FLOATS)}[feature + 1] AS feature, "
        "ROUND(phi, 6) + 0.0 AS phi FROM contrib",
        "explain_ranked": m1
        + "SELECT row_key AS o_orderkey, CAST(class_idx AS INTEGER) AS class_idx, "
        "CAST(ROW_NUMBER() OVER (PARTITION BY row_key, class_idx ORDER BY ROUND(ABS(phi), 9) DESC, feature) AS INTEGER) AS rank, "
        f"{_names_sql(M1_FLOATS)}[feature + 1] AS feature, ROUND(phi, 6) + 0.0 AS phi FROM contrib",
        "sidecar_explain": _explain_base_float16("m1", ORDERS_ROWS_SQL, F4)
        + f"SELECT row_key AS o_orderkey, CAST(class_idx AS INTEGER) AS class_idx, {_names_sql(M1_FLOATS)}[feature + 1] AS feature, "
        "ROUND(phi, 6) + 0.0 AS phi FROM contrib",
        "shap_additivity": m1
        + "SELECT r.row_key AS o_orderkey, CAST(r.class_idx AS INTEGER) AS class_idx, r.raw AS raw, "
        "ABS(x.s + b.bias - r.raw) <= 1e-9 AS additive FROM raw r "
        "JOIN (SELECT row_key, class_idx, SUM(phi) AS s FROM contrib GROUP BY row_key, class_idx) x "
        "ON x.row_key = r.row_key AND x.class_idx = r.class_idx JOIN bias_row b ON b.class_idx = r.class_idx",
    }


# ---------------------------------------------------------------------------
# Sidecars, quantisation and checks
# ---------------------------------------------------------------------------


def _sidecar_model(spark, model_id: str, junk: bool = False):
    """Pack the model's SHAP table, write it under the checkpoint folder (beside a file that is none), read it back."""
    import uuid

    from sylva.operators.treeshap import bias_row, shap_table
    from sylva.session import checkpoint_dir
    from sylva.sources import sidecar as SC

    tables = catalog.tables(spark)
    one = tables.only(model_id)
    out = checkpoint_dir(spark).rstrip("/") + f"/sylva-sidecars-{uuid.uuid4().hex}"
    packed = SC.pack_sidecars(one, shap_table(one), bias_row(one))
    if junk:
        packed = packed.unionByName(spark.createDataFrame([("junk", bytearray(64), 64)], packed.schema))
    SC.write_sidecar_files(packed, out)
    return SC.read_sidecars(spark, out)


def q_sidecar_explain(spark, sf):
    from sylva.operators import explain as X

    m = catalog.model(spark, "m1")
    ex = X.sidecar_explainer(_sidecar_model(spark, "m1"), catalog.tables(spark), "m1")
    out = X.phi_dense(orders_rows(spark, sf).select("o_orderkey", *M1_FLOATS), ex)
    return _phi_long(out, "o_orderkey", M1_FLOATS)


def q_quantized_drift(spark, sf):
    from sylva.operators.checks import max_abs_difference

    # Exact and rounded contributions from one walk of the trees: no join.
    both = catalog.model(spark, "m1").walk(orders_rows(spark, sf), phis={"pe": "exact", "pq": "float16"}, keep=["o_orderkey"])
    drift = max_abs_difference(F.flatten("pe"), F.flatten("pq"))
    return both.select("o_orderkey", F.round(drift, 6).alias("max_drift"), (drift <= 5e-3).alias("within_tolerance"))


def q_parity_report(spark, sf):
    from sylva.operators.checks import parity_report

    # Two independent plans over the same rows, with planted differences that the report has to tell apart.
    k, c = F.col("o_orderkey"), F.col("class_idx")
    dense = q_score_raw(spark, sf).where(k % 97 != 0).withColumn(
        "raw",
        F.when(k % 89 == 0, F.lit(None)).when(k % 83 == 0, F.lit(float("nan"))).when((k % 79 == 0) & (c == 1), F.col("raw") + 0.5).otherwise(F.col("raw")),
    )
    rel = q_score_raw_relational(spark, sf).where(k % 101 != 0).withColumn(
        "raw", F.when((k % 89 == 0) & (c == 0), F.lit(None)).when((k % 83 == 0) & (c == 2), F.lit(float("nan"))).otherwise(F.col("raw"))
    )
    return parity_report(dense, rel, ["o_orderkey", "class_idx"], "raw")


def q_probability_checks(spark, sf):
    from sylva.operators.checks import probabilities_valid

    m1 = catalog.model(spark, "m1").predict_proba(orders_rows(spark, sf), keep=["o_orderkey"])
    m3 = catalog.model(spark, "m3").predict_multi_proba(emb_rows(spark, sf), features="x")
    extremes = [
        F.round(F.min(F.array_min("prediction")), 6).alias("min_p"),
        F.round(F.max(F.array_max("prediction")), 6).alias("max_p"),
    ]
    a = m1.agg(F.lit("m1").alias("model_id"), F.count("*").alias("n_rows"),
               F.count_if(probabilities_valid(F.col("prediction"), True)).alias("n_valid"), *extremes)
    b = m3.agg(F.lit("m3").alias("model_id"), F.count("*").alias("n_rows"),
               F.count_if(probabilities_valid(F.col("prediction"), False)).alias("n_valid"), *extremes)
    return a.unionByName(b)


def q_type_difference(spark, sf):
    from sylva.functions.links import apply_link
    from sylva.operators.checks import max_abs_difference

    m = catalog.model(spark, "m3")
    raw = m.raw(emb_rows(spark, sf), features="x", keep=["vec_id"])
    dims, loss = m.header.dims, m.header.loss_function
    soft, sig = (apply_link(F.col("raw"), t, dims, loss) for t in ("probability", "multi_probability"))
    return raw.select("vec_id", F.round(max_abs_difference(soft, sig), 6).alias("max_diff"))


def q_contribution_checks(spark, sf):
    from sylva.operators.checks import contributions_well_formed

    # Per class and leading feature (a tie at 9 places goes by the feature's index): rows, well-formed rows, range of the lead.
    m = catalog.model(spark, "m1")
    ex = m.explain(orders_rows(spark, sf), keep=["o_orderkey"]).select(F.posexplode("explanation").alias("class_idx", "e"))
    lead = F.array_max(F.transform("e.contributions", lambda c: F.struct(F.round(F.abs(c["phi"]), 9).alias("by"), (-c["feature"]).alias("i"))))
    names = F.array(*[F.lit(n) for n in M1_FLOATS])
    return (
        ex.select(F.col("class_idx").cast("int").alias("class_idx"), "e", lead.alias("lead"))
        .groupBy("class_idx", F.element_at(names, 1 - F.col("lead.i")).alias("top_feature"))
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if(contributions_well_formed(F.col("e.contributions"), len(M1_FLOATS))).alias("n_well_formed"),
            F.round(F.min("lead.by"), 6).alias("min_lead"),
            F.round(F.max("lead.by"), 6).alias("max_lead"),
        )
    )


def q_node_cover(spark, sf):
    from sylva.operators.checks import node_visits
    from sylva.operators.treeshap import node_cover

    m = catalog.model(spark, "m1")
    covers = node_cover(catalog.tables(spark).only("m1")).select("tree", "level", "node", F.round("cover", 6).alias("cover"))
    return node_visits(m.leaf_index(orders_rows(spark, sf), keep=["o_orderkey"]), covers)


# ---------------------------------------------------------------------------
# Models and sidecars that do not fit, and what goes with a prediction (A, B, C, E14-E17)
# ---------------------------------------------------------------------------


def _doubtful_tables(spark):
    """m1 and m2, and three documents that must be refused."""
    import json

    from sylva.fixtures import model_text
    from sylva.sources.model_docs import load_model_texts

    def made():
        text = model_text("m1")
        leaves = json.loads(text)
        leaves["oblivious_trees"][3]["leaf_values"].pop()
        bare = json.loads(model_text("m2"))
        split = next(x for t in bare["oblivious_trees"] for x in t["splits"] if x.get("split_type") == "onehot")
        del split["value"]
        docs = {"m1": text, "m2": model_text("m2"), "cut": text[: len(text) // 2], "leaves": json.dumps(leaves), "bare": json.dumps(bare)}
        return load_model_texts(spark, docs).cache()

    return catalog.kept(spark, "doubtful", made)


WANTED = ["m1", "m2", "cut", "leaves", "bare", "nobody", None]


def q_scores_or_reasons(spark, sf):
    from sylva.plans.model import score_wanted

    rows = orders_rows(spark, sf).withColumn(
        "wanted", F.get(F.array(*[F.lit(w) for w in WANTED]), (F.col("o_orderkey") % len(WANTED)).cast("int"))
    )
    out = score_wanted(rows, _doubtful_tables(spark), "wanted", keep=["o_orderkey"])
    return out.select("o_orderkey", "wanted", "code", F.posexplode_outer("raw").alias("class_idx", "raw")).withColumn(
        "class_idx", F.col("class_idx").cast("int")
    )


def q_map_quarantine(spark, sf):
    from sylva.functions.features import map_quarantine

    k = F.col("p_partkey")
    entry = lambda name, value: F.struct(F.lit(name).alias("k"), value.cast("double").alias("v"))
    entries = F.array(
        entry("p_size", F.col("p_size")),
        F.when(k % 5 != 0, entry("p_retailprice", F.col("p_retailprice"))),
        F.when(k % 7 == 0, entry("colour", F.lit(1))),
    )
    rows = part_rows(spark, sf).select("p_partkey", F.map_from_entries(F.array_compact(entries)).alias("row"))
    m = catalog.model(spark, "m4")
    good, bad = map_quarantine(rows, "row", m.header, ["p_partkey"])
    scored = m.raw(good, row_map="row").select("p_partkey", F.col("raw")[0].alias("raw"))
    return scored.withColumns({"code": F.lit(None).cast("string"), "feature": F.lit(None).cast("string")}).unionByName(
        bad.withColumn("raw", F.lit(None).cast("double"))
    )


def q_unseen_categories(spark, sf):
    k = F.col("o_orderkey")
    rows = orders_rows(spark, sf).withColumns(
        {
            "o_orderpriority": F.when(k % 3 == 0, F.concat(F.lit("no such "), "o_orderpriority")).when(k % 4 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")),
            "c_mktsegment": F.when(k % 5 == 0, F.lit("UNSEEN")).otherwise(F.col("c_mktsegment")),
        }
    )
    return _long(catalog.model(spark, "m2").raw(rows, keep=["o_orderkey"]), "o_orderkey", "raw", "raw")


def q_predictions_with_metadata(spark, sf):
    from sylva.functions.links import argmax_class, class_label, output_dims
    from sylva.operators.explain import explainable
    from sylva.operators.metadata import class_names, feature_listing, metadata_present, metadata_value, model_summary
    from sylva.plans.model import raw_many

    ids = ["m1", "m1i", "m2"]
    tables = catalog.tables(spark).only(*ids)
    md = F.col("metadata")
    facts = (
        tables.models.select(
            "model_id", "dims", class_names(md).alias("names"), metadata_value(md, "model_guid").alias("guid"),
            metadata_present(md, "train_finish_time").alias("has_time"), metadata_present(md, "empty_key").alias("has_empty"),
            metadata_value(md, "empty_key").alias("empty"),
        )
        .join(model_summary(tables).select("model_id", "summary", "float_features_count", "cat_features_count", "tree_count"), "model_id")
        .join(feature_listing(tables).select("model_id", F.concat_ws(",", "all_names").alias("features"), "named"), "model_id")
        .join(explainable(tables, catalog.model(spark, "m1").explainer("exact").shap), "model_id")
    )
    raws = raw_many(orders_rows(spark, sf), tables, ids, ["o_orderkey"])
    top = F.when(F.col("dims") == 1, (F.col("raw")[0] > 0).cast("int")).otherwise(argmax_class(F.col("raw")).cast("int"))
    return raws.join(F.broadcast(facts), "model_id").select(  # one row per model
        "model_id", "o_orderkey", class_label(top, F.col("names")).alias("label"), F.lit(output_dims("class", 3, "MultiClass")).alias("class_dims"),
        F.col("dims").alias("raw_dims"), "float_features_count", "cat_features_count", "tree_count", "summary", "features", "named",
        "guid", "has_time", "has_empty", "empty", "has_explainer",
    )


def q_recorded_parity(spark, sf):
    import uuid

    from sylva.session import checkpoint_dir
    from sylva.sources.recorded import read_recorded, write_recorded

    path = checkpoint_dir(spark).rstrip("/") + f"/recorded-{uuid.uuid4().hex}"
    write_recorded(q_score_raw(spark, sf), path, {"model": "m1"})
    header, rows = read_recorded(spark, path, lines=True)
    again = catalog.model(spark, "m1").raw_long(orders_rows(spark, sf), keys=["o_orderkey"]).select(
        "o_orderkey", "class_idx", F.col("raw").alias("now")
    )
    both = rows.join(again, ["o_orderkey", "class_idx"], "full_outer")
    return both.groupBy(F.col("class_idx").cast("int").alias("class_idx")).agg(
        F.count("*").alias("n_rows"),
        F.count_if(~F.col("raw").eqNullSafe(F.col("now"))).alias("n_off"),
        F.round(F.sum("raw"), 6).alias("sum_raw"),
        F.lit(header.first()["h_model"]).alias("model"),
    )


def _sidecars(spark):
    return catalog.kept(spark, "sidecars", lambda: _sidecar_model(spark, "m1", junk=True))


def q_shared_sidecar_explain(spark, sf):
    from sylva.operators.explain import attached_explainers, explain_many

    pairs = spark.createDataFrame([("m1", "m1"), ("m1i", "m1")], "model_id string, shap_id string")
    explainers = attached_explainers(_sidecars(spark), catalog.tables(spark), pairs)
    out = explain_many(orders_rows(spark, sf), explainers, ["o_orderkey"])
    per_class = out.select("model_id", "o_orderkey", F.explode("explanation").alias("e"))
    return per_class.select("model_id", "o_orderkey", F.col("e.class").alias("class"), F.explode("e.contributions").alias("c")).select(
        "model_id", "o_orderkey", "class", F.col("c.name").alias("feature"), (F.round("c.phi", 6) + 0.0).alias("phi")
    )


#: Which model wants which sidecar, by order key.
ATTACHMENTS = [("m1", "m1"), ("m1i", "m1"), ("m5", "m1"), ("m2", "m1"), ("m1", "junk"), ("m1", "gone"), ("gone", "m1")]


def q_sidecar_reasons(spark, sf):
    from sylva.sources.sidecar import compatibility

    sidecars = _sidecars(spark)
    pairs = spark.createDataFrame(ATTACHMENTS, "model_id string, shap_id string")
    heads = sidecars.headers.select(F.col("model_id").alias("shap_id"), "version", "n_trees", "depth", "n_features", "n_classes")
    broken = sidecars.rejected.select(F.col("model_id").alias("shap_id"), F.regexp_extract("reason", r"^\[(\w+)\]", 1).alias("broken"))
    facts = compatibility(sidecars, catalog.tables(spark), pairs).join(heads, "shap_id", "left").join(broken, "shap_id", "left")
    facts = facts.select(
        "model_id", "shap_id", "compatible", F.coalesce("broken", F.substring_index("reason", ":", 1)).alias("code"), "version", "n_trees", "depth", "n_features", "n_classes"
    )
    pair = F.get(
        F.array(*[F.struct(F.lit(m).alias("model_id"), F.lit(x).alias("shap_id")) for m, x in ATTACHMENTS]),
        (F.col("o_orderkey") % len(ATTACHMENTS)).cast("int"),
    )
    rows = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", pair.alias("p")).select("o_orderkey", "p.*")
    return rows.join(F.broadcast(facts), ["model_id", "shap_id"])  # one row per attachment


# ---------------------------------------------------------------------------
# Data preparation (F1-F8) and streaming
# ---------------------------------------------------------------------------


def _label_counts(spark, sf):
    from sylva.functions.links import threshold_labels
    from sylva.operators.sampling import label_count

    m = catalog.model(spark, "m3")
    p = m.predict_multi_proba(emb_rows(spark, sf), features="x")
    return p.select("vec_id", label_count(threshold_labels(F.col("prediction"), 0.5)).alias("label_count"))


def q_label_count(spark, sf):
    return _label_counts(spark, sf)


def q_probe_per_bucket(spark, sf):
    from sylva.operators.sampling import first_n_per_bucket

    return first_n_per_bucket(_label_counts(spark, sf), "label_count", "vec_id", 3)


def q_label_coverage(spark, sf):
    from sylva.operators.checks import label_count_coverage

    return label_count_coverage(_label_counts(spark, sf), "label_count")


def q_stride_sample(spark, sf):
    from sylva.operators.sampling import probe_rows

    rows = probe_rows(orders_rows(spark, sf), "o_orderkey", stride=10, ranges=[(1, 40), (1000, 1010)])
    return _long(catalog.model(spark, "m1").raw(rows, keep=["o_orderkey"]), "o_orderkey", "raw", "raw")


def q_synthetic_rows(spark, sf):
    from sylva.operators.sampling import choice, rule_labels, uniform

    key = F.col("o_orderkey")
    rows = spark.read.parquet(f"{sf}/orders.parquet").select(
        "o_orderkey",
        "o_totalprice",
        "o_orderpriority",
        (uniform(key, 0, SYNTHETIC_SEED) * 30.0).alias("slack_days"),
        choice(key, 1, SYNTHETIC_SEED, CHANNELS).alias("channel"),
    )
    labelled = rule_labels(
        rows,
        [
            (F.col("o_orderpriority").startswith("1-"), 0.5),
            (F.col("o_totalprice") > 200000, 0.25),
            (F.col("slack_days") < 6, 0.3),
            (F.col("channel") == "phone", -0.2),
        ],
        0.45,
        ("normal", "rush"),
        noise=(uniform(key, 2, SYNTHETIC_SEED) - 0.5) * 0.1,
    )
    return labelled.withColumn("slack_days", F.round("slack_days", 6))


def q_stacked_rows(spark, sf):
    from sylva.operators.sampling import stack_features

    rows = orders_rows(spark, sf).select("o_orderkey", *stack_features(M2_FLOATS, M2_CATS))
    return _long(catalog.model(spark, "m2").raw(rows, features="features", cat_features="cat_features"), "o_orderkey", "raw", "raw")


def q_streaming_score(spark, sf):
    from sylva.streaming.score_stream import run_available_now, score_stream

    schema = spark.read.parquet(f"{sf}/orders.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf)
    c = spark.read.parquet(f"{sf}/customer.parquet")
    rows = stream.join(c, stream.o_custkey == c.c_custkey, "left").select(
        "o_orderkey", "o_totalprice", "c_acctbal", "c_nationkey", F.month("o_orderdate").alias("o_month")
    )
    out = run_available_now(score_stream(rows, catalog.model(spark, "m1")).select("o_orderkey", "prediction"), spark, "score")
    return _long(spark.read.parquet(out), "o_orderkey", "prediction", "raw")


SYNTHETIC_SEED = 77
CHANNELS = ["web", "store", "phone", "agent"]


def _hash_sql(draw: int, seed: int = SYNTHETIC_SEED) -> str:
    from sylva.operators.sampling import _MULTIPLIERS

    m = _MULTIPLIERS[draw % len(_MULTIPLIERS)]
    c = seed * 7919 + draw * 104729
    return f"(CAST(((o_orderkey % 2147483648) * {m} + {c}) % 4294967296 AS DOUBLE) / 4294967296.0)"


def _picked(values: list[str | None], key: str) -> str:
    """The element of a list at key % its length, as SQL."""
    whens = " ".join(f"WHEN {i} THEN {'NULL' if v is None else O._str(v)}" for i, v in enumerate(values))
    return f"CAST(CASE {key} % {len(values)} {whens} END AS VARCHAR)"


def _facts_values(model_id: str) -> str:
    """A VALUES row of what is known of a model, straight from its document."""
    import json

    d = O.doc(model_id)
    md = d["metadata"]
    names = [f["feature_id"] for kind in ("float_features", "categorical_features") for f in d["features_info"].get(kind) or []]
    n_cat, trees = len(d["features_info"].get("categorical_features") or []), d["oblivious_trees"]
    dims = len(d["scale_and_bias"][1])
    labels = "[" + ", ".join(O._str(x) for x in json.loads(md["class_params"])["class_names"]) + "]"
    n_float = len(names) - n_cat
    summary = f"trees={len(trees)} floats={n_float} cats={n_cat} dim={dims}"
    text = lambda k: O._str(md[k]) if md.get(k) else "NULL"
    return (
        f"({O._str(model_id)}, {dims}, {labels}, {n_float}, {n_cat}, {len(trees)}, {O._str(summary)}, {O._str(','.join(names))}, "
        f"{text('model_guid')}, {'train_finish_time' in md}, {'empty_key' in md}, CAST({text('empty_key')} AS VARCHAR), {model_id == 'm1'})"
    )


def _oracles_facts() -> dict[str, str]:
    m1 = O.with_clause(O.scoring_ctes("m1", ORDERS_ROWS_SQL, F4))
    cats = ["c0", "c1"]
    m2 = O.with_clause(O.scoring_ctes("m2", ORDERS_ROWS_SQL, ["f0", "f1"], cats))
    unseen = ORDERS_ROWS_SQL.replace(
        "o.o_orderpriority AS c0, c.c_mktsegment AS c1",
        "CASE WHEN o.o_orderkey % 3 = 0 THEN 'no such ' || o.o_orderpriority WHEN o.o_orderkey % 4 = 0 THEN '' ELSE o.o_orderpriority END AS c0, "
        "CASE WHEN o.o_orderkey % 5 = 0 THEN 'UNSEEN' ELSE c.c_mktsegment END AS c1",
    )
    tops = [
        ("m1", m1 + _argmax_sql("o_orderkey")),
        ("m1i", O.with_clause(O.scoring_ctes("m1i", ORDERS_ROWS_SQL, F4)) + _argmax_sql("o_orderkey")),
        ("m2", m2 + "SELECT row_key AS o_orderkey, CASE WHEN raw > 0 THEN 1.0 ELSE 0.0 END AS class FROM raw"),
    ]
    codes = {"cut": "UNPARSEABLE", "leaves": "LEAF_SHAPE", "bare": "BARE_SPLIT", "nobody": "NO_MODEL", None: "NO_NAME"}
    doc = O.doc("m1")
    head = f"1, {len(doc['oblivious_trees'])}, {len(doc['oblivious_trees'][0]['splits'])}, {len(M1_FLOATS)}, {len(doc['scale_and_bias'][1])}"
    none = ", ".join(["CAST(NULL AS BIGINT)"] * 5)
    told = [
        f"(0, true, NULL, {head})", f"(1, true, NULL, {head})", f"(2, false, 'FEATURES', {head})", f"(3, false, 'CATEGORICAL_MODEL', {head})",
        f"(4, false, 'MAGIC', {none})", f"(5, false, 'NO_SIDECAR', {none})", f"(6, false, 'NO_MODEL', {head})",
    ]
    n_wanted = len(WANTED)
    return {
        "scores_or_reasons": f"SELECT o_orderkey, wanted, code, class_idx, raw FROM ("
        f"SELECT row_key AS o_orderkey, 'm1' AS wanted, CAST(NULL AS VARCHAR) AS code, class_idx, raw FROM ({m1}SELECT * FROM raw WHERE row_key % {n_wanted} = 0) "
        f"UNION ALL SELECT row_key, 'm2', NULL, class_idx, raw FROM ({m2}SELECT * FROM raw WHERE row_key % {n_wanted} = 1) "
        f"UNION ALL SELECT o_orderkey, {_picked(WANTED, 'o_orderkey')}, {_picked([codes.get(w) for w in WANTED], 'o_orderkey')}, CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE) "
        f"FROM orders WHERE o_orderkey % {n_wanted} > 1)",
        "map_quarantine": O.with_clause(O.scoring_ctes("m4", PART_ROWS_SQL + " WHERE p_partkey % 5 <> 0 AND p_partkey % 7 <> 0", ["f0", "f1"]))
        + "SELECT row_key AS p_partkey, raw, CAST(NULL AS VARCHAR) AS code, CAST(NULL AS VARCHAR) AS feature FROM raw "
        "UNION ALL SELECT p_partkey, NULL, CASE WHEN p_partkey % 7 = 0 THEN 'UNKNOWN' ELSE 'MISSING' END, "
        "CASE WHEN p_partkey % 7 = 0 THEN 'colour' ELSE 'p_retailprice' END FROM part WHERE p_partkey % 5 = 0 OR p_partkey % 7 = 0",
        "unseen_categories": _raw_oracle("m2", unseen, ["f0", "f1"], cats),
        "predictions_with_metadata": "SELECT t.model_id, t.o_orderkey, f.labels[CAST(t.class AS INTEGER) + 1] AS label, 1 AS class_dims, f.dims AS raw_dims, "
        "f.n_float AS float_features_count, f.n_cat AS cat_features_count, f.n_trees AS tree_count, f.summary, f.features, true AS named, f.guid, "
        "f.has_time, f.has_empty, f.empty, f.has_explainer FROM ("
        + " UNION ALL ".join(f"SELECT '{m}' AS model_id, * FROM ({sql})" for m, sql in tops)
        + f") t JOIN (VALUES {', '.join(_facts_values(m) for m, _ in tops)}) "
        "f(model_id, dims, labels, n_float, n_cat, n_trees, summary, features, guid, has_time, has_empty, empty, has_explainer) ON f.model_id = t.model_id",
        "recorded_parity": m1 + "SELECT CAST(class_idx AS INTEGER) AS class_idx, COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_off, ROUND(SUM(raw), 6) AS sum_raw, 'm1' AS model FROM raw GROUP BY class_idx",
        "shared_sidecar_explain": _explain_base_float16("m1", ORDERS_ROWS_SQL, F4)
        + f"SELECT m.model_id, row_key AS o_orderkey, m.labels[class_idx + 1] AS class, {_names_sql(M1_FLOATS)}[feature + 1] AS feature, ROUND(phi, 6) + 0.0 AS phi "
        "FROM contrib JOIN (VALUES ('m1', ['F', 'O', 'P']), ('m1i', ['0', '1', '2'])) m(model_id, labels) ON true",
        "sidecar_reasons": f"SELECT o_orderkey, {_picked([m for m, _ in ATTACHMENTS], 'o_orderkey')} AS model_id, {_picked([x for _, x in ATTACHMENTS], 'o_orderkey')} AS shap_id, "
        f"t.compatible, t.code, t.version, t.n_trees, t.depth, t.n_features, t.n_classes FROM orders JOIN (VALUES {', '.join(told)}) "
        f"t(i, compatible, code, version, n_trees, depth, n_features, n_classes) ON t.i = o_orderkey % {len(ATTACHMENTS)}",
    }


def _oracles_more() -> dict[str, str]:
    m1 = O.with_clause(O.scoring_ctes("m1", ORDERS_ROWS_SQL, F4))
    m3 = O.with_clause(O.scoring_ctes("m3", EMB_ROWS_SQL, [f"f{i}" for i in range(N_EMB)]))
    label_counts = (
        "lc AS (SELECT row_key AS vec_id, CAST(SUM(CAST(1.0 / (1.0 + EXP(-raw)) >= 0.5 AS INTEGER)) AS INTEGER) AS label_count "
        "FROM raw GROUP BY row_key) "
    )
    slack = f"({_hash_sql(0)} * 30.0)"
    channel = f"['web', 'store', 'phone', 'agent'][CAST(FLOOR({_hash_sql(1)} * 4) AS INTEGER) + 1]"
    score = (
        f"(({_hash_sql(2)} - 0.5) * 0.1 + CASE WHEN o_orderpriority LIKE '1-%' THEN 0.5 ELSE 0.0 END "
        f"+ CASE WHEN o_totalprice > 200000 THEN 0.25 ELSE 0.0 END + CASE WHEN {slack} < 6 THEN 0.3 ELSE 0.0 END "
        f"+ CASE WHEN {channel} = 'phone' THEN -0.2 ELSE 0.0 END)"
    )
    label = f"CAST({score} > 0.45 AS INTEGER)"
    return {
        "quantized_drift": "SELECT e.row_key AS o_orderkey, ROUND(MAX(ABS(e.phi - q.phi)), 6) AS max_drift, "
        "MAX(ABS(e.phi - q.phi)) <= 5e-3 AS within_tolerance FROM ("
        + _explain_base("m1", ORDERS_ROWS_SQL, F4) + "SELECT row_key, class_idx, feature, phi FROM contrib) e JOIN ("
        + _explain_base_float16("m1", ORDERS_ROWS_SQL, F4) + "SELECT row_key, class_idx, feature, phi FROM contrib) q "
        "ON e.row_key = q.row_key AND e.class_idx = q.class_idx AND e.feature = q.feature GROUP BY e.row_key",
        "parity_report": m1
        + "SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE a AND NOT b) AS only_left, COUNT(*) FILTER (WHERE b AND NOT a) AS only_right, "
        "COUNT(*) FILTER (WHERE a AND b AND k % 89 = 0 AND c <> 0) AS null_on_one_side, "
        "COUNT(*) FILTER (WHERE a AND b AND k % 89 <> 0 AND k % 83 = 0 AND c <> 2) AS nan_on_one_side, "
        "COUNT(*) FILTER (WHERE a AND b AND k % 89 <> 0 AND k % 83 <> 0 AND k % 79 = 0 AND c = 1) AS over_tolerance, "
        "CAST(COALESCE(MAX(CASE WHEN a AND b AND k % 89 <> 0 AND k % 83 <> 0 AND k % 79 = 0 AND c = 1 THEN 0.5 ELSE 0.0 END), 0.0) AS DOUBLE) AS max_abs_diff "
        "FROM (SELECT row_key AS k, class_idx AS c, row_key % 97 <> 0 AS a, row_key % 101 <> 0 AS b FROM raw) WHERE a OR b",
        "probability_checks": "SELECT 'm1' AS model_id, COUNT(DISTINCT o_orderkey) AS n_rows, COUNT(DISTINCT o_orderkey) AS n_valid, "
        "MIN(p) AS min_p, MAX(p) AS max_p FROM (" + _softmax_oracle("m1", ORDERS_ROWS_SQL, F4, "o_orderkey", "e / tot", "p")
        + ") UNION ALL SELECT 'm3', COUNT(DISTINCT row_key), COUNT(DISTINCT row_key), ROUND(MIN(1.0 / (1.0 + EXP(-raw))), 6), "
        "ROUND(MAX(1.0 / (1.0 + EXP(-raw))), 6) FROM (" + m3 + "SELECT row_key, raw FROM raw)",
        "type_difference": m3.rstrip("\n") + ",\n" + SOFTMAX_SQL
        + "SELECT row_key AS vec_id, ROUND(MAX(ABS(e / tot - 1.0 / (1.0 + EXP(-raw)))), 6) AS max_diff FROM se GROUP BY row_key",
        "contribution_checks": _explain_base("m1", ORDERS_ROWS_SQL, F4)
        + f"SELECT CAST(class_idx AS INTEGER) AS class_idx, {_names_sql(M1_FLOATS)}[feature + 1] AS top_feature, COUNT(*) AS n_rows, "
        "COUNT(*) FILTER (WHERE n = 4) AS n_well_formed, ROUND(MIN(lead_phi), 6) AS min_lead, ROUND(MAX(lead_phi), 6) AS max_lead FROM ("
        "SELECT class_idx, feature, ROUND(ABS(phi), 9) AS lead_phi, COUNT(*) OVER (PARTITION BY row_key, class_idx) AS n, "
        "ROW_NUMBER() OVER (PARTITION BY row_key, class_idx ORDER BY ROUND(ABS(phi), 9) DESC, feature) AS rn FROM contrib) WHERE rn = 1 GROUP BY class_idx, feature",
        "node_cover": O.with_clause(
            O.scoring_ctes("m1", ORDERS_ROWS_SQL, F4)
            + [
                O.weights_cte("m1"),
                O.depth_cte("m1"),
                "lv AS (SELECT tree, level FROM m_splits UNION ALL SELECT tree, depth FROM m_depth)",
                "cov AS (SELECT lv.tree, lv.level, w.leaf & ((1 << lv.level) - 1) AS node, SUM(CASE WHEN w.weight = 0 THEN 1e-6 ELSE w.weight END) AS cover "
                "FROM lv JOIN m_weights w ON w.tree = lv.tree GROUP BY 1, 2, 3)",
                "vis AS (SELECT lv.tree, lv.level, x.leaf & ((1 << lv.level) - 1) AS node, COUNT(*) AS n FROM lv JOIN leafidx x ON x.tree = lv.tree GROUP BY 1, 2, 3)",
            ]
        )
        + "SELECT CAST(cov.tree AS INTEGER) AS tree, CAST(cov.level AS INTEGER) AS level, CAST(cov.node AS INTEGER) AS node, ROUND(cover, 6) AS cover, "
        "COALESCE(n, 0) AS n_rows FROM cov LEFT JOIN vis ON vis.tree = cov.tree AND vis.level = cov.level AND vis.node = cov.node",
        **_oracles_facts(),
        "label_count": m3.rstrip("\n") + ",\n" + label_counts + "SELECT vec_id, label_count FROM lc",
        "probe_per_bucket": m3.rstrip("\n") + ",\n" + label_counts
        + "SELECT vec_id, label_count FROM (SELECT vec_id, label_count, ROW_NUMBER() OVER (PARTITION BY label_count ORDER BY vec_id) AS rn FROM lc) WHERE rn <= 3",
        "label_coverage": m3.rstrip("\n") + ",\n" + label_counts + "SELECT COUNT(DISTINCT label_count) AS distinct_label_counts FROM lc",
        "stride_sample": O.with_clause(O.scoring_ctes("m1", ORDERS_ROWS_SQL + " WHERE o.o_orderkey % 10 = 0 OR o.o_orderkey BETWEEN 1 AND 40 OR o.o_orderkey BETWEEN 1000 AND 1010", F4))
        + "SELECT row_key AS o_orderkey, class_idx, raw FROM raw",
        "synthetic_rows": f"SELECT o_orderkey, o_totalprice, o_orderpriority, ROUND({slack}, 6) AS slack_days, {channel} AS channel, "
        f"{label} AS label, ['normal', 'rush'][{label} + 1] AS label_name FROM orders",
        "streaming_score": _raw_oracle("m1", ORDERS_ROWS_SQL, F4),
    }


# ---------------------------------------------------------------------------
# Contract
# ---------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: score every order (joined to its customer) with model m1."""
    return q_score_raw(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "score_raw": q_score_raw,
        "score_raw_relational": q_score_raw_relational,
        "leaf_index": q_leaf_index,
        "score_categorical": q_score_categorical,
        "score_many_models": q_score_many_models,
        "score_many_models_dense": q_score_many_models_dense,
        "null_and_nan_features": q_null_and_nan_features,
        "named_map_rows": q_named_map_rows,
        "positional_rows": q_positional_rows,
        "score_sql_function": q_score_sql_function,
        "arity_quarantine": q_arity_quarantine,
        "link_probability_binary": q_link_probability_binary,
        "link_probability_multiclass": q_link_probability_multiclass,
        "link_multi_probability": q_link_multi_probability,
        "link_class": q_link_class,
        "link_class_binary": q_link_class_binary,
        "link_exponent": q_link_exponent,
        "link_log_probability": q_link_log_probability,
        "link_uncertainty": q_link_uncertainty,
        "expand_binary": q_expand_binary,
        "threshold_labels": q_threshold_labels,
        "top_class_label": q_top_class_label,
        "explain_contributions": q_explain_contributions,
        "explain_relational": q_explain_relational,
        "explain_ranked": q_explain_ranked,
        "shap_additivity": q_shap_additivity,
        "sidecar_explain": q_sidecar_explain,
        "quantized_drift": q_quantized_drift,
        "parity_report": q_parity_report,
        "probability_checks": q_probability_checks,
        "type_difference": q_type_difference,
        "contribution_checks": q_contribution_checks,
        "label_count": q_label_count,
        "probe_per_bucket": q_probe_per_bucket,
        "label_coverage": q_label_coverage,
        "stride_sample": q_stride_sample,
        "synthetic_rows": q_synthetic_rows,
        "stacked_rows": q_stacked_rows,
        "streaming_score": q_streaming_score,
        "node_cover": q_node_cover,
        "scores_or_reasons": q_scores_or_reasons,
        "map_quarantine": q_map_quarantine,
        "unseen_categories": q_unseen_categories,
        "predictions_with_metadata": q_predictions_with_metadata,
        "recorded_parity": q_recorded_parity,
        "shared_sidecar_explain": q_shared_sidecar_explain,
        "sidecar_reasons": q_sidecar_reasons,
    } | ({} if llm is None else {**llm.QUERIES, "pipeline": corpus_pipeline.run})


def oracle_sql() -> dict[str, str]:
    out = {}
    out.update(_oracles_scoring())
    out["score_many_models_dense"] = out["score_many_models"]
    out["stacked_rows"] = out["score_categorical"]
    out.update(_oracles_explain())
    out.update(_oracles_more())
    if llm is not None:
        out.update(llm.ORACLE_SQL)
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
