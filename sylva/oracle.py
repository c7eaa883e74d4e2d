"""Render model documents as SQL for the DuckDB oracle.

The oracle does the tree walk in plain SQL over ``VALUES`` tables built from the
same model JSON: unpivot features, join splits, ``sum(1 << level)`` per (row,
tree), join leaf values, sum per (row, class). SHAP values are computed by
enumerating every subset of the model's features (the Shapley definition),
not by the per-tree method the Spark side uses. Nothing here runs on Spark.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

from .fixtures import model_text


@lru_cache(maxsize=None)
def doc(model_id: str) -> dict:
    return json.loads(model_text(model_id))


def _num(v: float) -> str:
    return repr(float(v))


def _f32(v: float) -> str:
    return f"CAST(CAST({_num(np.float32(v))} AS DOUBLE) AS FLOAT)"


def _str(s: str) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def splits_cte(model_id: str, name: str = "m_splits") -> str:
    d = doc(model_id)
    rows = []
    for t, tree in enumerate(d["oblivious_trees"]):
        for lv, s in enumerate(tree["splits"]):
            kind = {"FloatFeature": "float", "OneHotFeature": "onehot"}.get(s.get("split_type", "float"), s.get("split_type", "float"))
            feat = s.get("float_feature_index") if kind == "float" else s.get("cat_feature_index")
            border = _f32(s["border"]) if "border" in s and s["border"] is not None else "CAST(NULL AS FLOAT)"
            value = _str(s["value"]) if s.get("value") is not None else "CAST(NULL AS VARCHAR)"
            stat = str(s["stat_id"]) if s.get("stat_id") is not None else "CAST(NULL AS INTEGER)"
            rows.append(f"({t}, {lv}, {_str(kind)}, {feat}, {border}, {value}, {stat})")
    return f"{name}(tree, level, kind, feature, border, value, stat_id) AS (VALUES {', '.join(rows)})"


def leaves_cte(model_id: str, name: str = "m_leaves") -> str:
    d = doc(model_id)
    rows = []
    for t, tree in enumerate(d["oblivious_trees"]):
        n_leaves = 1 << len(tree["splits"])
        k = len(tree["leaf_values"]) // n_leaves
        for leaf in range(n_leaves):
            for c in range(k):
                rows.append(f"({t}, {leaf}, {c}, {_num(tree['leaf_values'][leaf * k + c])})")
    return (
        f"{name}(tree, leaf, class_idx, value) AS (SELECT a, b, c, CAST(v AS DOUBLE) FROM (VALUES {', '.join(rows)}) x(a, b, c, v))"
    )


def weights_cte(model_id: str, name: str = "m_weights") -> str:
    d = doc(model_id)
    rows = []
    for t, tree in enumerate(d["oblivious_trees"]):
        for leaf, w in enumerate(tree["leaf_weights"]):
            rows.append(f"({t}, {leaf}, {_num(w)})")
    return f"{name}(tree, leaf, weight) AS (SELECT a, b, CAST(w AS DOUBLE) FROM (VALUES {', '.join(rows)}) x(a, b, w))"


def depth_cte(model_id: str, name: str = "m_depth") -> str:
    d = doc(model_id)
    rows = [f"({t}, {len(tree['splits'])})" for t, tree in enumerate(d["oblivious_trees"])]
    return f"{name}(tree, depth) AS (VALUES {', '.join(rows)})"


def bias_cte(model_id: str, name: str = "m_bias") -> str:
    d = doc(model_id)
    scale, bias = d["scale_and_bias"]
    rows = [f"({k}, {_num(b)}, {_num(scale)})" for k, b in enumerate(bias)]
    return f"{name}(class_idx, bias, scale) AS (SELECT a, CAST(b AS DOUBLE), CAST(s AS DOUBLE) FROM (VALUES {', '.join(rows)}) x(a, b, s))"


def stats_cte(model_id: str, name: str = "m_stats") -> str:
    d = doc(model_id)
    rows = []
    for st in d.get("target_stats") or []:
        for key, s, c in zip(st["keys"], st["sums"], st["counts"]):
            rows.append(
                f"({st['stat_id']}, {_str(key)}, {_num(s)}, {_num(c)}, {_num(st['prior'])}, {_num(st['prior_weight'])})"
            )
    if not rows:
        rows = ["(-1, '', 0.0, 0.0, 0.0, 1.0)"]
    return (
        f"{name}(stat_id, key, value, prior) AS (SELECT a, k, (CAST(s AS DOUBLE) + CAST(w AS DOUBLE) * CAST(p AS DOUBLE))"
        f" / (CAST(c AS DOUBLE) + CAST(w AS DOUBLE)), CAST(p AS DOUBLE) FROM (VALUES {', '.join(rows)}) x(a, k, s, c, p, w))"
    )


def model_ctes(model_id: str, prefix: str = "m") -> list[str]:
    return [
        splits_cte(model_id, f"{prefix}_splits"),
        leaves_cte(model_id, f"{prefix}_leaves"),
        bias_cte(model_id, f"{prefix}_bias"),
        stats_cte(model_id, f"{prefix}_stats"),
    ]


def feature_unpivot(floats: list[str], cats: list[str], src: str = "rows") -> list[str]:
    """CTEs ``feats(row_key, feature, x)`` and ``cats(row_key, feature, s)`` from ``rows``."""
    f = " UNION ALL ".join(f"SELECT row_key, {i} AS feature, {e} AS x FROM {src}" for i, e in enumerate(floats))
    parts = [f"feats AS ({f})"]
    if cats:
        c = " UNION ALL ".join(f"SELECT row_key, {j} AS feature, {e} AS s FROM {src}" for j, e in enumerate(cats))
        parts.append(f"cats AS ({c})")
    return parts


def leaf_sql(has_cats: bool, prefix: str = "m") -> list[str]:
    """CTEs ``bits`` and ``leafidx(row_key, tree, leaf)``."""
    parts = [
        f"SELECT f.row_key, s.tree, s.level, (NOT isnan(f.x) AND f.x > s.border) AS b "
        f"FROM feats f JOIN {prefix}_splits s ON s.kind = 'float' AND s.feature = f.feature"
    ]
    if has_cats:
        parts.append(
            f"SELECT c.row_key, s.tree, s.level, (c.s = s.value) AS b "
            f"FROM cats c JOIN {prefix}_splits s ON s.kind = 'onehot' AND s.feature = c.feature"
        )
        parts.append(
            f"SELECT c.row_key, s.tree, s.level, "
            f"(CAST(COALESCE(t.value, p.prior) AS FLOAT) > s.border) AS b "
            f"FROM cats c JOIN {prefix}_splits s ON s.kind = 'target_stat' AND s.feature = c.feature "
            f"LEFT JOIN {prefix}_stats t ON t.stat_id = s.stat_id AND t.key = c.s "
            f"JOIN (SELECT DISTINCT stat_id, prior FROM {prefix}_stats) p ON p.stat_id = s.stat_id"
        )
    return [
        f"bits AS ({' UNION ALL '.join(parts)})",
        "leafidx AS (SELECT row_key, tree, CAST(SUM(CASE WHEN b THEN 1 << level ELSE 0 END) AS INTEGER) AS leaf "
        "FROM bits GROUP BY row_key, tree)",
    ]


def raw_sql(prefix: str = "m") -> str:
    """CTE ``raw(row_key, class_idx, raw)``."""
    return (
        f"raw AS (SELECT l.row_key, v.class_idx, SUM(v.value) * ANY_VALUE(b.scale) + ANY_VALUE(b.bias) AS raw "
        f"FROM leafidx l JOIN {prefix}_leaves v ON v.tree = l.tree AND v.leaf = l.leaf "
        f"JOIN {prefix}_bias b ON b.class_idx = v.class_idx GROUP BY l.row_key, v.class_idx)"
    )


def scoring_ctes(model_id: str, rows_sql: str, floats: list[str], cats: list[str] | None = None) -> list[str]:
    """All CTEs up to ``raw(row_key, class_idx, raw)`` for one model over ``rows_sql``."""
    cats = cats or []
    return (
        model_ctes(model_id)
        + [f"rows AS ({rows_sql})"]
        + feature_unpivot(floats, cats)
        + leaf_sql(bool(cats))
        + [raw_sql()]
    )


def with_clause(ctes: list[str]) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------------------
# SHAP by subset enumeration (oracle only)
# ---------------------------------------------------------------------------


def shap_ctes(model_id: str, prefix: str = "m", include_model: bool = True) -> list[str]:
    """CTEs giving ``shap(tree, leaf, feature, class_idx, phi)`` and ``expected``.

    phi_i(leaf h) = sum over S not containing i of |S|!(F-|S|-1)!/F! *
    (E[S u {i}] - E[S]), where E[S] = sum over leaves l of v_l * prod over
    levels d of (feature_d in S ? [l and h agree at d] : cover ratio at d).
    Zero leaf weights count as 1e-6. Subsets range over all F model features.
    """
    d = doc(model_id)
    n_f = len(d["features_info"]["float_features"])
    scale = d["scale_and_bias"][0]
    model = [
        splits_cte(model_id, f"{prefix}_splits"),
        leaves_cte(model_id, f"{prefix}_leaves"),
        bias_cte(model_id, f"{prefix}_bias"),
    ] if include_model else []
    return model + [
        weights_cte(model_id, f"{prefix}_weights"),
        depth_cte(model_id, f"{prefix}_depth"),
        f"w AS (SELECT tree, leaf, CASE WHEN weight = 0 THEN 1e-6 ELSE weight END AS w FROM {prefix}_weights)",
        # cover of the node at level lv on leaf l's path: sum of w over leaves sharing l's low lv bits
        f"cov AS (SELECT a.tree, a.leaf, s.level AS lv, SUM(b.w) AS c FROM w a JOIN w b ON a.tree = b.tree "
        f"JOIN (SELECT tree, level FROM {prefix}_splits UNION ALL SELECT tree, depth FROM {prefix}_depth) s ON s.tree = a.tree "
        f"WHERE (a.leaf & ((1 << s.level) - 1)) = (b.leaf & ((1 << s.level) - 1)) GROUP BY a.tree, a.leaf, s.level)",
        f"ratio AS (SELECT s.tree, c1.leaf, s.level, s.feature, c1.c / c0.c AS r FROM {prefix}_splits s "
        f"JOIN cov c0 ON c0.tree = s.tree AND c0.lv = s.level JOIN cov c1 ON c1.tree = s.tree AND c1.leaf = c0.leaf AND c1.lv = s.level + 1)",
        f"subsets AS (SELECT range AS s FROM range(0, {1 << n_f}))",
        f"targets AS (SELECT DISTINCT tree, leaf AS h FROM w)",
        # probability that leaf l is reached given leaf h's side for features in S
        "prob AS (SELECT t.tree, t.h, sub.s, r.leaf AS l, "
        "PRODUCT(CASE WHEN ((sub.s >> r.feature) & 1) = 1 THEN (CASE WHEN ((xor(t.h, r.leaf) >> r.level) & 1) = 0 THEN 1.0 ELSE 0.0 END) ELSE r.r END) AS p "
        "FROM targets t JOIN ratio r ON r.tree = t.tree CROSS JOIN subsets sub GROUP BY t.tree, t.h, sub.s, r.leaf)",
        f"ev AS (SELECT p.tree, p.h, p.s, v.class_idx, SUM(p.p * v.value) AS e FROM prob p JOIN {prefix}_leaves v ON v.tree = p.tree AND v.leaf = p.l "
        "GROUP BY p.tree, p.h, p.s, v.class_idx)",
        f"feat_ids AS (SELECT range AS i FROM range(0, {n_f}))",
        f"shap AS (SELECT a.tree, a.h AS leaf, f.i AS feature, a.class_idx, "
        f"SUM((factorial(CAST(bit_count(a.s) AS INTEGER)) * factorial({n_f} - CAST(bit_count(a.s) AS INTEGER) - 1) / factorial({n_f})) * (b.e - a.e)) * {_num(scale)} AS phi "
        "FROM ev a JOIN feat_ids f ON ((a.s >> f.i) & 1) = 0 "
        "JOIN ev b ON b.tree = a.tree AND b.h = a.h AND b.class_idx = a.class_idx AND b.s = (a.s | (1 << f.i)) "
        "GROUP BY a.tree, a.h, f.i, a.class_idx)",
        f"expected AS (SELECT v.tree, v.class_idx, SUM(v.value * w.w) / SUM(w.w) AS e FROM {prefix}_leaves v JOIN w ON w.tree = v.tree AND w.leaf = v.leaf GROUP BY v.tree, v.class_idx)",
        f"bias_row AS (SELECT b.class_idx, SUM(x.e) * ANY_VALUE(b.scale) + ANY_VALUE(b.bias) AS bias FROM expected x JOIN {prefix}_bias b ON b.class_idx = x.class_idx GROUP BY b.class_idx)",
    ]
