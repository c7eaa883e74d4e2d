"""Feature assembly (C1-C13): DataFrame columns -> the model's ordered inputs.

All of it is projection: casts, ``coalesce``, ``element_at`` and, for target
statistics, one left join to a model-sized table. The output carries the
caller's columns plus float32 *virtual feature* columns ``__v0 .. __vN`` in the
order of ``ModelHeader.virtual``, shared by models that read the same input.

Null and NaN rules (kept identical in every plan):

* ``null_mode='zero'`` (default): a null float becomes 0.0, a null category ''.
* ``null_mode='nan'``: a null float becomes NaN.
* ``null_mode='error'``: the job fails on the first null.
* NaN compares false against every border, so it takes bit 0 (``nan_mode='min'``);
  ``nan_mode='max'`` sends it to bit 1 and ``'error'`` fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.compiled import ModelHeader

NULL_MODES = ("zero", "nan", "error")
NAN_MODES = ("min", "max", "error")


def vcol(i: int) -> str:
    return f"__v{i}"


def _float_input(c: Column, label: str, null_mode: str, nan_mode: str) -> Column:
    x = c.cast("float")
    if null_mode == "zero":
        x = F.coalesce(x, F.lit(0.0).cast("float"))
    elif null_mode == "nan":
        x = F.coalesce(x, F.lit(float("nan")).cast("float"))
    elif null_mode == "error":
        x = F.when(x.isNull(), F.raise_error(F.lit(f"null value for float feature {label}")).cast("float")).otherwise(x)
    else:
        raise ValueError(f"null_mode must be one of {NULL_MODES}")
    if nan_mode == "max":
        x = F.when(F.isnan(x), F.lit(float("inf")).cast("float")).otherwise(x)
    elif nan_mode == "error":
        x = F.when(F.isnan(x), F.raise_error(F.lit(f"NaN value for float feature {label}")).cast("float")).otherwise(x)
    elif nan_mode != "min":
        raise ValueError(f"nan_mode must be one of {NAN_MODES}")
    return x


def _cat_input(c: Column, null_mode: str, label: str) -> Column:
    s = c.cast("string")
    if null_mode == "error":
        return F.when(s.isNull(), F.raise_error(F.lit(f"null value for cat feature {label}")).cast("string")).otherwise(s)
    return F.coalesce(s, F.lit(""))


def _is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def source_columns(
    df: DataFrame,
    model: ModelHeader,
    *,
    features: str | None = None,
    cat_features: str | None = None,
    row_map: str | None = None,
    strict: bool = False,
) -> tuple[list[Column], list[Column], list[str]]:
    """The raw float and cat source expressions, in model order.

    Exactly one input form: named columns (default), a positional float array
    ``features`` (+ ``cat_features`` array), or a map column ``row_map``.
    Returns (float sources, cat sources, labels).
    """
    if features is not None and row_map is not None:
        raise ValueError("give either positional features or a row map, not both")
    if features is not None:  # C5: positional arrays
        fl = [F.try_element_at(F.col(features), F.lit(i + 1)) for i in range(model.n_float)]
        if model.n_cat:
            if cat_features is None:
                raise ValueError(f"model has {model.n_cat} cat features; cat_features must be provided")
            cl = [F.try_element_at(F.col(cat_features), F.lit(i + 1)) for i in range(model.n_cat)]
        else:
            cl = []
        return fl, cl, model.float_names + model.cat_names
    if row_map is not None:  # C2: a map from feature name to value
        m = F.col(row_map)
        fl = [F.try_element_at(m, F.lit(n)) for n in model.float_names]
        cl = [F.try_element_at(m, F.lit(n)) for n in model.cat_names]
        return fl, cl, model.float_names + model.cat_names
    # Named columns; C3/C4 are checked here, at plan time.
    cols = set(df.columns)
    if strict:
        known = set(model.float_names) | set(model.cat_names)
        unknown = [c for c in df.columns if c not in known]
        if unknown:
            raise ValueError(f"column {unknown[0]!r} is no feature of the model (its features: {sorted(known)})")
    for kind, names in (("float", model.float_names), ("cat", model.cat_names)):
        for n in names:
            if n not in cols:
                raise KeyError(f"the {kind} feature {n!r} has no column")
    types = {f.name: f.dataType for f in df.schema.fields}
    for n in model.float_names:  # T5: text or booleans in a float slot are rejected
        if not _is_numeric(types[n]):
            raise TypeError(f"float feature {n!r} has non-numeric type {types[n].simpleString()}")
    return [F.col(n) for n in model.float_names], [F.col(n) for n in model.cat_names], model.float_names + model.cat_names


def prune(
    df: DataFrame,
    model,
    keep: list[str] | None,
    *,
    features: str | None = None,
    cat_features: str | None = None,
    row_map: str | None = None,
    **_: object,
) -> DataFrame:
    """Keep only ``keep`` plus the model's inputs, before the Arrow step.

    Columns cannot be pruned through a Python step, so selecting here is what
    lets the Parquet scan read only what the model needs.
    """
    if keep is None:
        return df
    if features is not None:
        need = [features] + ([cat_features] if cat_features else [])
    elif row_map is not None:
        need = [row_map]
    else:
        need = list(model.float_names) + list(model.cat_names)
    cols = list(dict.fromkeys(list(keep) + [c for c in need if c in df.columns]))
    return df.select(*cols)


def map_row_checks(row_map: str, model: ModelHeader, unknown_keys: str = "error") -> Column:
    """C2-C4 for map rows: a failing expression for unknown (first) or missing keys.

    ``unknown_keys='ignore'`` skips the unknown check (the explain path's rule).
    """
    names = F.array(*[F.lit(n) for n in model.float_names + model.cat_names])
    keys = F.coalesce(F.map_keys(F.col(row_map)), F.array().cast("array<string>"))  # a null map lacks every feature
    unknown = F.array_except(keys, names)
    missing = F.array_except(names, keys)
    missing_check = F.when(F.size(missing) > 0, F.raise_error(F.concat(F.lit("row map lacks feature "), missing[0])))
    if unknown_keys == "ignore":
        return missing_check
    return F.when(F.size(unknown) > 0, F.raise_error(F.concat(F.lit("row map has a feature the model does not know: "), unknown[0]))).otherwise(
        missing_check
    )


def arity_check(features: str, n: int, kind: str = "float") -> Column:
    """Fail when a positional row has the wrong length."""
    got = F.coalesce(F.size(F.col(features)), F.lit(-1))  # a null array has no features at all
    return F.when(
        got != n,
        F.raise_error(F.format_string(f"row holds %d {kind} values where the model takes {n}", got)),
    )


def row_checks(
    model, features: str | None, cat_features: str | None, row_map: str | None, unknown_keys: str = "error"
) -> list[Column]:
    """Checks of a positional or map row, the same in every plan: each fails the job or is null."""
    checks: list[Column] = []
    if features is not None:
        checks.append(arity_check(features, len(model.float_names), "float"))
        if model.cat_names:
            checks.append(arity_check(cat_features, len(model.cat_names), "cat"))
    if row_map is not None:
        checks.append(map_row_checks(row_map, model, unknown_keys))
    return checks


def guard_inputs(checks: list[Column], floats: list[Column], cats: list[Column]) -> None:
    """Hang the checks on an input that is always computed: null checks let its value through."""
    if checks and floats:
        floats[0] = F.coalesce(*[c.cast("float") for c in checks], floats[0])
    elif checks and cats:
        cats[0] = F.coalesce(*[c.cast("string") for c in checks], cats[0])


def arity_quarantine(df: DataFrame, features: str, n: int, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """C8 without failing: (rows of the right length, quarantined (keys..., expected, got))."""
    got = F.coalesce(F.size(F.col(features)), F.lit(-1))
    bad = df.filter(got != n).select(*keys, F.lit(n).alias("expected"), got.alias("got"))
    return df.filter(got == n), bad


def map_quarantine(df: DataFrame, row_map: str, model: ModelHeader, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """C3/C4 without failing: (rows whose map fits the model, quarantined (keys..., code, feature)).

    ``UNKNOWN`` names the first feature that the model does not have, else
    ``MISSING`` the first one that the map lacks.
    """
    names = F.array(*[F.lit(n) for n in model.float_names + model.cat_names])
    held = F.coalesce(F.map_keys(F.col(row_map)), F.array().cast("array<string>"))
    unknown, missing = F.array_except(held, names), F.array_except(names, held)
    code = F.when(F.size(unknown) > 0, "UNKNOWN").when(F.size(missing) > 0, "MISSING")
    feature = F.when(F.size(unknown) > 0, F.get(F.array_sort(unknown), F.lit(0))).otherwise(F.get(missing, F.lit(0)))
    return df.filter(code.isNull()), df.filter(code.isNotNull()).select(*keys, code.alias("code"), feature.alias("feature"))


#: Statistic rows that may be broadcast whole (about 100 bytes each).
BROADCAST_STATS = 1 << 20
#: A category with more than one in so many rows counts as frequent; also the most of them.
FREQUENT = 1024


def lookup_stat(rows: DataFrame, cat_col: str, stats: DataFrame, n_stats: int, out_col: str, prior: float, bound: int | None = None) -> DataFrame:
    """``out_col`` = the statistic of the category in ``cat_col``, or the prior; a left join by category.

    ``stats`` holds (key, value), ``n_stats`` rows. Up to ``bound`` it is
    broadcast. A larger one is joined in two parts, planned without running the
    input: a Misra-Gries pass over the rows' categories (``freqItems``, read
    when the query runs) finds every category in more than one of ``FREQUENT``
    rows; their statistics, at most ``FREQUENT`` rows, are broadcast. The other
    rows are joined by a shuffle on the category, and the rows already
    answered are dealt over all its partitions by number, as they match nothing.
    """
    key, value, salt = f"__key_{out_col}", f"__value_{out_col}", f"__salt_{out_col}"
    stats = stats.select(F.col("key").alias(key), F.col("value").alias(value))
    if n_stats <= (BROADCAST_STATS if bound is None else bound):
        joined = rows.join(F.broadcast(stats), F.col(cat_col) == F.col(key), "left")
        return joined.withColumn(out_col, F.coalesce(value, F.lit(prior)).cast("float")).drop(key, value)
    found = rows.select(F.col(cat_col).alias("c")).stat.freqItems(["c"], 1.0 / FREQUENT)
    frequent = found.select(F.explode("c_freqItems").alias("__c"))
    # an unseen category among the frequent ones is answered here too, with the prior
    hot = frequent.join(stats, F.col("__c") == F.col(key), "left").select(F.col("__c").alias(f"{key}_hot"), F.col(value).alias(f"{value}_hot"))
    marked = rows.join(F.broadcast(hot), F.col(cat_col) == F.col(f"{key}_hot"), "left")
    is_hot = F.col(f"{key}_hot").isNotNull()
    # rows already answered get a key of their own kind, which no statistic has and which spreads them
    number = (F.monotonically_increasing_id() % 65536).cast("string")
    marked = marked.withColumn(salt, F.when(is_hot, F.concat(F.lit("h"), number)).otherwise(F.concat(F.lit("c"), F.col(cat_col))))
    cold = stats.withColumn(f"{salt}_", F.concat(F.lit("c"), F.col(key)))
    joined = marked.join(cold.hint("merge"), F.col(salt) == F.col(f"{salt}_"), "left")
    answer = F.when(is_hot, F.col(f"{value}_hot")).otherwise(F.col(value))
    return joined.withColumn(out_col, F.coalesce(answer, F.lit(prior)).cast("float")).drop(
        key, value, salt, f"{salt}_", f"{key}_hot", f"{value}_hot"
    )


def assemble(
    df: DataFrame,
    models: list[ModelHeader],
    target_stats: DataFrame | None = None,
    *,
    features: str | None = None,
    cat_features: str | None = None,
    row_map: str | None = None,
    strict: bool = False,
    null_mode: str = "zero",
    nan_mode: str = "min",
    unknown_keys: str = "error",
) -> tuple[DataFrame, list[str], list[list[int]]]:
    """Add the virtual feature columns of all models to ``df``, each only once.

    Returns the rows, the virtual columns (or one array column of them) and,
    per model, which of them are its virtual features. ``target_stats`` (the models' long table) is needed only
    for target-statistic splits; its value is looked up by category.
    """
    if features is not None and all(v[0] == "float" for m in models for v in m.virtual):
        # The array stays one column, with one expression for any number of elements
        x = F.transform(features, lambda v: _float_input(v, "in a row's array", null_mode, nan_mode))
        checks = [c for m in models for c in row_checks(m, features, None, None)]
        x = F.coalesce(*[c.cast("array<float>") for c in checks], x)
        return df.select("*", x.alias(vcol(0))), [vcol(0)], [list(range(m.n_float)) for m in models]
    number: dict[tuple, int] = {}
    cols: list[Column] = []
    places: list[list[int]] = []
    checks: list[Column] = []
    stat_of: dict[int, tuple[ModelHeader, int, Column]] = {}
    for model in models:
        fsrc, csrc, labels = source_columns(
            df, model, features=features, cat_features=cat_features, row_map=row_map, strict=strict
        )
        checks += row_checks(model, features, cat_features, row_map, unknown_keys)
        mine = []
        for v in model.virtual:
            kind, j = v[0], v[2] if v[0] == "stat" else v[1]
            source = j if features is not None else labels[j if kind == "float" else model.n_float + j]
            key = (kind, source, *(v[2:] if kind == "onehot" else (model.model_id, v[1]) if kind == "stat" else ()))
            if key not in number:
                number[key] = len(cols)
                if kind == "float":
                    cols.append(_float_input(fsrc[j], labels[j], null_mode, nan_mode))
                else:
                    c = _cat_input(csrc[j], null_mode, labels[model.n_float + j])
                    if kind == "onehot":
                        cols.append(F.when(c == F.lit(v[2]), 1.0).otherwise(0.0).cast("float"))
                    else:
                        stat_of[len(cols)] = (model, v[1], c)
                        cols.append(F.lit(None).cast("float"))
            mine.append(number[key])
        places.append(mine)
    if checks:  # hung on a column that is always computed: null checks let its value through
        if not cols:
            cols.append(F.lit(0.0).cast("float"))
        at = next((i for i in range(len(cols)) if i not in stat_of), None)
        if at is None:
            i, (model, sid, c) = next(iter(stat_of.items()))
            stat_of[i] = (model, sid, F.coalesce(*[x.cast("string") for x in checks], c))
        else:
            cols[at] = F.coalesce(*[x.cast("float") for x in checks], cols[at])
    plain = [c.alias(vcol(i)) for i, c in enumerate(cols) if i not in stat_of]
    out = df.select("*", *plain, *[c.alias(f"__c{i}") for i, (_, _, c) in stat_of.items()])
    for i, (model, sid, _) in stat_of.items():
        if target_stats is None:
            raise ValueError("model has target-statistic splits; pass its target_stats table")
        table = target_stats.filter((F.col("model_id") == model.model_id) & (F.col("stat_id") == sid) & F.col("key").isNotNull())
        out = lookup_stat(out, f"__c{i}", table, model.stat_sizes.get(sid, 0), vcol(i), model.stat_priors.get(sid, 0.0)).drop(f"__c{i}")
    return out, [vcol(i) for i in range(len(cols))], places
