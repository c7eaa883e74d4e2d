"""Link functions (D4-D11): raw scores -> the seven prediction types.

Every link is a Column expression over ``raw ARRAY<DOUBLE>`` (higher-order
``transform``/``aggregate``), so it stays in the JVM and in whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The prediction type names, snake case -> CamelCase.
PREDICTION_TYPES = {
    "raw_formula_val": "RawFormulaVal",
    "probability": "Probability",
    "multi_probability": "MultiProbability",
    "class": "Class",
    "exponent": "Exponent",
    "log_probability": "LogProbability",
    "rmse_with_uncertainty": "RMSEWithUncertainty",
}
MULTI_LABEL_LOSSES = ("MultiLogloss", "MultiCrossEntropy")


def resolve_prediction_type(ptype) -> str:
    """Accept the snake-case or the CamelCase name; return snake case."""
    if not isinstance(ptype, str):
        raise TypeError(f"a prediction type is named by a string, not by {type(ptype).__name__}")
    if ptype in PREDICTION_TYPES:
        return ptype
    for k, v in PREDICTION_TYPES.items():
        if v == ptype:
            return k
    raise ValueError(
        f"there is no prediction type {ptype!r}; there are {list(PREDICTION_TYPES)} (or {list(PREDICTION_TYPES.values())})"
    )


def output_dims(ptype: str, dims: int, loss: str | None = None) -> int:
    """Width of the prediction array for a type."""
    ptype = resolve_prediction_type(ptype)
    if ptype == "class":
        return dims if loss in MULTI_LABEL_LOSSES else 1
    return dims


# Arrays up to this width are unrolled into per-element expressions, which
# whole-stage codegen compiles; wider ones use (interpreted) lambdas.
UNROLL_MAX = 64


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


def _items(raw: Column, k: int) -> list[Column]:
    return [raw[i] for i in range(k)]


def _max(xs: list[Column]) -> Column:
    return xs[0] if len(xs) == 1 else F.greatest(*xs)


def _sum(xs: list[Column]) -> Column:
    total = xs[0]
    for x in xs[1:]:
        total = total + x
    return total


def softmax(raw: Column, k: int | None = None) -> Column:
    if k is not None and k <= UNROLL_MAX:
        r = _items(raw, k)
        m = _max(r)
        e = [F.exp(x - m) for x in r]
        total = _sum(e)
        return F.array(*[v / total for v in e])
    m = F.array_max(raw)
    e = F.transform(raw, lambda r: F.exp(r - m))
    total = F.aggregate(e, F.lit(0.0), lambda a, b: a + b)
    return F.transform(e, lambda v: v / total)


def log_softmax(raw: Column, k: int | None = None) -> Column:
    if k is not None and k <= UNROLL_MAX:
        r = _items(raw, k)
        m = _max(r)
        lse = F.log(_sum([F.exp(x - m) for x in r]))
        return F.array(*[x - m - lse for x in r])
    m = F.array_max(raw)
    lse = F.log(F.aggregate(F.transform(raw, lambda r: F.exp(r - m)), F.lit(0.0), lambda a, b: a + b))
    return F.transform(raw, lambda r: r - m - lse)


def elementwise(raw: Column, k: int, fn) -> Column:
    if k <= UNROLL_MAX:
        return F.array(*[fn(x) for x in _items(raw, k)])
    return F.transform(raw, fn)


def argmax_class(raw: Column, k: int | None = None) -> Column:
    """Index of the first largest raw value, as a double (the reference's class output)."""
    if k is not None and k <= UNROLL_MAX:
        r = _items(raw, k)
        m = _max(r)
        out = F.when(r[0] == m, F.lit(0.0))
        for i in range(1, k):
            out = out.when(r[i] == m, F.lit(float(i)))
        return out
    return (F.array_position(raw, F.array_max(raw)) - 1).cast("double")


def apply_link(raw: Column, ptype: str, dims: int, loss: str | None = None) -> Column:
    """D5a-g: one prediction type as an array expression (``dims`` = K of the model)."""
    ptype = resolve_prediction_type(ptype)
    if ptype == "raw_formula_val":
        return raw
    if ptype == "probability":
        return elementwise(raw, dims, sigmoid) if dims == 1 else softmax(raw, dims)
    if ptype == "multi_probability":
        return elementwise(raw, dims, sigmoid)
    if ptype == "class":
        if loss in MULTI_LABEL_LOSSES:
            return elementwise(raw, dims, lambda r: F.when(r > 0, 1.0).otherwise(0.0))
        if dims == 1:
            return F.array(F.when(raw[0] > 0, 1.0).otherwise(0.0))
        return F.array(argmax_class(raw, dims))
    if ptype == "exponent":
        return elementwise(raw, dims, F.exp)
    if ptype == "log_probability":
        if loss in MULTI_LABEL_LOSSES:
            raise ValueError(f"log_probability is not defined for {loss} models")
        if dims < 2:
            raise ValueError("log_probability needs a model with two or more classes")
        return log_softmax(raw, dims)
    if ptype == "rmse_with_uncertainty":
        if dims != 2:
            raise ValueError(f"rmse_with_uncertainty needs a 2-dimensional model, got {dims}")
        return F.array(raw[0], F.exp(F.lit(2.0) * raw[1]))
    raise AssertionError(ptype)


def expand_binary(prob: Column) -> Column:
    """[p1] -> [p0, p1]."""
    return F.array(F.lit(1.0) - prob[0], prob[0])


def threshold_labels(prob: Column, t: float = 0.5) -> Column:
    """Per-label 0/1 decision."""
    return F.transform(prob, lambda v: (v >= F.lit(t)).cast("int"))


def class_label(class_idx: Column, class_names: Column) -> Column:
    """Label of a class index (1-based element_at on the model's names)."""
    return F.element_at(class_names, class_idx.cast("int") + 1)
