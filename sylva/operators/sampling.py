"""Data preparation operators (F1-F8).

* F1 ``first_n_per_bucket``: ``row_number() <= n`` over a window per bucket.
  Spark plans it with a partial WindowGroupLimit before the shuffle, so each
  map task sends at most n rows per bucket: a bucket holding a third of the
  table still moves only n x tasks rows.
* F2/F3 ``probe_rows``: a stride on the row key and key ranges.
* F4 ``label_count``: ``aggregate`` over a 0/1 label array.
* F5-F7 ``rule_labels``: a 0/1 label and its name from a weighted rule over any
  columns, with seeded noise; ``uniform`` and ``choice`` draw further columns
  from an arithmetic hash of the key (the same under any partitioning, unlike
  ``rand``).
* F8 ``stack_features``: columns as the two positional arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n_per_bucket(df: DataFrame, bucket: str, order: str, n: int) -> DataFrame:
    """the first ``n`` rows of every bucket by ``order``, sorted by ``order``."""
    w = Window.partitionBy(bucket).orderBy(order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn").orderBy(order)


def probe_rows(df: DataFrame, key: str, stride: int | None = None, ranges: list[tuple[int, int]] | None = None) -> DataFrame:
    """rows whose key is a multiple of ``stride`` or falls in one of ``ranges``."""
    cond = F.lit(False)
    if stride:
        cond = cond | (F.col(key) % stride == 0)
    for lo, hi in ranges or []:
        cond = cond | F.col(key).between(lo, hi)
    return df.filter(cond)


def label_count(labels: Column) -> Column:
    """number of active labels in a 0/1 array."""
    return F.aggregate(labels, F.lit(0), lambda a, b: a + b)


_MULTIPLIERS = (2654435761, 2246822519, 3266489917, 668265263, 374761393, 1103515245, 12345677)


def uniform(key: Column, draw: int, seed: int) -> Column:
    """A deterministic draw in [0, 1) from the key: multiplicative hash modulo 2^32."""
    m = _MULTIPLIERS[draw % len(_MULTIPLIERS)]
    h = ((key.cast("long") % F.lit(1 << 31)) * F.lit(m) + F.lit(seed * 7919 + draw * 104729)) % F.lit(1 << 32)
    return h.cast("double") / float(1 << 32)


def choice(key: Column, draw: int, seed: int, options: list[str]) -> Column:
    idx = F.floor(uniform(key, draw, seed) * len(options)).cast("int")
    return F.element_at(F.array(*[F.lit(o) for o in options]), idx + 1)


def rule_labels(
    df: DataFrame,
    terms: list[tuple[Column, float]],
    threshold: float,
    names: tuple[str, str],
    noise: Column | None = None,
    label_col: str = "label",
) -> DataFrame:
    """``label_col`` (1 where the weights of the true terms plus noise exceed the threshold) and its name.

    A term whose condition is null counts as false.
    """
    score = noise if noise is not None else F.lit(0.0)
    for condition, weight in terms:
        score = score + F.when(condition, F.lit(float(weight))).otherwise(0.0)
    label = (score > threshold).cast("int")
    return df.withColumn(label_col, label).withColumn(
        f"{label_col}_name", F.when(F.col(label_col) == 1, F.lit(names[1])).otherwise(F.lit(names[0]))
    )


def stack_features(floats: list[str], cats: list[str]) -> list[Column]:
    """F8: numeric and categorical columns as the two positional arrays."""
    return [
        F.array(*[F.col(c).cast("float") for c in floats]).alias("features"),
        F.array(*[F.col(c).cast("string") for c in cats]).alias("cat_features"),
    ]
