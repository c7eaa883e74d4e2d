"""Centroid clustering by progressive search in Walsh-Hadamard space.

Vectors and centroids are integers. The Walsh-Hadamard transform is integer
too and multiplies every squared distance by the dimension, so distances are
compared exactly in its space. Its coefficients are put in order of sequency
(the coarse ones, with few sign changes, first). A vector's squared differences
to the centroids are added up over growing blocks of coefficients: what has
been added is a lower bound. After the first blocks the centroid with the
smallest bound is measured in full, and from then on a centroid whose bound is
strictly above that distance is dropped, so a tie is never lost. Centroids that
are never dropped finish all coefficients, and the nearest of them (the smaller
number on a tie) is the answer.

One Spark job transforms the vectors and writes them to the shared checkpoint
folder. Each round is one job over that table: every task adds up its own
vectors per centroid (at most k rows a task), Spark adds up the tasks. As the
transform is linear, the sum of coefficients gives the sum of components. Only
k x dimension numbers pass through the driver.

Defined results: vectors that are null, of another length, or hold a null or
non-finite component take no part; null ids are kept as vectors of their own and
come last among the starting ones; repeated rows count as often as they stand;
with fewer vectors than k there are fewer centroids; an empty table gives an
empty result; a component of 2**24 or more after scaling fails the job, as its
distances would not fit a long; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylva.session import ship_package

from .common import stored

DIMENSION = 64
CLUSTERS = 8
ROUNDS = 10
SEED = 3
SCALE = 1024
#: Components stay below this, so that dimension * dimension * difference**2 fits a long.
LIMIT = 1 << 24
#: Coefficients added before the first centroid is measured in full.
COARSE = 4


# -- the transform ------------------------------------------------------------


def walsh_hadamard(x: np.ndarray) -> np.ndarray:
    """Rows of integers -> their coefficients, unscaled, in Hadamard order."""
    out = x.astype(np.int64)
    n, dim = out.shape
    half = 1
    while half < dim:
        pairs = out.reshape(n, dim // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, dim)
        half *= 2
    return out


def by_sequency(dim: int) -> np.ndarray:
    """Hadamard positions in order of sign changes: coarse coefficients first."""
    rows = walsh_hadamard(np.eye(dim, dtype=np.int64))
    return np.argsort((np.diff(np.sign(rows), axis=1) != 0).sum(axis=1), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    return walsh_hadamard(x)[:, by_sequency(x.shape[1])]


def restore(coefficients: list[int]) -> list[int]:
    """The components behind one vector of coefficients, in Python integers of any size."""
    dim = len(coefficients)
    plain = [0] * dim
    for place, c in zip(by_sequency(dim).tolist(), coefficients):
        plain[place] = c
    half = 1
    while half < dim:
        for a in range(dim):
            if not a & half:
                plain[a], plain[a | half] = plain[a] + plain[a | half], plain[a] - plain[a | half]
        half *= 2
    return [v // dim for v in plain]


# -- the search ---------------------------------------------------------------


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Coefficients of n vectors and k centroids -> (number of the nearest, dim * squared distance, coefficients compared)."""
    n, dim = x.shape
    k = len(centroids)
    row, number = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    bound = np.full(n, np.iinfo(np.int64).max)
    so_far = np.zeros(n * k, np.int64)
    compared, start, end = 0, 0, 1
    while start < dim:
        end = min(end, dim)
        apart = x[row, start:end] - centroids[number, start:end]
        so_far += np.einsum("ij,ij->i", apart, apart)
        compared += apart.size
        if end < dim and end >= COARSE:
            if start < COARSE:  # every centroid is still there: measure the leader in full
                table = so_far.reshape(n, k)
                leader = table.argmin(axis=1)
                rest = x[:, end:] - centroids[leader, end:]
                bound = table[np.arange(n), leader] + np.einsum("ij,ij->i", rest, rest)
                compared += rest.size
            alive = so_far <= bound[row]
            row, number, so_far = row[alive], number[alive], so_far[alive]
        start, end = end, end * 2
    heads = np.flatnonzero(np.diff(row, prepend=-1))
    best = np.minimum.reduceat(so_far, heads) if n else so_far
    hit = np.flatnonzero(so_far == best[row])
    first = hit[np.flatnonzero(np.diff(row[hit], prepend=-1))]
    return number[first], so_far[first], compared


# -- the jobs -----------------------------------------------------------------


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64)


def prepare(vectors: DataFrame, id_col: str, vector_col: str, scale: int, dim: int) -> DataFrame:
    """vec_id and the integer components ``x`` of the vectors that take part."""
    size = F.coalesce(F.size(vector_col), F.lit(-1))
    finite = F.forall(vector_col, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    scaled = F.transform(vector_col, lambda v: F.floor(v.cast("double") * scale))
    wide = F.exists(vector_col, lambda v: F.abs(v.cast("double") * scale) >= LIMIT)
    x = F.when(wide, F.raise_error(F.lit(f"a component of {LIMIT} or more after scaling")).cast("array<bigint>")).otherwise(scaled)
    return vectors.where((size == dim) & finite).select(F.col(id_col).alias("vec_id"), x.alias("x"))


def first_centroids(prepared: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest SHA-256 of ``seed:vec_id``."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    some = prepared.select(order.alias("h"), "x").orderBy(F.asc_nulls_last("h"), "x").limit(k)
    return [list(r.x) for r in some.collect()]


def _transformed(prepared: DataFrame, dim: int) -> DataFrame:
    id_type = prepared.schema["vec_id"].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = transform(_matrix(batch.column(1), dim)).astype(np.int32)  # at most dim * LIMIT = 2**30
            ends = pa.array(np.arange(0, c.size + 1, dim, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, pa.array(c.reshape(-1)))], ["vec_id", "c"]
            )

    return prepared.mapInArrow(step, f"vec_id {id_type}, c array<int>")


def _sums(table: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """cluster -> (vectors, sum of their coefficients) under the given centroids."""
    k, dim = centroids.shape

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dim + 1), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            number = nearest(x, centroids)[0]
            for j in range(k):
                mine = x[number == j]
                total[j, :dim] += mine.sum(axis=0)
                total[j, dim] += len(mine)
        some = np.flatnonzero(total[:, dim])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(some, dim + 1).astype(np.int32)),
                pa.array(np.tile(np.arange(dim + 1, dtype=np.int32), len(some))),
                pa.array(total[some].reshape(-1)),
            ],
            ["cluster", "place", "v"],
        )

    parts = table.select("c").mapInArrow(step, "cluster int, place int, v long")
    added = parts.groupBy("cluster", "place").agg(F.sum("v").alias("v")).collect()  # at most k * (dim + 1) rows
    out: dict[int, list[int]] = {}
    for r in added:
        out.setdefault(r.cluster, [0] * (dim + 1))[r.place] = r.v
    return {j: (v[dim], v[:dim]) for j, v in out.items()}


def cluster(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    scale: int = SCALE,
    dim: int = DIMENSION,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per vector that takes part: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    ``dim`` is a power of two. Each round replaces every non-empty centroid by
    the floor of its vectors' mean; the last assignment follows the last round.
    """
    if dim < 1 or dim & (dim - 1):
        raise ValueError("dim must be a power of two")
    spark = vectors.sparkSession
    ship_package(spark)
    prepared = prepare(vectors, id_col, vector_col, scale, dim)
    id_type = prepared.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(prepared, k, seed)
    if not centroids:
        return prepared.select(
            "vec_id",
            F.lit(0).alias("cluster"),
            *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit("").alias("centroid_sha256"),
        )
    table = stored(_transformed(prepared, dim), "walsh-vectors")
    for _ in range(rounds):
        for j, (n, sums) in _sums(table, transform(np.array(centroids))).items():
            centroids[j] = [s // n for s in restore(sums)]
    last = transform(np.array(centroids))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, scaled, _ = nearest(_matrix(batch.column(1), dim), last)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(number.astype(np.int32)), pa.array(scaled // dim)], ["vec_id", "cluster", "distance"]
            )

    assigned = stored(table.mapInArrow(step, f"vec_id {id_type}, cluster int, distance long"), "assigned-vectors")
    inertia = {r.cluster: int(r.d) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    told = [(j, d, sum(inertia.values()), names[j]) for j, d in inertia.items()]
    facts = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(  # at most k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _oracle(k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE, dim: int = DIMENSION) -> str:
    ctes = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}
)""",
        f"long AS MATERIALIZED (SELECT rid, generate_subscripts(x, 1) AS i, unnest(x) AS v FROM kept)",
        f"""c0 AS MATERIALIZED (
  SELECT cluster, generate_subscripts(x, 1) AS i, unnest(x) AS v FROM (
    SELECT x, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, x) - 1 AS cluster FROM kept
  ) WHERE cluster < {k}
)""",
    ]
    for r in range(rounds + 1):
        ctes.append(
            f"""a{r} AS MATERIALIZED (
  SELECT rid, cluster, d FROM (
    SELECT l.rid, c.cluster, CAST(sum((l.v - c.v) * (l.v - c.v)) AS BIGINT) AS d
    FROM long l JOIN c{r} c USING (i) GROUP BY l.rid, c.cluster
  ) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, cluster) = 1
)"""
        )
        if r < rounds:
            ctes.append(
                f"""c{r + 1} AS MATERIALIZED (
  SELECT c.cluster, c.i, coalesce(m.v, c.v) AS v
  FROM c{r} c LEFT JOIN (
    SELECT cluster, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS v
    FROM (SELECT a.cluster, l.i, sum(l.v) AS s, count(*) AS n FROM a{r} a JOIN long l USING (rid) GROUP BY a.cluster, l.i)
  ) m ON m.cluster = c.cluster AND m.i = c.i
)"""
            )
    return (
        "WITH "
        + ",\n".join(ctes)
        + f"""
SELECT vec_id, CAST(a.cluster AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} a JOIN kept USING (rid)
JOIN (SELECT cluster, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster) s USING (cluster)
"""
    )


ORACLE_SQL = _oracle()
