import hashlib
import math
import random

import numpy as np
import pytest

from sylva.llm import centroids as C

from .conftest import SF


def slow(rows, k=8, rounds=10, scale=1024, dim=64):
    """Plain loops over Python integers."""
    kept = [
        (i, [math.floor(scale * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted((i is None, hashlib.sha256(f"3:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in kept)
    cents = [v for *_, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        got = assign()
        for j in range(len(cents)):
            mine = [v for (_, v), (_, g) in zip(kept, got) if g == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine)]
    got = assign()
    inertia = [sum(d for d, g in got if g == j) for j in range(len(cents))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, g, d, inertia[g], sum(inertia), names[g]) for (i, _), (d, g) in zip(kept, got)), key=repr)


def told(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def test_whole_table(shared):
    vectors = shared.read.parquet(f"{SF}/embeddings.parquet")
    assert told(C.cluster(vectors)) == slow([(r.vec_id, r.embedding) for r in vectors.collect()])


def test_odd_rows_ties_and_empty_clusters(shared):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.5, -0.001, 0.0, 0.25, 0.25]) for _ in range(64)]) for i in range(40)]
    rows += [(100, [0.5] * 64)] * 3 + [(101, [0.5] * 64), (None, [0.1] * 64), (None, [0.1] * 64)]
    rows += [(102, None), (103, []), (104, [1.0] * 63), (105, [1.0] * 65), (106, [None] + [1.0] * 63), (107, [float("nan")] * 64), (108, [float("-inf")] * 64)]
    rows += [(109, [16000.0] * 64), (110, [-16000.0] * 64)]
    vectors = shared.createDataFrame([(i, v, 7, 0.5) for i, v in rows], "vec_id long, embedding array<double>, cluster int, distance double").repartition(3)
    assert told(C.cluster(vectors)) == slow(rows)


def test_fewer_vectors_than_centroids_and_none(shared):
    schema = "vec_id long, embedding array<float>"
    assert told(C.cluster(shared.createDataFrame([(1, [0.5] * 64), (2, [0.25] * 64)], schema))) == slow([(1, [0.5] * 64), (2, [0.25] * 64)])
    empty = C.cluster(shared.createDataFrame([], schema))
    assert empty.collect() == [] and dict(empty.dtypes)["centroid_sha256"] == "string" and dict(empty.dtypes)["cluster"] == "int"


def test_another_dimension(shared):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(4)]) for i in range(60)]
    got = told(C.cluster(shared.createDataFrame(rows, "vec_id long, embedding array<double>"), k=5, rounds=3, dim=4))
    assert got == slow(rows, k=5, rounds=3, dim=4)
    with pytest.raises(ValueError):
        C.cluster(shared.createDataFrame(rows, "vec_id long, embedding array<double>"), dim=5)


def test_too_wide_components_fail(shared):
    vectors = shared.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="after scaling"):
        C.cluster(vectors).collect()


def test_transform_keeps_distances_and_search_drops_only_worse_centroids():
    rng = np.random.default_rng(2)
    # neighbours in space vary slowly, so that coarse coefficients tell them apart
    centers = np.cumsum(rng.integers(-300, 300, (8, 64)), axis=1)
    x = np.vstack([centers[rng.integers(0, 8, 500)] + rng.integers(-40, 40, (500, 64)), rng.integers(-2000, 2000, (100, 64)), centers])
    tx, tc = C.transform(x), C.transform(centers)
    plain = ((x[:, None] - centers[None]) ** 2).sum(axis=2)
    assert (((tx[:, None] - tc[None]) ** 2).sum(axis=2) == 64 * plain).all()
    number, scaled, compared = C.nearest(tx, tc)
    assert (number == plain.argmin(axis=1)).all() and (scaled == 64 * plain.min(axis=1)).all()
    assert compared < x.size * 8 / 2  # most centroids are dropped early
    assert C.restore(tx[0].tolist()) == x[0].tolist()


def test_search_keeps_ties():
    c = np.array([[3, 1, 0, 0], [1, 3, 0, 0], [1, 3, 0, 0]])
    x = np.array([[2, 2, 5, 5], [1, 3, 0, 0], [9, 9, 9, 9]])
    number, scaled, _ = C.nearest(C.transform(x), C.transform(c))
    assert number.tolist() == [0, 1, 0] and scaled.tolist() == [4 * 52, 0, 4 * 262]
