import math
import random

import pytest
from pyspark.sql import functions as F

from sylva.llm import topk

from .conftest import SF


def slow(rows, k, scale=64, every=20):
    good = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in good if i % every == 0}:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:k]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)}
    return out


def told(df):
    rows = [tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("block", [1 << 16, 70])
def test_whole_table(shared, block):
    vectors = shared.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    assert told(topk.search(vectors, F.col("id") % 20 == 0, block_rows=block)) == slow(rows, 20)


@pytest.mark.parametrize("block", [1 << 16, 16])
def test_ties_nulls_and_lengths(shared, block):
    rng = random.Random(block)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.25, 3.7, -1000.5]) for _ in range(5)]) for i in range(120)]
    rows += [(200, None), (201, [None] * 5), (202, [float("nan")] + [1.0] * 4), (203, [float("inf")] * 5), (None, [1.0] * 5)]
    rows += [(204, [1.0, 2.0]), (220, []), (240, [1e6] * 5), (260, [0.25] * 5), (261, [0.25] * 5), (262, [0.25] * 5)]
    vectors = shared.createDataFrame([(i, v, 0, 0.0) for i, v in rows], "vec_id long, embedding array<double>, block int, score double").repartition(3)
    got = topk.search(vectors, F.col("id") % 20 == 0, k=7, block_rows=block)
    assert told(got) == slow(rows, 7)


def test_repeated_candidates_and_fewer_than_k(shared):
    rows = [(0, [1.0]), (1, [2.0]), (1, [2.0]), (0, [1.0])]
    vectors = shared.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk.search(vectors, F.col("id") % 20 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 64 * 128), (0, 2, 1, 64 * 128)]


def test_empty(shared):
    vectors = shared.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.search(vectors, F.col("id") % 20 == 0).collect() == []
