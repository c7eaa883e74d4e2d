"""Exact top-k inner products over a bit-sliced index.

Vectors are quantised to integers. A block of rows is indexed by attribute:
bit ``j`` of the attribute, over all rows, is one bitmap (a slice). A query's
scores are computed for all rows of a block at once by adding slices: every set
bit of a query component adds that attribute's slices, shifted; carry-save
adders over bitmaps turn the pile into the slices of the score. Negative
components add complements, so everything added is non-negative and the sums
differ from the scores by one constant per query.

Selection walks the score slices from the most significant downward, keeping
the rows that are surely in and those still tied at the boundary; at the end
the boundary rows all have the same score and are resolved exactly by id.

Blocks hold a bounded number of rows. Every query meets every block; queries
are dealt to the blocks by an equi-join key and streamed past the block's
index, each block returns at most ``k`` rows per query, and a ranked window
keeps the best ``k`` overall. With few blocks the queries of a block are split
among several tasks.

Defined results: vectors that are null, hold null or non-finite components, or
have no id take no part; shorter vectors count as padded by zeros; rows with
the query's id are its own and are no candidates; ties go to the smaller id;
repeated candidate rows count each by themselves, repeated queries once; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylva.session import ship_package

from .common import stored

SCALE = 64
K = 20
#: Rows of a block; its bitmaps have this many bits.
BLOCK_ROWS = 1 << 16


class SlicedIndex:
    """Bit slices of a block: ``slices[j]`` holds bit j of every attribute, one bitmap per row of it."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, values = ids[order], values[order]
        self.n, self.dim = values.shape
        self.low = values.min(axis=0) if self.n else np.zeros(self.dim, np.int64)
        lifted = (values - self.low).astype(np.uint64)
        self.bits = max(int(lifted.max(initial=0)).bit_length(), 1)
        self.words = -(-self.n // 64)
        pad = np.zeros((self.words * 64, self.dim), np.uint64)
        pad[: self.n] = lifted
        self.slices = [self._bitmaps(((pad >> np.uint64(j)) & np.uint64(1)).astype(np.uint8).T) for j in range(self.bits)]
        alive = np.zeros((1, self.words * 64), np.uint8)
        alive[0, : self.n] = 1
        self.alive = self._bitmaps(alive)[0]

    @staticmethod
    def _bitmaps(bits: np.ndarray) -> np.ndarray:
        return np.packbits(np.ascontiguousarray(bits), axis=1, bitorder="little").view("<u8").astype(np.uint64)

    def add(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Score slices from least to most significant, and the constant to add to their value."""
        size, negative = np.abs(query), query < 0
        flip = np.where(negative, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))[:, None]
        piles: list[list[np.ndarray]] = []
        for i in range(int(size.max(initial=0)).bit_length()):
            chosen = np.flatnonzero((size >> i) & 1)
            for j in range(self.bits):
                while len(piles) <= i + j:
                    piles.append([])
                piles[i + j].append(self.slices[j][chosen] ^ flip[chosen])
        out: list[np.ndarray] = []
        at = 0
        while at < len(piles):
            pile = np.concatenate(piles[at]) if piles[at] else np.zeros((1, self.words), np.uint64)
            piles[at] = []
            while len(pile) > 1:
                if at + 1 == len(piles):
                    piles.append([])
                third = len(pile) // 3
                if third:
                    a, b, c = pile[:third], pile[third : 2 * third], pile[2 * third : 3 * third]
                    half = a ^ b
                    piles[at + 1].append((a & b) | (half & c))
                    half ^= c
                    pile = np.concatenate([half, pile[3 * third :]]) if len(pile) > 3 * third else half
                else:
                    piles[at + 1].append(pile[:1] & pile[1:])
                    pile = pile[:1] ^ pile[1:]
            out.append(pile[0] if len(pile) else np.zeros(self.words, np.uint64))
            at += 1
        # sum q * (low + u) = const + sum |q| * u over positive + sum |q| * (top - u) over negative - |q| * top
        top = (1 << self.bits) - 1
        const = sum(int(q) * int(lo) for q, lo in zip(query.tolist(), self.low.tolist())) - top * int(size[negative].sum())
        return out, const

    def top(self, own_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
        """(row numbers, scores) of the ``k`` best rows other than the query's own."""
        sums, const = self.add(query)
        open_rows = self.alive.copy()
        a, b = np.searchsorted(self.ids, [own_id, own_id + 1])
        for row in range(a, b):
            open_rows[row >> 6] &= ~np.uint64(1 << (row & 63))
        sure = np.zeros_like(open_rows)
        n_sure = 0
        for s in reversed(sums):
            high = open_rows & s
            n = int(np.bitwise_count(high).sum())
            if n_sure + n >= k:
                open_rows = high
            else:
                sure |= high
                n_sure += n
                open_rows &= ~s
        rows = np.concatenate([self._rows(sure), self._rows(open_rows)[: k - n_sure]])
        word, bit = rows >> 6, (rows & 63).astype(np.uint64)
        scores = [const] * len(rows)
        for p, s in enumerate(sums):
            hit = (s[word] >> bit) & np.uint64(1)
            scores = [x + (int(h) << p) for x, h in zip(scores, hit)]
        return rows, scores

    @staticmethod
    def _rows(bitmap: np.ndarray) -> np.ndarray:
        full = np.flatnonzero(bitmap)
        bits = np.unpackbits(bitmap[full].astype("<u8").view(np.uint8).reshape(len(full), 8), axis=1, bitorder="little")
        word, bit = np.nonzero(bits)
        return full[word] * 64 + bit


def _matrix(lists: pa.ListArray, dim: int) -> np.ndarray:
    """Lists as rows of a matrix of ``dim`` columns, padded by zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, x): the vectors that take part, as integers."""
    finite = F.forall(vec_col, lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(v.cast("double")))
    return vectors.where(F.col(id_col).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vec_col, lambda v: F.floor(F.lit(float(scale)) * v.cast("double"))).cast("array<long>").alias("x"),
    )


def search(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows of each query; ``is_query`` is a condition on ``id``."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = stored(quantised(vectors, id_col, vec_col, scale), "quantised")
    n, dim = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    blocks = max(1, math.ceil(n / block_rows))
    splits = max(1, math.ceil(spark.sparkContext.defaultParallelism / blocks))
    dim = dim or 0
    index = rows.select(
        F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("split"),
        F.lit(0).alias("kind"),
        "id",
        "x",
    )
    queries = (
        rows.where(is_query)
        .dropDuplicates(["id", "x"])
        .select(
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
            F.pmod(F.xxhash64("id", F.lit(1)), F.lit(splits)).cast("int").alias("split"),
            F.lit(1).alias("kind"),
            "id",
            "x",
        )
    )
    key = (F.col("block") * splits + F.col("split")).cast("int")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, built = None, [], None
        for batch in batches:
            keys, kinds, ids = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)]
            values = _matrix(batch.column(3), dim)
            cuts = np.flatnonzero((np.diff(keys) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                if a == b:
                    continue
                if keys[a] != now:
                    now, held, built = keys[a], [], None
                if kinds[a] == 0:
                    held.append((ids[a:b], values[a:b]))
                    continue
                if built is None:
                    if not held:  # a block without rows
                        continue
                    built = SlicedIndex(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
                    held = []
                out_q, out_v, out_s = [], [], []
                for own, query in zip(ids[a:b].tolist(), values[a:b]):
                    found, scores = built.top(own, query, k)
                    out_q += [own] * len(scores)
                    out_v += built.ids[found].tolist()
                    out_s += scores
                yield pa.RecordBatch.from_arrays([pa.array(out_q, pa.int64()), pa.array(out_v, pa.int64()), pa.array(out_s, pa.int64())], ["query_id", "vec_id", "score"])

    dealt = (
        index.unionByName(queries)
        .select(key.alias("key"), "kind", "id", "x")
        .repartitionById(blocks * splits, F.col("key"))
        .sortWithinPartitions("key", "kind", "id")
    )
    best = dealt.mapInArrow(step, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id")))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """
WITH u AS (
  SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
  FROM embeddings WHERE vec_id IS NOT NULL
), e AS (
  SELECT vec_id, CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) AS v, i
  FROM u WHERE vec_id NOT IN (SELECT vec_id FROM u WHERE x IS NULL OR NOT isfinite(x))
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.v * c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
  GROUP BY q.vec_id, c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""
