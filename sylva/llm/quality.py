"""Quality classifier: supervised subword embeddings trained by numpy SGD.

Every word, every pair of neighbouring words (a word beside itself is one pair,
whatever the word) and every character 3-gram and 4-gram within a word's bounds
is hashed to one of ``2 ** BUCKET_BITS`` learned vectors. A document is the
average of its vectors; a softmax layer turns that into class probabilities.

Training uses a bounded sample of labelled rows (``sample_size``, the smallest
hashes of their ids) whose ``crc32(id as text) mod 4`` is not ``HELD_OUT``.
Their features are counted on the executors; stochastic gradient descent over
at most ``sample_size`` sparse rows runs on the driver. Scoring needs only each
bucket's contribution to the difference of the two logits, one float per
bucket, so the model that executors receive has a fixed size.

Defined results: null and empty texts get the score of the bias alone; long
texts are used whole, in training and in scoring; labels without a quality or
a document are left out, repeated labels count once and of conflicting ones the
lower; without any labels
every score is 0.5; equal texts get equal scores; an empty table gives an empty
result; other columns are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.session import ship_package

from .polyhash import piece, prefix

BUCKET_BITS = 18
DIM = 12
EPOCHS = 6
RATE = 0.6
#: Zero vectors averaged into every document: a few words alone say little, so
#: very short texts stay near the score of the bias.
PRIOR = 100
#: Factor on the learning rate of the vectors, against the thin shares of an average.
SPREAD = 30
SAMPLE = 3000
HELD_OUT = 2
THRESHOLD = 0.7
#: Characters whose features are computed at once.
CHUNK = 1 << 18

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _bucket(h: np.ndarray) -> np.ndarray:
    return (((h ^ (h >> np.uint64(29))) * _M[0]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document number, bucket) of every word, word pair, 3-gram and 4-gram of the texts."""
    padded = [f" {t} " for t in texts]
    code = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), [len(p) for p in padded])
    blank = (code == 32) | ((code >= 9) & (code <= 13))
    code[blank] = 32
    solid = ~blank
    out_doc, out_bucket = [], []
    partial = code[:-1] * _M[0] + code[1:] * _M[1]
    for size in (3, 4):
        if len(code) < size:
            continue
        n = len(code) - size + 1
        inside = solid[1 : n + 1].copy()
        if size == 4:
            inside &= solid[2 : n + 2]
        h = partial[:n] + code[2 : n + 2] * _M[2]
        if size == 4:
            h = h + code[3 : n + 3] * _M[3]
        at = np.flatnonzero(inside)
        out_doc.append(doc[at])
        out_bucket.append(_bucket(h[at]))
    sums = prefix(code)
    edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    word, word_doc = piece(sums, start, end), doc[start]
    out_doc.append(word_doc)
    out_bucket.append(_bucket(word + _M[3]))
    pair = np.where(word[1:] == word[:-1], _M[0], word[:-1] * _M[1] + word[1:] * _M[2])
    within = word_doc[1:] == word_doc[:-1]
    out_doc.append(word_doc[1:][within])
    out_bucket.append(_bucket(pair[within]))
    return np.concatenate(out_doc), np.concatenate(out_bucket)


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    at, now, size = 0, [], 0
    for k, t in enumerate(texts):
        now.append(t or "")
        size += len(now[-1])
        if size >= CHUNK:
            yield at, now
            at, now, size = k + 1, [], 0
    if now:
        yield at, now


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """A few rows at a time, so that few texts are Python strings at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


@dataclass
class QualityModel:
    """Per-bucket logit differences and the bias; ``score`` is the softmax probability of label 1."""

    weight: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for at, part in _chunks(texts):
            doc, bucket = features(part)
            n = np.bincount(doc, minlength=len(part))
            s = np.bincount(doc, self.weight[bucket], minlength=len(part))
            out[at : at + len(part)] = 1 / (1 + np.exp(-(s / (n + PRIOR) + self.bias)))
        return out


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE, seed: int = 4) -> QualityModel:
    """Train on (label, bucket ids, counts) rows by stochastic gradient descent."""
    rng = np.random.default_rng(seed)
    size = 1 << BUCKET_BITS
    if not rows:
        return QualityModel(np.zeros(size), 0.0)
    vectors = rng.uniform(-1 / dim, 1 / dim, (size, dim))
    output = rng.uniform(-1 / dim, 1 / dim, (dim, 2))
    bias = np.zeros(2)
    steps, step = epochs * len(rows), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            label, ids, counts = rows[k]
            lr = rate * (1 - step / steps)
            step += 1
            share = counts.astype(np.float64) / (counts.sum(dtype=np.float64) + PRIOR)
            hidden = share @ vectors[ids]
            logit = hidden @ output + bias
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[label] -= 1
            back = output @ p
            output -= lr * np.outer(hidden, p)
            bias -= lr * 0.1 * p
            # the average spreads a step thinly over many vectors
            vectors[ids] -= lr * SPREAD * share[:, None] * back
    return QualityModel(vectors @ (output[:, 1] - output[:, 0]), float(bias[1] - bias[0]))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_size: int = SAMPLE) -> QualityModel:
    ship_package(docs.sparkSession)
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("__label"))
        .groupBy("__id")
        .agg(F.min("__label").alias("__label"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(sample_size)
    )
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "__id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                _, bucket = features([batch.column(1)[k].as_py() or ""])
                ids, counts = np.unique(bucket, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, 1), batch.column(2).slice(k, 1), pa.array([ids.astype("<i4").tobytes()]), pa.array([counts.astype("<f4").tobytes()])],
                    ["id", "label", "ids", "counts"],
                )

    id_type = docs.schema[id_col].dataType.simpleString()
    counted = rows.select("__id", "text", "__label").mapInArrow(count, f"id {id_type}, label int, ids binary, counts binary")
    got = sorted(counted.collect(), key=lambda r: (r.id, bytes(r.ids)))
    return fit([(r.label, np.frombuffer(r.ids, "<i4"), np.frombuffer(r.counts, "<f4")) for r in got])


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            s = shared.value.scores(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(step, f"doc_id {id_type}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score of at least ``threshold``, with all their columns; one narrow pass."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            yield batch.filter(pa.array(shared.value.scores(batch.column(at).to_pylist()) >= threshold))

    return docs.mapInArrow(step, docs.schema)


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
