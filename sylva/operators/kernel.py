"""The dense kernel: one Arrow step walks the trees of any number of models.

Rows arrive as float32 virtual features. For every tree the leaf index is
computed once and feeds all that is asked of it: raw scores, the leaves
themselves, and the gathers from one or more SHAP tables. Models in the same
step share the feature matrix.

Values are added tree by tree in the order of the trees, and scale and bias
come last, so the result is the same to the last bit for any block size. Rows
are taken in pieces for which the accumulators (rows x outputs) and the leaf
indices (rows x trees of a part) stay within fixed budgets, whatever the Arrow
batch, the number of trees, features or classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Rows x trees leaf indices held at once: 4M (4 MB as uint8).
INDEX_BUDGET = 1 << 22
# Rows x outputs accumulated at once: 4M doubles = 32 MB.
OUTPUT_BUDGET = 1 << 22

PHI_TYPE = T.ArrayType(T.ArrayType(T.DoubleType()))


def _index_dtype(depth: int):
    return np.uint8 if depth <= 8 else np.uint16 if depth <= 16 else np.uint32


def leaf_indices_t(xt: np.ndarray, feat: np.ndarray, border: np.ndarray) -> np.ndarray:
    """D1 on a batch, tree-major: (V, N) float32 features -> (T, N) leaf index.

    Bit ``d`` is set when ``x[feat[t, d]] > border[t, d]`` (strict; NaN is
    false). Feature-major input makes every gather a contiguous row copy, and
    the index is kept in the narrowest unsigned type the depth allows.
    """
    t, d_max = feat.shape
    dtype = _index_dtype(d_max)
    idx = np.zeros((t, xt.shape[1]), dtype=dtype)
    with np.errstate(invalid="ignore"):
        for d in range(d_max):
            idx |= np.greater(xt[feat[:, d]], border[:, d, None]).view(np.uint8).astype(dtype, copy=False) << dtype(d)
    return idx


@dataclass
class Walk:
    """What one forest contributes to the step.

    ``columns`` are its virtual features among the step's; ``phi_cols`` name
    one output per SHAP table of the blocks.
    """

    columns: list[int]
    dims: int
    n_features: int
    blocks: list[Broadcast]
    scale: float = 1.0
    bias: np.ndarray | None = None
    raw_col: str | None = None
    leaves_col: str | None = None
    phi_cols: list[str] = field(default_factory=list)
    n_trees: int = 0
    #: (column, value): only rows with this text in the column are walked, the others get null.
    where: tuple[str, str] | None = None

    def width(self) -> int:
        """Doubles a row needs in the accumulators."""
        phi = len(self.phi_cols) * self.n_features * self.dims
        return max(1, 2 * phi + (self.dims if self.raw_col else 0) + (self.n_trees if self.leaves_col else 0))

    def fields(self) -> list[T.StructField]:
        out = []
        if self.raw_col:
            out.append(T.StructField(self.raw_col, T.ArrayType(T.DoubleType())))
        if self.leaves_col:
            out.append(T.StructField(self.leaves_col, T.ArrayType(T.IntegerType())))
        return out + [T.StructField(c, PHI_TYPE) for c in self.phi_cols]


def _blocks(walk: Walk) -> Iterator[dict]:
    """The blocks in order; with more than one, each is let go after use (it stays on the executor's disk)."""
    for b in walk.blocks:
        yield b.value
        if len(walk.blocks) > 1:
            b.__dict__.pop("_value", None)


def run_walk(walk: Walk, x: np.ndarray) -> list[np.ndarray]:
    """The walk's outputs for (N, V) rows, in the order of ``fields``: raw (N, K), leaves (N, T), phi (N, K, F)."""
    n = x.shape[0]
    xt = np.ascontiguousarray(x[:, walk.columns].T)
    raw = np.zeros((n, walk.dims)) if walk.raw_col else None
    leaves = np.zeros((n, walk.n_trees), dtype=np.int32) if walk.leaves_col else None
    phis = [np.zeros((walk.n_features, n, walk.dims)) for _ in walk.phi_cols]
    for block in _blocks(walk):
        trees = block["feat"].shape[0]
        part = max(1, INDEX_BUDGET // max(1, n))
        for first in range(0, trees, part):
            idx = leaf_indices_t(xt, block["feat"][first : first + part], block["border"][first : first + part])
            for i in range(idx.shape[0]):
                at, t = idx[i].astype(np.intp), first + i
                if raw is not None:
                    raw += np.take(block["leaves"][t], at, axis=0)
                if leaves is not None:
                    leaves[:, block["start"] + t] = at
                for phi, shap in zip(phis, block["shaps"]):
                    used, table = shap[t]
                    for f, values in zip(used, table):
                        phi[f] += np.take(values, at, axis=0)
    out = []
    if raw is not None:
        out.append(walk.scale * raw + walk.bias[None, :])
    if leaves is not None:
        out.append(leaves)
    return out + [np.ascontiguousarray(p.transpose(1, 2, 0)) for p in phis]


def matrix(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """(N, V) features from V columns, or from one column of arrays."""
    if len(names) == 1 and pa.types.is_list(batch.schema.field(names[0]).type):
        flat = batch.column(batch.schema.get_field_index(names[0])).flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(batch.num_rows, -1) if batch.num_rows else flat.reshape(0, 0)
    out = np.zeros((batch.num_rows, len(names)), dtype=np.float32)
    for i, n in enumerate(names):
        out[:, i] = batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False)
    return out


def list_column(values: np.ndarray) -> pa.Array:
    """(N, K) or (N, K, F) values as (nested) lists."""
    out = pa.array(values.reshape(-1))
    for axis in range(values.ndim - 1, 0, -1):
        n, width = int(np.prod(values.shape[:axis])), values.shape[axis]
        out = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(width)), out)
    return out


def _outputs(walk: Walk, x: np.ndarray, rows: pa.RecordBatch) -> list[pa.Array]:
    if walk.where is None:
        return [list_column(v) for v in run_walk(walk, x)]
    column, value = walk.where
    wanted = np.array([v == value for v in rows.column(rows.schema.get_field_index(column)).to_pylist()], dtype=bool)
    place = pa.array(np.cumsum(wanted) - 1, mask=~wanted)
    return [list_column(v).take(place) for v in run_walk(walk, x[wanted])]


def walk_step(df: DataFrame, vcols: list[str], walks: list[Walk]) -> DataFrame:
    """Append all outputs of ``walks`` to the rows, dropping the virtual features: one ``mapInArrow``."""
    fields = [f for w in walks for f in w.fields()]
    gone = set(vcols)
    schema = T.StructType([f for f in df.schema.fields if f.name not in gone] + fields)
    rows_at_once = max(1, OUTPUT_BUDGET // sum(w.width() for w in walks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [i for i, name in enumerate(batch.schema.names) if name not in gone]
            names = [batch.schema.names[i] for i in kept] + [f.name for f in fields]
            for at in range(0, batch.num_rows, rows_at_once):
                rows = batch.slice(at, rows_at_once)
                x = matrix(rows, vcols)
                outputs = [v for w in walks for v in _outputs(w, x, rows)]
                yield pa.RecordBatch.from_arrays([*(rows.column(i) for i in kept), *outputs], names=names)

    return df.mapInArrow(run, schema)
