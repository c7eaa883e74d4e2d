"""Near duplicates by SimHash fingerprints, matched with pivot distance tables.

Fingerprints: per document the XXH64 hashes of its word shingles vote on each
of 64 bits. Only distinct fingerprints take part in the matching, so copies
cost one row.

Matching: two fingerprints that differ in at most ``max_bits`` bits agree on
all but ``max_bits`` of any set of disjoint bit blocks. Each fingerprint is
therefore dealt to one cell per choice of agreeing blocks, and cells are
matched independently: exact, no candidate is lost. Cells with more than
``cell_limit`` members are not gathered; their members are dealt again, with
the bits left free by the first level cut in finer blocks, until a cell has so
few free bits that it can never hold more than ``2 ** 12`` fingerprints.

Inside a cell a pivot distance table decides: the Hamming distances of every
member to ``N_PIVOTS`` reference fingerprints are computed once. Distances
obey the triangle inequality, so a pair whose coordinates differ by more than
``max_bits`` at any pivot is discarded; the survivors are verified on the
fingerprints themselves. Pairs whose members are already linked are passed
over, and a cell returns one (member, smallest linked member) row per member,
never its pairs.

Components: alternating large-star and small-star rounds on the link table,
each round written to the shared checkpoint folder.

Defined results: null and wordless texts have fingerprint zero, which links
like any other; a null id never becomes a component id unless the whole
component has none; repeated rows get equal results; an empty table gives an
empty result; other columns are not read by ``components``. ``keep_one`` decides by row: of
a component stays the row with the smallest id (rows without one come last),
then the smallest SHA-256 of its text; of rows equal in both, one stays.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylva.session import ship_package

from .common import fresh, stored, text_of

SHINGLE = 3
MAX_BITS = 3
N_PIVOTS = 24
#: Most members of a cell that one task matches at once.
CELL_LIMIT = 4096

_LANES = np.uint64(0x0101010101010101)


# -- fingerprints -------------------------------------------------------------


def _shingle_hashes(text: str, shingle: int) -> np.ndarray:
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = list(itertools.accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :])], np.uint64)


def fingerprint_array(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of each text. Bits are counted eight at a time in byte lanes of 64-bit words."""
    hashes = [_shingle_hashes(t or "", shingle) for t in texts]
    sizes = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    flat = np.concatenate([hashes[i] for i in some])
    # runs of at most 255 hashes: a byte lane cannot overflow
    n_runs = (sizes[some] + 254) // 255
    first = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
    doc_of_run = np.repeat(np.arange(len(some)), n_runs)
    nth = np.arange(len(doc_of_run)) - np.repeat(np.cumsum(n_runs) - n_runs, n_runs)
    run_start = first[doc_of_run] + 255 * nth
    doc_start = np.cumsum(n_runs) - n_runs
    for shift in range(8):
        lanes = np.add.reduceat((flat >> np.uint64(shift)) & _LANES, run_start)
        counts = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), doc_start, axis=0)
        major = 2 * counts > sizes[some][:, None]
        for byte in range(8):
            out[some] |= major[:, byte].astype(np.uint64) << np.uint64(8 * byte + shift)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): ``fp`` holds the 64 bits as a signed long."""
    ship_package(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                fp = fingerprint_array(part.column(1).to_pylist(), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp)], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(step, f"doc_id {id_type}, fp long")


# -- matching -----------------------------------------------------------------


def _blocks(bits: list[int], n: int) -> list[list[int]]:
    return [[int(b) for b in part] for part in np.array_split(bits, n)]


def _mask(blocks) -> int:
    return sum(1 << b for block in blocks for b in block)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def first_masks(max_bits: int) -> list[int]:
    """Bit masks of the first level: every choice of half of 2 * max_bits blocks that may agree."""
    n = max(2 * max_bits, 1)
    return [_mask(c) for c in itertools.combinations(_blocks(list(range(64)), n), n - max_bits)]


def second_masks(mask: int, max_bits: int, free: int = 12) -> list[int]:
    """Masks of the second level under ``mask``: at most ``free`` bits stay open in each."""
    open_bits = [b for b in range(64) if not mask >> b & 1]
    n = max(max_bits + 1, -(-len(open_bits) * max_bits // max(free, max_bits)))
    while True:
        chosen = [mask | _mask(c) for c in itertools.combinations(_blocks(open_bits, n), n - max_bits)]
        if max(64 - c.bit_count() for c in chosen) <= max(free, max_bits):
            return chosen
        n += 1


def pivots(n: int = N_PIVOTS) -> np.ndarray:
    """Reference fingerprints: fixed pseudo-random 64-bit words."""
    return np.random.default_rng(8).integers(0, 2**64, n, dtype=np.uint64)


def link_cells(cell: np.ndarray, fp: np.ndarray, max_bits: int, refs: np.ndarray) -> np.ndarray:
    """For rows sorted by cell, the position of the smallest row linked with each row in its cell."""
    n = len(fp)
    label = np.arange(n)
    table = np.bitwise_count(fp[:, None] ^ refs[None, :]).astype(np.int8)
    starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if n else np.empty(0, np.int64)
    end = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n))) if n else label
    live, shift = np.arange(n), 0
    while len(live):
        shift += 1
        live = live[live + shift < end[live]]
        a = live[label[live] != label[live + shift]]
        for k in range(len(refs)):  # discard by the largest coordinate difference
            if not len(a):
                break
            a = a[np.abs(table[a, k] - table[a + shift, k]) <= max_bits]
        b = a + shift
        near = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
        a, b = a[near], b[near]
        while len(a):  # union by smallest root
            ra, rb = label[a], label[b]
            low, high = np.minimum(ra, rb), np.maximum(ra, rb)
            np.minimum.at(label, high, low)
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label = up
            a, b = a[label[a] != label[b]], b[label[a] != label[b]]
    return label


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Re-cut a stream sorted by (mask number, cell) so that no cell is split."""
    kept: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
        if kept is not None:
            now = [np.concatenate(x) for x in zip(kept, now)]
        same = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        kept = [x[cut:] for x in now]
        if cut:
            yield now[0][:cut], now[1][:cut], now[2][:cut]
    if kept is not None and len(kept[0]):
        yield kept[0], kept[1], kept[2]


def _cell_links(cells: DataFrame, max_bits: int) -> DataFrame:
    """(u, v) rows, v the smallest member linked with u in some cell."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = pivots()
        for number, cell, fp in _whole_cells(batches):
            new = (number[1:] != number[:-1]) | (cell[1:] != cell[:-1])
            key = np.concatenate([[0], np.cumsum(new)])
            root = link_cells(key, np.ascontiguousarray(fp).view(np.uint64), max_bits, refs)
            hit = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays([pa.array(fp[hit]), pa.array(fp[root[hit]])], ["u", "v"])

    dealt = cells.repartition("number", "cell").sortWithinPartitions("number", "cell", "fp")
    return dealt.mapInArrow(step, "u long, v long")


def _dealt(fps: DataFrame, masks: list[int]) -> DataFrame:
    cells = F.array(
        *[F.struct(F.lit(k).alias("number"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("cell")) for k, m in enumerate(masks)]
    )
    return fps.select("fp", F.explode(cells).alias("c")).select(F.col("c.number").alias("number"), F.col("c.cell").alias("cell"), "fp")


def links(fps: DataFrame, max_bits: int = MAX_BITS, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """Links (u, v) between distinct fingerprints that join every pair within ``max_bits`` bits."""
    masks = first_masks(max_bits)
    cells = _dealt(fps, masks)
    sizes = cells.groupBy("number", "cell").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stored(cells.join(sizes, ["number", "cell"]).select("number", "cell", "fp", "size"), "simhash-cells")
    small = shared.where(F.col("size") <= cell_limit).drop("size")
    found = _cell_links(small, max_bits)
    hot = shared.where(F.col("size") > cell_limit).select("number", "fp")
    finer = [(i, m) for i, mask in enumerate(masks) for m in second_masks(mask, max_bits)]
    choices: dict[int, list[int]] = {}
    for i, m in finer:
        choices.setdefault(i, []).append(m)
    table = F.create_map(
        *[x for i, ms in choices.items() for x in (F.lit(i), F.array(*[F.lit(_signed(m)) for m in ms]))]
    )
    again = hot.select("number", "fp", F.posexplode(table[F.col("number")]).alias("k", "mask")).select(
        (F.col("number") * 1000 + F.col("k")).alias("number"), F.col("fp").bitwiseAND(F.col("mask")).alias("cell"), "fp"
    )
    return found.unionByName(_cell_links(again, max_bits)).distinct()


# -- components ---------------------------------------------------------------


def _smallest_neighbour(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def connected(pairs: DataFrame) -> DataFrame:
    """(u, root) for every node of the link table (u, v); the root is the smallest node of the component.

    Alternating large-star and small-star rounds; the number of rounds grows
    with the logarithm of the longest chain. Each round is stored, and only a
    row count and a checksum come back to the driver.
    """
    edges = stored(pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _smallest_neighbour(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = _smallest_neighbour(large)
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        edges = stored(small, "stars")
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return edges.select("u", F.col("v").alias("root"))
        state = seen


def components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    cell_limit: int = CELL_LIMIT,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    star = connected(links(distinct.select("fp"), max_bits, cell_limit))
    members = star.select(F.col("u").alias("fp"), "root").unionByName(
        star.select(F.col("root").alias("fp"), "root").distinct()
    )
    linked = members.join(distinct, "fp")
    lowest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = distinct.join(linked.join(lowest, "root").select("fp", "component_id"), "fp", "left").select(
        "fp", F.coalesce("component_id", "first_id").alias("component_id")
    )
    # stored, so that the last join has an exchange on either side and a frequent fingerprint can be split
    named = stored(named, "named-fingerprints")
    return prints.join(named, "fp").select("doc_id", _hex(F.col("fp")).alias("fingerprint"), "component_id")


def _hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that stay, with all their columns: one row of each component."""
    (row,) = fresh(docs, "row")
    sha = F.unhex(F.sha2(text_of(text_col).cast("string"), 256))
    # null where there is an id, so such rows sort first; nullable like the stored rows, else the join casts its
    # key and dropDuplicates must shuffle the texts again
    no_id = F.when(F.col(id_col).isNull(), True)
    keyed = docs.withColumn(row, F.struct(no_id.alias("no_id"), F.col(id_col).alias("id"), sha.alias("sha")))
    # the operator's ids may be of any type: here they are the rows' names
    decided = components(keyed, row, text_col, **options)
    stay = decided.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(row)).distinct()
    # a merge join keeps the partitioning by row, which dropDuplicates then needs no second shuffle for
    return keyed.join(stay.hint("merge"), row, "left_semi").dropDuplicates([row]).select(*docs.columns)
