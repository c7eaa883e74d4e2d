"""Suffix-array dedup: remove every byte of a long string that also starts elsewhere.

Texts are byte strings. Sorting all their suffixes would move every byte many
times over, so suffixes are first thinned without losing a match: of the
``GRAM``-byte strings in a window of ``length`` bytes the one with the smallest
hash is its anchor. Equal windows have equal anchors at equal offsets, so two
equal windows meet if the suffixes at their anchors meet. About one position
in ``length / 2`` is an anchor; anchors whose hash occurs once are dropped at
once, by a partial aggregate and a join that Spark can split.

The remaining anchors travel with the bytes that their windows cover. Tasks
sort them as suffixes, once to the right of the anchor and once (reversed) to
its left: a bottom-up mergesort in which a comparison finds the common
extension of two suffixes by binary search over prefix polynomial hashes. The
common extensions of neighbours are then verified on the bytes themselves; if a
hash collision has misled a comparison, that batch is sorted by its bytes. A
window that reaches ``o`` bytes left of its anchor is repeated if another
anchor shares both its run of right extensions of ``length - o`` or more and
its run of left extensions of ``o`` or more.

Equal texts are matched once. An anchor hash with more than ``hot_limit`` rows
is never gathered: the windows of its anchors are counted by a 128-bit digest,
pre-aggregated, and joined back.

Defined results: null and empty texts have no bytes; texts shorter than
``length`` keep all of them; of equal texts, all lose all bytes (each occurs in
the others) if they are long enough; very long texts are worked in pieces with
an overlap; repeated rows get equal results; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylva.session import ship_package

from .common import stored, text_of
from .polyhash import mixed, piece, prefix

LENGTH = 200
GRAM = 32
#: Rows of one anchor hash that are gathered in a task.
HOT_LIMIT = 30_000
#: Bytes of text hashed at once, and suffixes sorted at once (whole groups beyond that).
SEGMENT = 1 << 18
BATCH = 10_000

# -- anchors ------------------------------------------------------------------


def anchors(data: np.ndarray, doc_end: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Anchors of concatenated documents: (hash, place, most and least bytes its windows reach left of it)."""
    n = len(data) - length + 1
    if n < 1:
        empty = np.empty(0, np.int64)
        return empty.view(np.uint64), empty, empty, empty
    sums = prefix(data)
    at = np.arange(len(data) - gram + 1)
    h = mixed(piece(sums, at, at + gram))
    low = (h & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    want, have = length - gram + 1, 1
    while have < want:  # sliding minimum by doubling
        step = min(have, want - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    place = (low[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.arange(n)
    inside = start + length <= doc_end[:n]
    start, place = start[inside], place[inside]
    if not len(start):
        return h[:0], place, place, place
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.append(first[1:], len(place)) - 1
    place_of = place[first]
    return h[place_of], place_of, place_of - start[first], place_of - start[last]


def _segments(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]]:
    """Pieces of about SEGMENT bytes: data, end of the document of each byte, (place, document, place in it)."""
    held, size = [], 0
    for k, text in enumerate(texts):
        if len(text) < length:
            continue
        for a in range(0, max(len(text) - length + 1, 1), SEGMENT):
            part = text[a : a + SEGMENT + length - 1]
            held.append((part, k, a))
            size += len(part)
            if size >= SEGMENT:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held):
    sizes = np.array([len(p) for p, _, _ in held])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(p for p, _, _ in held), np.uint8)
    return data, np.repeat(ends, sizes), list(zip((ends - sizes).tolist(), [k for _, k, _ in held], [a for _, _, a in held]))


def text_anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """(document, hash, place in it, most, least) of all anchors of the texts."""
    out = []
    for data, ends, parts in _segments(texts, length):
        h, place, most, least = anchors(data, ends, length, gram)
        begin = np.array([p[0] for p in parts])
        part = np.searchsorted(begin, place, side="right") - 1
        doc = np.array([p[1] for p in parts])[part]
        out.append((doc, h, place - begin[part] + np.array([p[2] for p in parts])[part], most, least))
    if not out:
        empty = np.empty(0, np.int64)
        return empty, empty.view(np.uint64), empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*out))


# -- hash-compared suffix sort ------------------------------------------------


def common_extension(sums, a, b, place_a, place_b, most) -> np.ndarray:
    """Longest common extension of the suffixes at ``a`` and ``b``, up to ``most``, by binary search on hashes."""
    low, high = np.zeros(len(a), np.int64), most.astype(np.int64).copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high + 1) >> 1
        same = piece(sums, a, a + mid, place_a) == piece(sums, b, b + mid, place_b)
        low = np.where(open_ & same, mid, low)
        high = np.where(open_ & ~same, mid - 1, high)


def _before(data, sums, place, start, size, group, x, y) -> np.ndarray:
    """Whether suffix x sorts before suffix y: by group, bytes, length, then number."""
    out = group[x] < group[y]
    k = np.flatnonzero(group[x] == group[y])
    if len(k):
        a, b = x[k], y[k]
        most = np.minimum(size[a], size[b])
        common = common_extension(sums, start[a], start[b], place[a], place[b], most)
        cut = common == most
        last = len(data) - 1
        byte_a, byte_b = data[np.minimum(start[a] + common, last)], data[np.minimum(start[b] + common, last)]
        tie = (size[a] < size[b]) | ((size[a] == size[b]) & (a < b))
        out[k] = np.where(cut, tie, byte_a < byte_b)
    return out


def sort_suffixes(data: np.ndarray, begin: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Bottom-up mergesort of the suffixes; rows come with equal groups together, in ascending order.

    ``begin`` is where each row's string begins in ``data``, ascending from 0.
    """
    n = len(start)
    # powers count from the start of the string that a suffix stands in: a few hundred serve all
    from_begin = np.arange(len(data), dtype=np.int32) - np.repeat(begin, np.diff(np.append(begin, len(data)))).astype(np.int32)
    sums, place = prefix(data, from_begin), start - begin
    order, run = np.arange(n), 1
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
    widest = int(np.diff(edge).max(initial=0))
    while run < n and (run < 2 * widest or run == 1):
        at = np.arange(n)
        base = at // (2 * run) * (2 * run)
        left = at - base < run
        # rank among the sibling run, by binary search
        low = np.where(left, np.minimum(base + run, n), base)
        first = low.copy()
        high = np.where(left, np.minimum(base + 2 * run, n), base + run)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) >> 1
            less = _before(data, sums, place, start, size, group, order[mid], order[open_])
            low[open_[less]] = mid[less] + 1
            high[open_[~less]] = mid[~less]
        own = at - np.where(left, base, base + run)
        merged = np.empty_like(order)
        merged[base + own + (low - first)] = order
        order, run = merged, 2 * run
    return order


def verified_runs(data, begin, start, size, group, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order and the exact common extension of each suffix with the one before it (-1 across groups)."""
    order = sort_suffixes(data, begin, start, size, group)
    room = np.concatenate([data, np.zeros(width, np.uint8)])
    table = np.lib.stride_tricks.sliding_window_view(room, width)

    def exact(order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out = np.full(len(order), -1, np.int64)
        wrong = np.zeros(len(order), bool)
        for a in range(1, len(order), 8192):
            x, y = order[a - 1 : a + 8191][: len(order) - a], order[a : a + 8192]
            differ = table[start[x]] != table[start[y]]
            first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
            shared = np.minimum(first, np.minimum(size[x], size[y]))
            last = len(room) - 1
            after = room[np.minimum(start[x] + shared, last)] > room[np.minimum(start[y] + shared, last)]
            inner = (shared < size[x]) & (shared < size[y])
            same = group[x] == group[y]
            wrong[a : a + 8192] = same & np.where(inner, after, size[x] > size[y])
            out[a : a + 8192] = np.where(same, shared, -1)
        return out, wrong

    common, wrong = exact(order)
    if wrong.any():  # a hash collision misled a comparison: sort these rows by their bytes
        keys = [data[s : s + n].tobytes() for s, n in zip(start, size)]
        order = np.array(sorted(range(len(start)), key=lambda i: (group[i], keys[i], i)))
        common, _ = exact(order)
    return order, common


def repeated_windows(spans: list[bytes], reach: np.ndarray, group: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Per row and offset: does the window that starts ``offset`` bytes left of the anchor occur in another row?

    A span holds the bytes of all windows of an anchor that stands ``reach``
    bytes into it; rows come with equal groups together, groups ascending.
    """
    n = len(spans)
    sizes = np.array([len(s) for s in spans])
    begin = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(spans), np.uint8)
    anchor, end = begin + reach, begin + sizes
    right, right_common = verified_runs(data, begin, anchor, end - anchor, group, length)
    # left of the anchor, read backwards: the strings themselves are turned around
    turned = np.arange(len(data)) - np.repeat(begin, sizes)
    mirror = data[np.repeat(end, sizes) - 1 - turned]
    left, left_common = verified_runs(mirror, begin, end - reach, reach, group, length)
    least = length - (end - anchor)  # offsets of an anchor's windows: least..reach
    widest = int(reach.max(initial=0))
    out = np.zeros((n, widest + 1), bool)
    right_run, left_run = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(widest + 1):
        on = np.flatnonzero((least <= o) & (o <= reach))
        if len(on) < 2:
            continue
        right_run[right] = np.cumsum(right_common < length - o)
        left_run[left] = np.cumsum(left_common < o)
        key = right_run[on] * (n + 1) + left_run[on]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        out[on[by[twice]], o] = True
    return out


# -- Spark --------------------------------------------------------------------


def _packed(place: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    return (place << 16) | (most << 8) | least


def _anchor_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(h, key, at) of every anchor; ``at`` packs its place and its windows' reach, a byte each."""
    if not 0 < gram <= length <= gram + 255:
        raise ValueError(f"the length must be from {gram} to {gram + 255} bytes with anchors of {gram}")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                raw = [(t or "").encode("utf-8", "surrogatepass") for t in part.column(1).to_pylist()]
                doc, h, place, most, least = text_anchors(raw, length, gram)
                keys = part.column(0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(keys[doc]), pa.array(_packed(place, most, least))], ["h", "key", "at"]
                )

    return texts.select("key", "text").mapInArrow(step, "h long, key long, at long")


def _intervals_of(ids, places, marks: np.ndarray, length: int) -> pa.RecordBatch:
    """Rows (id, start, end) of the byte runs that the marked windows cover."""
    edge = np.diff(np.pad(marks, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    _, stop = np.nonzero(edge == -1)
    start = places[row] - (stop - 1)
    return pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array(start), pa.array(places[row] - first + length)], ["id", "start", "end"])


def _group_intervals(spans: DataFrame, length: int) -> DataFrame:
    """Intervals (id, start, end) of repeated bytes, from the spans of anchors with equal hashes."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solve(rows: pa.Table):
            rows = rows.combine_chunks()
            _, group = np.unique(rows.column("h").to_numpy(), return_inverse=True)
            marks = repeated_windows(rows.column("span").to_pylist(), rows.column("reach").to_numpy().astype(np.int64), group, length)
            return _intervals_of(rows.column("id").combine_chunks(), rows.column("place").to_numpy(), marks, length)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < BATCH:
                continue
            rows = pa.Table.from_batches(held)
            h = rows.column("h").to_numpy()
            cut = int(np.argmax(h == h[-1]))  # the last group may go on in the next batch
            if cut:
                yield solve(rows.slice(0, cut))
            held = rows.slice(cut).to_batches()
        if held:
            yield solve(pa.Table.from_batches(held))

    dealt = spans.repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(step, "id binary, start long, end long")


def _span_rows(placed: DataFrame, length: int, gram: int) -> DataFrame:
    """(h, id, place, reach, span) per anchor, from (id, text, ats)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                row, places, reaches, spans, grams = [], [], [], [], []
                for i, (text, ats) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                    raw = text.encode("utf-8", "surrogatepass")
                    for at in ats:
                        place, most, least = at >> 16, (at >> 8) & 255, at & 255
                        if place - least + length > len(raw):
                            continue  # of another text with the same 64-bit key
                        row.append(i)
                        places.append(place)
                        reaches.append(most)
                        spans.append(raw[place - most : place - least + length])
                        grams.append(raw[place : place + gram])
                if not row:
                    continue
                data = np.frombuffer(b"".join(grams), np.uint8)
                at = np.arange(len(row)) * gram
                h = mixed(piece(prefix(data), at, at + gram)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), part.column(0).take(pa.array(row)), pa.array(places, pa.int64()), pa.array(reaches, pa.int32()), pa.array(spans, pa.binary())],
                    ["h", "id", "place", "reach", "span"],
                )

    return placed.mapInArrow(step, "h long, id binary, place long, reach int, span binary")


def _hot_windows(placed: DataFrame, length: int) -> DataFrame:
    """(digest, id, start) of every window of the hot anchors."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for k in range(batch.num_rows):
                raw = batch.column(1)[k].as_py().encode("utf-8", "surrogatepass")
                starts = [s for at in batch.column(2)[k].as_py() for s in range((at >> 16) - ((at >> 8) & 255), (at >> 16) - (at & 255) + 1)]
                starts = [s for s in starts if s + length <= len(raw)]
                digests = [xxhash.xxh3_128_digest(raw[s : s + length]) for s in starts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), batch.column(0).take(pa.array([k] * len(starts), pa.int64())), pa.array(starts, pa.int64())],
                    ["digest", "id", "start"],
                )

    return placed.mapInArrow(step, "digest binary, id binary, start long")


def _texts(docs: DataFrame, text_col: str, length: int) -> DataFrame:
    """(id, text) of the texts that are long enough to hold a window."""
    rows = docs.select(_id(text_col).alias("id"), text_of(text_col).cast("string").alias("text"))
    return rows.where(F.octet_length("text") >= length)


def _distinct(texts: DataFrame) -> DataFrame:
    """Each text once: equal texts fold before the shuffle. Plans that use it twice share that shuffle."""
    return texts.groupBy("id").agg(F.first("text").alias("text"))


def repeated_intervals(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot_limit: int = HOT_LIMIT) -> DataFrame:
    """(id, start, end): repeated byte runs of each distinct text; ``id`` is the first half of its SHA-256."""
    ship_package(docs.sparkSession)
    texts = _texts(docs, text_col, length)
    keyed = texts.withColumn("key", F.xxhash64("id"))
    rows = _anchor_rows(keyed, length, gram)
    place = F.xxhash64("key", "at")
    counts = rows.groupBy("h").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.count(F.lit(1)).alias("n"))
    # stored, so that the join has an exchange on either side and a frequent hash can be split
    twice = stored(counts.where("a <> b").select("h", (F.col("n") > hot_limit).alias("hot")), "repeated-anchors")
    places = rows.join(twice, "h").groupBy("key", "hot").agg(F.collect_set("at").alias("ats"))
    ids = keyed.select("id", "key").distinct()
    places = stored(places.join(ids, "key").select("id", "ats", "hot"), "anchor-places")
    single = _distinct(texts)
    placed = single.join(places.where("NOT hot"), "id").select("id", "text", "ats")
    found = _group_intervals(_span_rows(placed, length, gram), length)
    if places.where("hot").isEmpty():
        return found
    # like the spans and the cut, these read the texts from the one shuffle of ``single``
    windows = _hot_windows(single.join(places.where("hot"), "id").select("id", "text", "ats"), length)
    where = F.struct("id", "start")
    shared = windows.groupBy("digest").agg(F.min(where).alias("a"), F.max(where).alias("b")).where("a <> b").select("digest")
    return found.unionByName(windows.join(shared, "digest").select("id", "start", (F.col("start") + length).alias("end")))


def _id(text_col: str):
    return F.unhex(F.substring(F.sha2(text_of(text_col).cast("string"), 256), 1, 32))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot_limit: int = HOT_LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spans = repeated_intervals(docs, text_col, length, gram, hot_limit)
    by_text = spans.groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                out = [
                    _cut(text.encode("utf-8", "surrogatepass"), [(s["start"], s["end"]) for s in spans])
                    for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist())
                ]
                removed, runs, shas = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(shas)],
                    ["id", "n_removed", "n_spans", "kept_sha256"],
                )

    cut = (
        _distinct(_texts(docs, text_col, length))
        .join(by_text, "id")
        .select("id", "text", "spans")
        .mapInArrow(step, "id binary, n_removed long, n_spans long, kept_sha256 string")
    )
    slim = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            _id(text_col).alias("id"),
            F.sha2(text_of(text_col).cast("string"), 256).alias("text_sha256"),
            F.octet_length(text_of(text_col).cast("string")).cast("long").alias("n_bytes"),
        ),
        "text-sizes",
    )
    copies = slim.groupBy("id").agg((F.count(F.lit(1)) > 1).alias("copied"))
    by_text = stored(copies.join(cut, "id", "left"), "cut-texts")
    everything = F.col("copied") & (F.col("n_bytes") >= length)
    return slim.join(by_text, "id").select(
        "doc_id",
        "n_bytes",
        F.when(everything, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(everything, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(everything, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha256", "text_sha256")).alias("kept_sha256"),
    )


#: The contract by a table of all windows (DuckDB; byte strings, so no digest is trusted).
ORACLE_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents
), windows AS (
  SELECT rid, s, b[s + 1 : s + 200] AS w
  FROM (SELECT rid, b, unnest(range(0, octet_length(b) - 199)) AS s FROM docs WHERE octet_length(b) >= 200)
), hits AS (
  SELECT rid, s FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)
), numbered AS (
  SELECT rid, s, sum(fresh) OVER (PARTITION BY rid ORDER BY s) AS run
  FROM (SELECT rid, s, CASE WHEN s <= lag(s) OVER (PARTITION BY rid ORDER BY s) + 200 THEN 0 ELSE 1 END AS fresh FROM hits)
), runs AS (
  SELECT rid, min(s) AS a, max(s) + 200 AS e FROM numbered GROUP BY rid, run
), edges AS (
  SELECT rid, a, e, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY a), 0) AS prev FROM runs
), pieces AS (
  SELECT rid, a, e, e - a AS gone, hex(b[prev + 1 : a]) AS kept FROM edges JOIN docs USING (rid)
  UNION ALL
  SELECT rid, octet_length(b), octet_length(b), 0, hex(b[coalesce(e, 0) + 1 : octet_length(b)])
  FROM docs LEFT JOIN (SELECT rid, max(e) AS e FROM runs GROUP BY rid) USING (rid)
)
SELECT any_value(doc_id) AS doc_id, CAST(any_value(octet_length(b)) AS BIGINT) AS n_bytes, CAST(sum(gone) AS BIGINT) AS n_removed,
  CAST(count(*) FILTER (WHERE gone > 0) AS BIGINT) AS n_spans,
  sha256(unhex(string_agg(kept, '' ORDER BY a, e, gone DESC))) AS kept_sha256
FROM pieces JOIN docs USING (rid) GROUP BY rid
"""


def _cut(raw: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, str]:
    """Bytes removed, maximal removed runs, and the SHA-256 of what is left."""
    kept, at, runs, removed = hashlib.sha256(), 0, 0, 0
    for start, end in sorted(spans):
        if start > at or not runs:
            kept.update(raw[at:start])
            runs += 1
            removed += end - start
            at = end
        elif end > at:
            removed += end - at
            at = end
    kept.update(raw[at:])
    return removed, runs, kept.hexdigest()
