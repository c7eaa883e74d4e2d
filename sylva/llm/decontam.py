"""Benchmark decontamination over a distributed positional inverted index.

Index: every task cuts its documents into segments of about ``SEGMENT_WORDS``
words and writes, per segment, the terms and, per term, the ascending positions
at which it stands (its postings). Documents follow each other in a segment's
positions with ``GAP`` free places between them, so that no match crosses from
one into the next. A segment is one row of a Parquet table in the shared
checkpoint folder, as is a table of the documents' places. Building the index
needs no shuffle, and a segment can be searched by itself.

Search: a test item's windows are its runs of ``window`` words (a shorter item
is one window). Per window the terms are ordered by their number of postings in
the whole index. The two rarest terms' lists, each shifted by the term's offset
in the window, are intersected first, then the next rarer ones, until a list is
empty or all terms are through: what is left are the starts of exact phrase
matches. Windows that begin with the same two terms at the same distance share
the first step. With ``slop`` a term may stand up to that many places off its
own, in either direction (the rarest term stays fixed): proximity matches.

The items are dealt by hash into blocks of about ``BLOCK_WORDS`` words; each
block's windows are broadcast to the segments in turn, so that a test set of any
size is searched whole. What the blocks find of a document is put together by
one slim shuffle of the documents that have any.

Defined results: null and empty texts have no words; an item without words has
no window; items with equal ids count once; null item ids are one item, written
as an empty string; documents may have null or repeated ids, each row is
answered by itself; very long documents are one document of a segment;
overlapping matches hit a word once; empty tables give an empty result or
documents without hits; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylva.session import ship_package

from .common import stored, text_of

#: Words of a window.
WINDOW = 10
#: Words in a segment, about (more only where one document has more).
SEGMENT_WORDS = 1 << 20
#: Free places between two documents of a segment; window and slop must fit in.
GAP = 64
#: Test words searched at a time, about.
BLOCK_WORDS = 1 << 20

#: Bytes of a word stay, A-Z in lower case; all others part words.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8."""
    return text.translate(_WORD_BYTES).split()


# -- the index ----------------------------------------------------------------


@dataclass
class Index:
    """A written index.

    ``segments``: segment, length (of its positions), terms array<string>,
    counts array<int>, positions array<int> (the terms' postings one after
    another). ``documents``: segment, place (number in the segment), start
    (first position), n_words, doc_id.
    """

    segments: DataFrame
    documents: DataFrame

    def term_counts(self) -> DataFrame:
        """term, n: postings in the whole index."""
        pairs = F.explode(F.arrays_zip(F.col("terms").alias("term"), F.col("counts").alias("n"))).alias("t")
        return self.segments.select(pairs).groupBy("t.term").agg(F.sum(F.col("t.n").cast("long")).alias("n"))


class _Segment:
    """A segment in the making."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.ids: list[np.ndarray] = []
        self.starts: list[int] = []
        self.lengths: list[int] = []
        self.doc_ids: list = []
        self.end = self.words = 0

    def add(self, doc_id, words: list[bytes]) -> None:
        number = self.number
        for w in set(words).difference(number):
            number[w] = len(number)
        self.ids.append(np.array([number[w] for w in words], np.int32))
        self.starts.append(self.end)
        self.lengths.append(len(words))
        self.doc_ids.append(doc_id)
        self.end += len(words) + GAP
        self.words += len(words)

    def row(self, segment: int, id_type: pa.DataType) -> pa.RecordBatch:
        ids = np.concatenate(self.ids) if self.ids else np.zeros(0, np.int32)
        lengths = np.array(self.lengths, np.int64)
        before = np.cumsum(lengths) - lengths
        place = np.arange(len(ids)) + np.repeat(np.array(self.starts, np.int64) - before, lengths)
        order = np.argsort(ids, kind="stable")
        one = lambda values: pa.array([values])
        docs = pa.StructArray.from_arrays(
            [pa.array(self.starts, pa.int32()), pa.array(self.lengths, pa.int32()), pa.array(self.doc_ids, id_type)],
            ["start", "n_words", "doc_id"],
        )
        return pa.RecordBatch.from_arrays(
            [
                pa.array([segment], pa.int64()),
                pa.array([self.end], pa.int32()),
                pa.ListArray.from_arrays([0, len(self.number)], pa.array(list(self.number), pa.binary()).cast(pa.string())),
                one(np.bincount(ids, minlength=len(self.number)).astype(np.int32)),
                one(place[order].astype(np.int32)),
                pa.ListArray.from_arrays([0, len(docs)], docs),
            ],
            ["segment", "length", "terms", "counts", "positions", "docs"],
        )


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_words: int = SEGMENT_WORDS) -> Index:
    """Write the positional inverted index of all documents."""
    ship_package(docs.sparkSession)
    id_field = docs.schema[id_col]
    id_type = id_field.dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the task's number and a running one: the same when a lost task runs again
        segment = TaskContext.get().partitionId() << 32
        held, kind = _Segment(), None
        for batch in batches:
            kind = batch.schema.field(0).type
            texts = batch.column(1).cast(pa.binary())
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                words = words_of(text.as_py())
                if held.doc_ids and held.end + len(words) > segment_words:
                    yield held.row(segment, kind)
                    segment, held = segment + 1, _Segment()
                held.add(doc_id, words)
        if held.doc_ids:
            yield held.row(segment, kind)

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).cast("string").alias("text"))
    schema = f"segment long, length int, terms array<string>, counts array<int>, positions array<int>, docs array<struct<start:int,n_words:int,doc_id:{id_type}>>"
    written = stored(rows.mapInArrow(step, schema), "positional-index", rows_together=1)
    documents = written.select("segment", F.posexplode("docs").alias("place", "d")).select("segment", "place", "d.start", "d.n_words", "d.doc_id")
    return Index(written, documents)


# -- test windows -------------------------------------------------------------


@dataclass
class Windows:
    """The windows of a block of items over numbered terms, planned from the rarest term on."""

    terms: list[str]
    #: Different windows as [(offset, term), ...], the rarest first; words; the items (numbers) that hold them.
    plans: list[tuple[list[tuple[int, int]], int, list[int]]]
    items: list[str | None]
    #: (rarest term, second, distance) -> windows that begin so.
    anchors: dict[tuple[int, int, int], list[int]]


def plan(items: list[tuple[str | None, list[bytes]]], counts: Counter, window: int = WINDOW) -> Windows:
    """Windows of (item id, words); ``counts`` holds the postings of each word in the index (0 if it has none)."""
    number: dict[bytes, int] = {}
    where: dict[tuple[int, ...], set[int]] = {}
    names: dict[str | None, int] = {}
    for item, words in items:
        k = names.setdefault(item, len(names))
        ids = [number.setdefault(w, len(number)) for w in words]
        for at in range(max(1, len(ids) - window + 1) if ids else 0):
            where.setdefault(tuple(ids[at : at + window]), set()).add(k)
    terms = [w.decode() for w in number]
    n = [counts[t] for t in terms]
    plans, anchors = [], {}
    for ids, held in where.items():
        if any(n[t] == 0 for t in ids):
            continue  # a term that the index does not know
        order = sorted(enumerate(ids), key=lambda ot: (n[ot[1]], ot[0]))
        (o1, t1), (o2, t2) = order[0], order[min(1, len(order) - 1)]
        anchors.setdefault((t1, t2, o2 - o1), []).append(len(plans))
        plans.append((order, len(ids), sorted(held)))
    return Windows(terms, plans, list(names), anchors)


def _meets(starts: np.ndarray, postings: np.ndarray, shift: int, slop: int) -> np.ndarray:
    """Which starts have a posting ``shift`` places on (``slop`` places more or less)."""
    at = np.searchsorted(postings, starts + (shift - slop))
    at[at == len(postings)] = len(postings) - 1
    found = postings[at]
    return (found >= starts + (shift - slop)) & (found <= starts + (shift + slop))


def find(windows: Windows, postings: dict[int, np.ndarray], slop: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """(window, positions of its first word) for the windows that a segment holds."""
    for (t1, t2, apart), members in windows.anchors.items():
        if t1 not in postings or t2 not in postings:
            continue
        rare = postings[t1]
        rare = rare[_meets(rare, postings[t2], apart, slop)]
        if not len(rare):
            continue
        for w in members:
            order = windows.plans[w][0]
            starts = rare - order[0][0]
            for offset, term in order[2:]:
                if term not in postings:
                    starts = starts[:0]
                if not len(starts):
                    break
                starts = starts[_meets(starts, postings[term], offset, slop)]
            if len(starts):
                yield w, starts


# -- search -------------------------------------------------------------------


def _search_block(index: Index, block: DataFrame, counts: DataFrame, window: int, slop: int) -> DataFrame:
    """segment, place, item_id, start, end (positions) of the matches of one block's items, runs put together per item."""
    items = [(r.item_id, words_of(r.text.encode())) for r in block.collect()]  # about BLOCK_WORDS words
    known = block.sparkSession.createDataFrame(
        [(t.decode(),) for t in {w for _, words in items for w in words}], "term string"
    )
    n = Counter({r.term: r.n for r in counts.join(F.broadcast(known), "term").collect()})  # at most the block's terms
    windows = block.sparkSession.sparkContext.broadcast(plan(items, n, window))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = windows.value
        number = {t: k for k, t in enumerate(w.terms)}
        for batch in batches:
            for r in range(batch.num_rows):
                ends = np.cumsum(batch.column(2)[r].values.to_numpy())
                positions = batch.column(3)[r].values.to_numpy()
                postings = {}
                for k, term in enumerate(batch.column(1)[r].values.to_pylist()):
                    if (t := number.get(term)) is not None:
                        postings[t] = positions[ends[k - 1] if k else 0 : ends[k]]
                docs = batch.column(4)[r].values.to_numpy()
                out: list[tuple[np.ndarray, ...]] = []
                by_item: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
                for k, starts in find(w, postings, slop):
                    order, size, held = w.plans[k]
                    inside = np.searchsorted(docs, starts + order[0][0], "right") - 1  # the document of the rarest term
                    for item in held:
                        by_item.setdefault(item, []).append((inside, starts, starts + size))
                for item, found in by_item.items():
                    place, start, end = (np.concatenate(c) for c in zip(*found))
                    if slop:  # the words of a proximity match, as far as the document goes
                        first = docs[place]
                        last = np.append(docs[1:] - GAP, int(batch.column(5)[r].as_py()) - GAP)[place]
                        start, end = np.maximum(start - slop, first), np.minimum(end + slop, last)
                    order = np.lexsort((start, place))
                    start, end, place = start[order], np.maximum.accumulate(end[order]), place[order]
                    head = np.append(True, (start[1:] > end[:-1]) | (place[1:] != place[:-1]))
                    tail = np.append(head[1:], True)
                    out.append((place[head], np.full(head.sum(), item), start[head], end[tail]))
                if not out:
                    continue
                place, item, start, end = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(place), batch.column(0)[r].as_py(), np.int64)),
                        pa.array(place.astype(np.int32)),
                        pa.array([w.items[i] for i in item], pa.string()),
                        pa.array(start.astype(np.int32)),
                        pa.array(end.astype(np.int32)),
                    ],
                    ["segment", "place", "item_id", "start", "end"],
                )

    rows = index.segments.select("segment", "terms", "counts", "positions", F.transform("docs", lambda d: d["start"]).alias("starts"), "length")
    return rows.mapInArrow(step, "segment long, place int, item_id string, start int, end int")


def matches(
    index: Index,
    items: DataFrame,
    window: int = WINDOW,
    slop: int = 0,
    id_col: str = "item_id",
    text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """segment, place, item_id, start, end: the runs of document positions that matches of an item cover.

    ``slop=0``: exact phrases. Otherwise proximity matches, whose runs take in
    the places that a term may stand off. ``join_documents`` turns positions
    into words of a document.
    """
    if window + 2 * slop > GAP or window < 1 or slop < 0:
        raise ValueError(f"window + 2 * slop must be at most {GAP}")
    items = stored(
        items.select(F.col(id_col).cast("string").alias("item_id"), text_of(text_col).cast("string").alias("text")), "test-items"
    )
    # a word has at least one byte and one byte between it and the next
    size = items.agg(F.sum(F.octet_length("text") / 2)).first()[0] or 0
    blocks = max(1, -(-int(size) // block_words))
    counts = stored(index.term_counts(), "term-counts")
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    parts = [
        stored(_search_block(index, dealt.where(F.col("block") == b).select("item_id", "text"), counts, window, slop), "matches") for b in range(blocks)
    ]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found


def join_documents(index: Index, found: DataFrame) -> DataFrame:
    """Matches as doc_id, item_id, first_word, last_word (words of the document from 0, both in the run)."""
    places = index.documents.withColumnRenamed("start", "begin")
    return found.join(places, ["segment", "place"]).select(
        "doc_id", "item_id", (F.col("start") - F.col("begin")).alias("first_word"), (F.col("end") - F.col("begin") - 1).alias("last_word")
    )


def report(index: Index, found: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    runs = F.array_sort(F.collect_list(F.struct("start", "end")))
    # words covered by the runs, walked in order: each adds what lies beyond the furthest end so far
    covered = F.aggregate(
        "runs",
        F.struct(F.lit(0).alias("n"), F.lit(-1).alias("to")),
        lambda a, r: F.struct(
            (a["n"] + F.greatest(r["end"] - F.greatest(r["start"], a["to"]), F.lit(0))).alias("n"), F.greatest(a["to"], r["end"]).alias("to")
        ),
        lambda a: a["n"].cast("long"),
    )
    items = F.array_sort(F.collect_set(F.coalesce("item_id", F.lit(""))))
    hits = (
        found.groupBy("segment", "place")
        .agg(runs.alias("runs"), items.alias("items"))
        .select("segment", "place", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.concat_ws(",", "items").alias("names"))
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return index.documents.join(hits, ["segment", "place"], "left").select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("names", F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Index ``docs``, look up every window of ``items`` and report per document."""
    index = build(docs)
    return report(index, matches(index, items, window))


ORACLE_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS MATERIALIZED (
  SELECT DISTINCT item, least(len(w), 10) AS size, w[i : i + least(len(w), 10) - 1] AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)
), grams AS (
  SELECT rid, size, i, w[i : i + size - 1] AS g
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), hits AS MATERIALIZED (
  SELECT rid, item, i, grams.size FROM grams JOIN windows USING (g)
), words AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + size)) AS p FROM hits) GROUP BY rid
), held AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN held USING (rid)
"""
