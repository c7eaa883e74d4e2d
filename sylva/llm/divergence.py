"""Source divergence audit: hash-consed segment trees of term counts.

A group is a (lang, source). Its counts over the lang's kept terms, in order of
term id, are the leaves of a segment tree. Trees are hash-consed: equal
subtrees, of one group or of several, are one node. To compare two groups,
their trees are walked together from the root, and an equal pair of nodes met
again is not walked again but counted: it is priced once, at the leaves, and
its price taken as often as the pair stood there.

The term ids are dealt into blocks of about ``BLOCK`` terms (by hash, so that
no block is hot); within a block they are numbered by falling count, so that
rare terms, whose counts repeat, lie side by side. A task holds one block of at
most two ``CHUNK``s of sources: its trees are subtrees of the whole ones, and
their prices add up over the blocks. The same walk against the lang's own tree
prices the terms.

Counting: each task counts the terms and the documents of its own rows per
(lang, source) and hands on bounded tables; Spark adds them up by (lang,
source, term). No text, group or vocabulary is ever held whole in one place.

Shares are exact: ``p = 1 + floor(UNIT * (count + 1) / (N + V))`` by long
division in two steps, for counts up to 9 * 10**13.

Defined results: null text, lang and source count as ''; a group without terms
has the count 0 for every term; a lang without kept terms has ``pair`` rows of
value 0; a lang with one source has no ``pair`` rows; repeated rows count as
documents of their own; long texts are counted whole; equal values rank by
their UTF-8 item; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylva.session import ship_package

from .common import stored, text_of

#: A term is kept in a lang with this many documents of it.
LEAST_DOCUMENTS = 3
#: What the shares of a group add up to, but for rounding.
UNIT = 1_000_000_000
#: Ranks reported of a group's terms.
TERM_RANKS = 200
#: Terms in a block, about; sources in a chunk, about.
BLOCK = 2048
CHUNK = 64
#: Distinct (group, term) pairs a counting task holds before it hands them on.
HELD = 400_000
#: Langs whose sizes may be broadcast; beyond, they are joined by a shuffle.
BROADCAST_LANGS = 10_000

#: Bytes of a term stay, A-Z in lower case; all others part terms.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(_TERM_BYTES).split()


# -- counting -----------------------------------------------------------------


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), df (documents of that lang and source with the term).

    Every (lang, source) also has a row with a null term.
    """
    ship_package(docs.sparkSession)
    schema = "lang string, source string, term string, n long, df long"

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}

        def hand_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, df) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * (len(n) + 1), pa.string()),
                        pa.array([source] * (len(n) + 1), pa.string()),
                        pa.array([None, *n.keys()], pa.binary()).cast(pa.string()),
                        pa.array([0, *n.values()], pa.int64()),
                        pa.array([0, *(df[t] for t in n)], pa.int64()),
                    ],
                    ["lang", "source", "term", "n", "df"],
                )
            held.clear()

        rows = 0
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, key in enumerate(zip(langs, sources)):
                if key not in held:
                    held[key] = (Counter(), Counter())
                n, df = held[key]
                before = len(n)
                terms = terms_of(texts[i].as_py())
                n.update(terms)
                df.update(set(terms))
                rows += len(n) - before
                if rows > HELD:
                    yield from hand_on()
                    rows = 0
        yield from hand_on()

    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], text_of().alias("text"))
    return (
        rows.mapInArrow(step, schema)
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    )


# -- segment trees ------------------------------------------------------------


def share(count: np.ndarray, total: np.ndarray, unit: int = UNIT) -> np.ndarray:
    """1 + floor(unit * (count + 1) / total), elementwise, by long division (unit = 10**5 * 10**4)."""
    high, rest = np.divmod((count + 1) * (unit // 10_000), np.maximum(total, 1))
    return 1 + high * 10_000 + rest * 10_000 // np.maximum(total, 1)


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Forest:
    """Hash-consed segment trees of several rows of counts, level by level.

    ``levels[0]`` are the leaves: ``counts[i]`` is the count behind leaf node
    i. In each level above, node i has the children ``pairs[i]`` in the level
    below. ``roots[r]`` is the tree of row r.
    """

    def __init__(self, rows: np.ndarray):
        self.width = 1
        while self.width < rows.shape[1]:
            self.width *= 2
        full = np.zeros((rows.shape[0], self.width), np.int64)
        full[:, : rows.shape[1]] = rows
        # places behind the last term get a leaf of their own, which has no price
        full[:, rows.shape[1] :] = -1
        self.counts, at = np.unique(full, return_inverse=True)
        at = at.reshape(full.shape)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        while at.shape[1] > 1:
            known = int(at.max(initial=0)) + 1
            nodes, above = np.unique(at[:, 0::2] * known + at[:, 1::2], return_inverse=True)
            self.levels.append((nodes // known, nodes % known))
            at = above.reshape(at.shape[0], -1)
        self.roots = at[:, 0]

    def nodes(self) -> int:
        return len(self.counts) + sum(len(left) for left, _ in self.levels)

    def meet(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """Walk the trees of rows a[i] and b[i] together.

        Returns (i, count in a, count in b, times) for every different pair of
        leaves, and the number of node pairs looked at.
        """
        walk, x, y = np.arange(len(a)), self.roots[a], self.roots[b]
        times = np.ones(len(a), np.int64)
        looked = len(a)
        for left, right in reversed(self.levels):
            walk = np.concatenate([walk, walk])
            x, y = np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]])
            times = np.concatenate([times, times])
            looked += len(walk)
            known = max(int(x.max(initial=0)), int(y.max(initial=0))) + 1
            key, at = np.unique((walk * known + x) * known + y, return_inverse=True)
            added = np.zeros(len(key), np.int64)
            np.add.at(added, at, times)
            walk, x, y, times = key // (known * known), key // known % known, key % known, added
        real = self.counts[x] >= 0
        return walk[real], self.counts[x[real]], self.counts[y[real]], times[real], looked


def _block_values(table: pa.Table) -> tuple[dict[str, list], dict[str, list]]:
    """One block of a lang for two chunks of sources (or one, with itself): pair values and term values."""
    col = {c: table.column(c).to_numpy(zero_copy_only=False) for c in ("chunk", "n", "total", "kept", "lang_n", "lang_total", "block_terms")}
    source, term = table.column("source").to_pylist(), table.column("term").to_pylist()
    group = [i for i, t in enumerate(term) if t is None]  # the rows of the groups themselves
    names = [source[i] for i in group]
    chunk, total, kept = col["chunk"][group], col["total"][group], int(col["kept"][0])
    number = {s: k for k, s in enumerate(names)}
    cells = [i for i, t in enumerate(term) if t is not None]
    weight = {term[i]: int(col["lang_n"][i]) for i in cells}
    order = sorted(weight, key=lambda t: (-weight[t], t.encode()))
    place = {t: k for k, t in enumerate(order)}
    # the block's terms that these chunks lack stand behind the others, with the count 0
    counts = np.zeros((len(names) + 1, int(col["block_terms"][group[0]])), np.int64)
    for i in cells:
        counts[number[source[i]], place[term[i]]] = col["n"][i]
    counts[-1, : len(order)] = [weight[t] for t in order]
    forest = Forest(counts)
    ci, cj = int(table.column("ci")[0].as_py()), int(table.column("cj")[0].as_py())
    first, second = np.flatnonzero(chunk == ci), np.flatnonzero(chunk == cj)
    a, b = (x.reshape(-1) for x in np.meshgrid(first, second, indexing="ij"))
    if ci == cj:
        a, b = a[a < b], b[a < b]
    walk, x, y, times, _ = forest.meet(a, b)
    p, q = share(x, total[a[walk]] + kept), share(y, total[b[walk]] + kept)
    there, back = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    np.add.at(there, walk, price(p, q) * times)
    np.add.at(back, walk, price(q, p) * times)
    pairs = {
        "source": [names[i] for i in a] + [names[i] for i in b],
        "item": [names[i] for i in b] + [names[i] for i in a],
        "value": np.concatenate([there, back]).tolist(),
    }
    terms: dict[str, list] = {"source": [], "item": [], "value": []}
    if ci == cj:
        lang_total = int(col["lang_total"][0]) + kept
        lang_row = np.full(len(first), len(names))
        walk, x, y, _, _ = forest.meet(first, lang_row)
        p, q = share(x, total[first[walk]] + kept), share(y, np.full(len(y), lang_total))
        good = (x > 0) & (p > q)
        priced = {
            (int(w), int(c), int(d)): int(v) for w, c, d, v in zip(walk[good], x[good], y[good], price(p[good], q[good]))
        }
        for w, row in enumerate(first.tolist()):
            found = [
                (-value, order[k].encode(), order[k])
                for k in np.flatnonzero(counts[row])
                if (value := priced.get((w, int(counts[row, k]), int(counts[-1, k])))) is not None
            ]
            for value, _, name in sorted(found)[:TERM_RANKS]:
                terms["source"].append(names[row])
                terms["item"].append(name)
                terms["value"].append(-value)
    return pairs, terms


# -- the audit ----------------------------------------------------------------


def _sizes_join(left: DataFrame, sizes: DataFrame, n_langs: int) -> DataFrame:
    return left.join(F.broadcast(sizes) if n_langs <= BROADCAST_LANGS else sizes, "lang")


def audit(docs: DataFrame, block: int = BLOCK, chunk: int = CHUNK, least: int = LEAST_DOCUMENTS, ranks: int = TERM_RANKS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank, over all documents (columns text, lang, source)."""
    if ranks > TERM_RANKS:
        raise ValueError(f"at most {TERM_RANKS} ranks")
    counts = stored(count_terms(docs), "term-counts")
    terms = (
        counts.where(F.col("term").isNotNull())
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df"))
        .where(F.col("df") >= least)
        .select("lang", "term", "lang_n")
    )
    kept = stored(terms, "kept-terms")
    cells = stored(counts.join(kept, ["lang", "term"]), "kept-counts")
    groups = counts.where(F.col("term").isNull()).select("lang", "source")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = stored(
        groups.join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total")), "groups"
    )
    sizes = stored(
        groups.groupBy("lang")
        .agg(F.count(F.lit(1)).alias("n_sources"))
        .join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total")), "lang", "left")
        .fillna(0, ["kept", "lang_total"])
        .select(
            "lang",
            "kept",
            "lang_total",
            F.ceil(F.greatest(F.col("kept"), F.lit(1)) / block).cast("int").alias("blocks"),
            F.ceil(F.col("n_sources") / chunk).cast("int").alias("chunks"),
        ),
        "lang-sizes",
    )
    n_langs = sizes.count()
    in_block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    in_chunk = F.pmod(F.xxhash64("source"), F.col("chunks")).cast("int").alias("chunk")
    # a block's task pairs two chunks: each chunk goes to the tasks of all its pairs
    pairs = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    facts = ["kept", "lang_total"]
    nothing = F.lit(0).cast("long")
    block_terms = _sizes_join(kept, sizes, n_langs).groupBy("lang", in_block).agg(F.count(F.lit(1)).alias("block_terms"))
    of_groups = (
        _sizes_join(groups, sizes, n_langs)
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        .join(block_terms, ["lang", "block"], "left")
        .select(
            "lang", "source", F.lit(None).cast("string").alias("term"), nothing.alias("n"), "total", nothing.alias("lang_n"),
            F.coalesce("block_terms", nothing).alias("block_terms"), in_chunk, *facts, "chunks", "block",
        )
    )
    of_cells = _sizes_join(cells, sizes, n_langs).select(
        "lang", "source", "term", "n", nothing.alias("total"), "lang_n", nothing.alias("block_terms"), in_chunk, *facts, "chunks", in_block
    )
    rows = of_groups.unionByName(of_cells).select("*", pairs)
    rows = rows.select("*", F.least("chunk", "other").alias("ci"), F.greatest("chunk", "other").alias("cj")).drop("other", "chunks")

    def step(key: tuple, table: pa.Table) -> pa.Table:
        lang = key[0].as_py()
        out = [(part, values) for part, values in zip(("pair", "term"), _block_values(table))]
        return pa.table(
            {
                "lang": pa.array([lang] * sum(len(v["value"]) for _, v in out), pa.string()),
                "part": pa.array([part for part, v in out for _ in v["value"]], pa.string()),
                "source": pa.array([s for _, v in out for s in v["source"]], pa.string()),
                "item": pa.array([s for _, v in out for s in v["item"]], pa.string()),
                "value": pa.array([s for _, v in out for s in v["value"]], pa.int64()),
            }
        )

    priced = stored(
        rows.groupBy("lang", "block", "ci", "cj").applyInArrow(step, "lang string, part string, source string, item string, value long"),
        "block-prices",
    )
    added = (
        priced.where(F.col("part") == "pair").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    )
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    names = ["lang", "source", "part", "item", "value"]
    best = priced.where(F.col("part") == "term").select(*names).withColumn("rank", rank).where(F.col("rank") <= ranks)
    return added.select(*names).withColumn("rank", rank).unionByName(best)


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), w AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 3
), groups AS MATERIALIZED (
  SELECT DISTINCT lang, source FROM d
), counts AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, k.lang_n, coalesce(c.n, 0) AS n
  FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term) c
    ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), sized AS (
  SELECT *, CAST(sum(n) OVER (PARTITION BY lang, source) AS HUGEINT) AS total,
         CAST(count(*) OVER (PARTITION BY lang, source) AS HUGEINT) AS v,
         CAST(sum(n) OVER (PARTITION BY lang) AS HUGEINT) AS lang_total
  FROM counts
), shares AS MATERIALIZED (
  SELECT lang, source, term, n, CAST(1 + (CAST(1000000000 AS HUGEINT) * (n + 1)) // (total + v) AS HUGEINT) AS p,
         CAST(1 + (CAST(1000000000 AS HUGEINT) * (lang_n + 1)) // (lang_total + v) AS HUGEINT) AS q
  FROM sized
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY x.lang, x.source, y.source
  ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM shares WHERE n > 0 AND p > q
), parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value FROM terms
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
) WHERE part = 'pair' OR rank <= 200
"""
