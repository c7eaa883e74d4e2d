"""Exact duplicates: frequent digests resolved map-side, the rest by an ordinary shuffle.

A document's digest is the SHA-256 of its text without white space. A
Misra-Gries pass (``DataFrame.stat.freqItems``, the Karp-Schenker-Papadimitriou
form of it) over the digests finds every digest that holds more than
``1 / capacity`` of the rows, maybe with some lighter ones. An exact aggregate
over just those digests verifies their counts and finds their winners: at most
``capacity`` rows, so they are broadcast and the losers of frequent digests are
removed where they are read. What remains has no digest above ``1 / capacity``
of the rows and is dealt out by digest.

Defined results: a null text counts as empty; empty and all-blank texts are one
group; of equal texts the one with the most code points stays, then the
smallest id (null ids last); of repeated rows with the same id and text exactly
one stays; an empty table gives an empty result; other columns are not read by
``decisions`` and come back untouched from ``keep_one``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK, fresh, stored, text_of

#: Counters of the Misra-Gries pass; also the largest number of broadcast winners.
CAPACITY = 1024


def digest_of(text_col: str = "text") -> Column:
    return F.sha2(F.regexp_replace(text_of(text_col), f"{BLANK}+", ""), 256)


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.char_length(text_of(text_col)).alias("n"),
        digest_of(text_col).alias("digest"),
    )


def winners(slim: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Verified winners of the frequent digests: (digest, keep_n, keep_id, group_size).

    At most ``capacity`` rows. The Misra-Gries partials are merged in one task,
    so their number is bounded by a coalesce (no shuffle).
    """
    n_rows = slim.count()
    frequent = slim.select(F.xxhash64("digest").alias("key")).coalesce(256).stat.freqItems(["key"], 1.0 / capacity)
    keys = frequent.select(F.explode("key_freqItems").alias("key"))
    exact = (
        slim.join(F.broadcast(keys), F.xxhash64("digest") == F.col("key"), "left_semi")
        .groupBy("digest")
        .agg(
            F.min(F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id")).alias("w"),
            F.count(F.lit(1)).alias("group_size"),
        )
        .where((F.col("group_size") > 1) & (F.col("group_size") * capacity >= n_rows))
    )
    return stored(
        exact.select("digest", (-F.col("w.n")).alias("keep_n"), F.col("w.doc_id").alias("keep_id"), "group_size"),
        "frequent-digests",
    )


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    slim = stored(_slim(docs, id_col, text_col), "digests")
    marked = slim.join(F.broadcast(winners(slim, capacity)), "digest", "left")
    wins = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("keep_n"))
    loses = F.col("group_size").isNotNull() & ~wins
    removed = marked.where(loses).withColumn("kept", F.lit(False))
    by_digest = Window.partitionBy("digest")
    order = by_digest.orderBy(F.desc("n"), F.asc_nulls_last("doc_id"))
    rest = marked.where(~loses).select(
        "digest",
        "n",
        "doc_id",
        F.when(F.col("group_size").isNull(), F.first("doc_id").over(order)).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.count(F.lit(1)).over(by_digest)).alias("group_size"),
        (F.row_number().over(order) == 1).alias("kept"),
    )
    columns = ["doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")]
    return removed.select(*columns).unionByName(rest.select(*columns))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The documents that stay, with all their columns.

    The losers of frequent digests go map-side; only the other texts are
    shuffled, once, and the first of each digest stays.
    """
    digest, n, keep_n, keep_id, rank = fresh(docs, "digest", "n", "keep_n", "keep_id", "rank")
    heavy = winners(stored(_slim(docs, id_col, text_col), "digests"), capacity).select(
        F.col("digest").alias(digest), F.col("keep_n").alias(keep_n), F.col("keep_id").alias(keep_id)
    )
    order = Window.partitionBy(digest).orderBy(F.desc(n), F.asc_nulls_last(id_col))
    return (
        docs.withColumns({digest: digest_of(text_col), n: F.char_length(text_of(text_col))})
        .join(F.broadcast(heavy), digest, "left")
        .where(F.col(keep_n).isNull() | (F.col(id_col).eqNullSafe(F.col(keep_id)) & (F.col(n) == F.col(keep_n))))
        .withColumn(rank, F.row_number().over(order))
        .where(F.col(rank) == 1)
        .select(*docs.columns)
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER o AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER o = 1 AS kept,
       text_sha256
FROM d
WINDOW o AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id ASC NULLS LAST)
"""
