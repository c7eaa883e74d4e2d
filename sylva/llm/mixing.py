"""Mixing sources to target weights by iterative proportional fitting.

Every document belongs to a cell (source, language, topic). Raking multiplies
the cells' token weights by one factor per source, per language and per topic,
in turn, until the weighted tokens meet all three target marginals. Documents
are then drawn in proportion to their cell's factor, so that the expected
tokens of the sample meet the targets and add up to a token budget. A factor
above 1 cannot be met by single documents: such a document comes whole copies
plus one more by chance, never cut to 1, as that would leave its cell short of
its share and the heavy cells above theirs.

The factors depend only on token sums per cell, so rows are pre-aggregated to
cells before anything else; a hot source costs one row per partition and cell.
Sampling is by a hash of the id, so a rerun or a lost executor gives the same
sample.

Defined results: null source, language or topic is a value of its own; a null
or blank text has no tokens, weighs nothing and is drawn as often as its
cell's other documents; a cell with no tokens at all has factor 1 in its own right (it
moves no marginal); rows with a null id share one draw per text; repeated rows
are drawn alike; targets that contradict one another (a marginal still off by more
than ``ACCEPT``, relatively, after the last round) raise if they were given, and
without given ones are told in ``deviation``; an empty table gives an empty result; other columns are not
read by ``plan_sample`` and come back untouched from ``sample``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, stored, text_of

#: Tokens that the sample should hold, copies included, as a share of all.
BUDGET = 0.6
#: Target marginals are proportional to (token sum) ** exponent, unless given.
EXPONENTS = {"source": 0.5, "lang": 0.7, "topic": 0.7}
ROUNDS = 20
STEP = 4
TOLERANCE = 1e-4
#: Largest relative deviation of a marginal with which given targets count as met.
ACCEPT = 0.01
#: Cells up to this number are broadcast to the documents, else joined by a shuffle.
BROADCAST_CELLS = 20_000

#: The first topic whose pattern is found in a text is its topic. Patterns of
#: bounded length: an open repeat would go over a long run once per character.
TOPICS = [
    ("licence", r"(?i)licen[cs]e"),
    ("table", r" \| "),
    ("contact", r"\w@\w"),
    ("shouting", r"[A-Z]{4}!!"),
    ("markup", r"[#$%&*]{3}"),
]

MARGINS = ("source", "lang", "topic")


def n_tokens(text_col: str = "text") -> Column:
    """Words between white space."""
    return F.regexp_count(text_of(text_col), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def topic_of(text_col: str = "text", topics: list[tuple[str, str]] = TOPICS) -> Column:
    found = F.lit("prose")
    for name, pattern in reversed(topics):
        found = F.when(F.regexp_like(text_of(text_col), F.lit(pattern)), F.lit(name)).otherwise(found)
    return found


def _slim(docs: DataFrame, id_col: str, text_col: str, topics: list[tuple[str, str]]) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        topic_of(text_col, topics).alias("topic"),
        n_tokens(text_col).alias("n_tokens"),
        draw(id_col, text_col).alias("u"),
    )


def draw(id_col: str = "doc_id", text_col: str = "text", seed: int = 11) -> Column:
    """Uniform in [0, 1) from a hash of the id (of the text where the id is null)."""
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.xxhash64(text_of(text_col)).cast("string")))
    return F.shiftrightunsigned(key, 11) / F.lit(float(1 << 53))


def with_targets(cells: DataFrame, targets: dict[str, dict], exponents: dict[str, float]) -> DataFrame:
    """Cells with the target share of their source, language and topic; shares sum to 1 over the values with tokens."""
    raw = {}
    for m in MARGINS:
        n = F.sum("n_tokens").over(Window.partitionBy(m))
        if m in targets:
            value = F.coalesce(*[F.when(F.col(m).eqNullSafe(F.lit(k)), F.lit(float(v))) for k, v in targets[m].items()], F.lit(0.0))
        else:
            value = F.pow(n, F.lit(exponents[m]))
        # a cell's part of its value's target: parts sum to the total of the margin
        raw |= {f"raw_{m}": F.when(n > 0, value).otherwise(0.0), f"part_{m}": F.when(n > 0, value * F.col("n_tokens") / n).otherwise(0.0)}
    prepared = stored(cells.withColumns(raw), "mixing-targets")
    totals = prepared.agg(*[F.sum(f"part_{m}").alias(m) for m in MARGINS]).first()
    shares = [(F.col(f"raw_{m}") / F.lit(float(totals[m] or 0) or 1.0)).alias(f"target_{m}") for m in MARGINS]
    return prepared.select(*MARGINS, "n_tokens", *shares)


def rake(
    cells: DataFrame,
    targets: dict[str, dict] | None = None,
    exponents: dict[str, float] = EXPONENTS,
    rounds: int = ROUNDS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Cells (source, lang, topic, n_tokens) with their raked share ``weight`` of the tokens, and ``deviation``.

    A round scales the weights to the source, language and topic targets in
    turn. Every ``STEP`` rounds the table is stored; raking ends when no
    marginal of the last round was off by more than ``tolerance``. ``deviation``
    is how far, relatively, the last round's worst marginal was from its target.
    """
    total = float(cells.agg(F.sum("n_tokens")).first()[0] or 0) or 1.0
    raked = with_targets(cells, targets or {}, exponents).withColumn("weight", F.col("n_tokens") / F.lit(total))
    off = 0.0
    for done in range(0, rounds, STEP):
        for _ in range(min(STEP, rounds - done)):
            raked = raked.withColumn("off", F.lit(0.0))
            for m in MARGINS:
                now = F.sum("weight").over(Window.partitionBy(m))
                raked = raked.withColumn("scale", F.when(now > 0, F.col(f"target_{m}") / now).otherwise(1.0))
                raked = raked.withColumns(
                    {"weight": F.col("weight") * F.col("scale"), "off": F.greatest("off", F.abs(F.col("scale") - 1))}
                )
        raked = stored(raked, "raked")
        off = raked.where("weight > 0").agg(F.max("off")).first()[0] or 0.0
        if off <= tolerance:
            break
    if targets and off > max(ACCEPT, tolerance):
        raise ValueError(f"the targets are not met together: after {rounds} rounds a marginal is off by {off:.1%}")
    return raked.select(*MARGINS, "n_tokens", "weight", F.lit(off).alias("deviation"))


def probabilities(raked: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Cells with the expected number of draws, ``probability``, of each of their documents.

    It is ``c * factor`` with the factor ``weight / n_tokens`` and ``c`` such that
    the expected tokens are ``budget`` of all; above 1 it stands for copies.
    One row comes to the driver.
    """
    total, weight = raked.agg(F.sum("n_tokens"), F.sum("weight")).first()
    c = budget * float(total or 0) / (weight or 1.0)
    expected = F.when(F.col("n_tokens") > 0, F.round(F.lit(c) * F.col("weight") / F.col("n_tokens"), 12)).otherwise(1.0)
    return raked.select(*MARGINS, F.col("n_tokens").alias("cell_tokens"), "weight", expected.alias("probability"), "deviation")


def copies(expected: Column, u: Column) -> Column:
    """Whole draws of an expected number of them, one more where ``u`` is below its fraction."""
    return (F.floor(expected) + F.when(u < expected - F.floor(expected), 1).otherwise(0)).cast("int")


def _cells(slim: DataFrame) -> DataFrame:
    return stored(slim.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("n_tokens")), "cells")


def _with_cells(rows: DataFrame, names: list[str], cells: DataFrame) -> tuple[DataFrame, str, str, str]:
    """Left join of ``rows`` to the cells on null-safe equality of ``names`` with the margins.

    Also the names of the columns it adds for the cell's weight, probability and deviation.
    """
    added = fresh(rows, *[f"cell_{m}" for m in MARGINS], "cell_weight", "cell_probability", "cell_deviation")
    values = ["weight", "probability", "deviation"]
    side = cells.select(*[F.col(c).alias(a) for c, a in zip([*MARGINS, *values], added)])
    small = cells.count() <= BROADCAST_CELLS
    on = [F.col(n).cast("string").eqNullSafe(F.col(a)) for n, a in zip(names, added)]
    return rows.join(F.broadcast(side) if small else side, on[0] & on[1] & on[2], "left"), *added[3:]


def plan_sample(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", targets=None, budget: float = BUDGET, topics: list[tuple[str, str]] = TOPICS
) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, n_tokens, cell_weight, probability, sampled, deviation.

    ``probability`` is the expected number of draws and may exceed 1; ``sampled``
    is the number of copies in the sample, 0 for a document that is left out.
    """
    slim = stored(_slim(docs, id_col, text_col, topics), "mixing-documents")
    cells = stored(probabilities(rake(_cells(slim), targets), budget), "mixing-cells")
    joined, weight, probability, deviation = _with_cells(slim, list(MARGINS), cells)
    return joined.select(
        "doc_id",
        *MARGINS,
        "n_tokens",
        F.col(weight).alias("cell_weight"),
        F.col(probability).alias("probability"),
        copies(F.col(probability), F.col("u")).alias("sampled"),
        F.col(deviation).alias("deviation"),
    )


def sample(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    targets=None,
    budget: float = BUDGET,
    topics: list[tuple[str, str]] = TOPICS,
    copy_col: str | None = None,
) -> DataFrame:
    """The sampled documents, each as often as it was drawn, with all their columns.

    ``copy_col`` names a column to add: the copy's number from 1, which with the
    id names a row. Their texts are read twice and never shuffled for few cells.
    """
    if copy_col and copy_col.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the documents have a column {copy_col} already")
    slim = _slim(docs, id_col, text_col, topics).select(*MARGINS, "n_tokens")
    cells = stored(probabilities(rake(_cells(slim), targets), budget), "mixing-cells")
    topic, drawn = fresh(docs, "topic", "drawn")
    joined, _, probability, _ = _with_cells(docs.withColumn(topic, topic_of(text_col, topics)), ["source", "lang", topic], cells)
    joined = joined.withColumn(drawn, copies(F.col(probability), draw(id_col, text_col)))
    numbered = joined.where(F.col(drawn) > 0).select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(drawn))).alias(drawn))
    return numbered.withColumnRenamed(drawn, copy_col) if copy_col else numbered.select(*docs.columns)
