"""License scans: ordered signature rules behind a keyword gate.

A text is read as a sequence of words. Rules are regular expressions over the
space-joined words; each has a label, a priority tier and a keyword. A rule is
tried only on texts that hold its keyword, and no rule on texts without one of
``GATES``: the letters ``licen``, or a phrase that leads in a name without the
licence word (every rule needs one of them). Detections are intervals; one that lies inside a detection of a higher or the same tier is
suppressed, so ``GNU Lesser General Public License v2.1`` is not also reported
as plain GPL wording. Everything is a column expression on the row: no
shuffle, no join, no Python.

Defined results: null and wordless texts have no words, places or labels, and
score 0; long texts are scanned whole; repeated rows get equal results; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: Fixed values of the base contract: phrase and label.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: What separates words, once letters are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Hand-written licence names over space-joined lower-case words: label, the
# keyword that must occur (empty: its names share none), and the name. ``N``
# stands for an optional version.
N = r"(?: (?:v|version|v ))?(?: ?\d+(?: \d+){0,3})?"
FAMILIES = [
    ("mit", "", r"(?:the )?(?:mit|expat)(?: x11)?"),
    ("apache", "apache", rf"(?:the )?apache(?: software)?(?: license)?{N}"),
    ("gpl", "gpl", rf"(?:the )?(?:gnu )?gpl{N}(?: or later| only)?"),
    ("gpl", "general public", rf"(?:the )?(?:gnu )?general public{N}"),
    ("lgpl", "lgpl", rf"(?:the )?(?:gnu )?lgpl{N}(?: or later| only)?"),
    ("lgpl", "lesser general", r"(?:the )?(?:gnu )?lesser general public"),
    ("lgpl", "library general", r"(?:the )?(?:gnu )?library general public"),
    ("agpl", "agpl", rf"(?:the )?(?:gnu )?agpl{N}(?: or later| only)?"),
    ("agpl", "affero general", r"(?:the )?(?:gnu )?affero general public"),
    ("gfdl", "free documentation", rf"(?:the )?(?:gnu )?free documentation{N}"),
    ("bsd", "bsd", r"(?:the )?(?:new |modified |simplified |revised )?(?:[0234] clause )?bsd(?: [0234] clause)?"),
    ("mpl", "mozilla", rf"(?:the )?mozilla public{N}"),
    ("mpl", "mpl", rf"(?:the )?mpl{N}"),
    ("epl", "eclipse", rf"(?:the )?eclipse (?:public|distribution){N}"),
    ("cc-by", "cc by", r"cc by(?: \d \d)?"),
    ("cc-by-sa", "cc by sa", r"cc by sa(?: \d \d)?"),
    ("cc-by-nd", "cc by nd", r"cc by nd(?: \d \d)?"),
    ("cc-by-nc", "cc by nc", r"cc by nc(?: \d \d)?"),
    ("cc-by-nc-sa", "cc by nc sa", r"cc by nc sa(?: \d \d)?"),
    ("cc-by-nc-nd", "cc by nc nd", r"cc by nc nd(?: \d \d)?"),
    ("cc0", "cc0", r"cc0(?: 1 0)?"),
    ("cc", "creative commons", r"(?:a |the )?creative commons(?: attribution| zero| noncommercial| share ?alike| no ?derivatives| international| \d \d){0,8}"),
    ("isc", "isc", r"(?:the )?isc"),
    ("zlib", "zlib", r"(?:the )?zlib(?: libpng)?"),
    ("boost", "boost", rf"(?:the )?boost(?: software)?{N}"),
    ("artistic", "artistic", rf"(?:the )?(?:perl )?artistic{N}"),
    ("wtfpl", "wtfpl", rf"(?:the )?wtfpl{N}"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("cddl", "cddl", rf"(?:the )?cddl{N}"),
    ("cddl", "common development", r"(?:the )?common development and distribution"),
    ("cpl", "common public", rf"(?:the )?(?:ibm )?common public{N}"),
    ("eupl", "eupl", rf"(?:the )?eupl{N}"),
    ("eupl", "european union public", rf"(?:the )?european union public{N}"),
    ("ofl", "open font", rf"(?:the )?(?:sil )?open font{N}"),
    ("osl", "open software", rf"(?:the )?open software{N}"),
    ("afl", "academic free", rf"(?:the )?academic free{N}"),
    ("python", "python software", r"(?:the )?python software foundation"),
    ("php", "php", rf"(?:the )?php{N}"),
    ("ruby", "ruby", r"(?:the )?ruby"),
    ("postgresql", "postgresql", r"(?:the )?postgresql"),
    ("openssl", "openssl", r"(?:the )?openssl"),
    ("ms-pl", "microsoft public", r"(?:the )?microsoft public"),
    ("ms-rl", "microsoft reciprocal", r"(?:the )?microsoft reciprocal"),
    ("ncsa", "ncsa", r"(?:the )?(?:university of illinois )?(?:open source )?ncsa(?: open source)?"),
    ("odbl", "open database", r"(?:the )?(?:odc )?open database"),
    ("sspl", "server side public", rf"(?:the )?server side public{N}"),
    ("bsl", "business source", rf"(?:the )?business source{N}"),
    ("proprietary", "proprietary", r"(?:a |the )?(?:commercial |closed )?proprietary"),
    ("public-domain", "public domain", r"(?:the )?public domain"),
    ("upl", "universal permissive", rf"(?:the )?universal permissive{N}"),
]

#: What may stand before a licence's name without the licence word.
LEADS = ["subject to", "governed by", "released under", "distributed under", "available under"]

# How a licence is named in running text: tier (0 strongest), confidence, and
# the signature around the name.
FORMS = [
    (0, 1.0, "spdx license identifier {name}"),
    (1, 0.9, "(?:re)?licensed (?:to \\S+ )?under (?:the terms of )?{name}(?: licen[cs]e)?(?: version \\d+(?: \\d+){0,3})?"),
    (1, 0.9, "licen[cs]e(?:s|d)? (?:is |are )?{name}(?: licen[cs]e)?"),
    (2, 0.7, "{name} (?:public )?licen[cs]e(?: agreement)?(?: v| version)?(?: ?\\d+(?: \\d+){0,3})?"),
    (2, 0.6, f"(?:{'|'.join(LEADS)}) {{name}}(?: licen[cs]e)?"),
]

#: Every signature holds one of these: the last form a lead, the others the licence word.
GATES = ["licen", *(f" {lead} " for lead in LEADS)]

#: The rule table: tier, confidence, label, keyword, signature. In rule order.
RULES = [
    (tier, conf, label, keyword, f"(?<= ){form.replace("{name}", name)}(?= )")
    for tier, conf, form in FORMS
    for label, keyword, name in FAMILIES
]
TIERS = 1 + max(r[0] for r in RULES)


def words_joined(text_col: str = "text") -> Column:
    """The words, each between single spaces; the empty text is one space."""
    return F.regexp_replace(F.concat(F.lit(" "), F.lower(text_of(text_col)), F.lit(" ")), GAP, " ")


def _rule_table() -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("rule"), F.lit(t).alias("tier"), F.lit(c).alias("conf"), F.lit(label).alias("label"),
                F.lit(k).alias("keyword"), F.lit(sig).alias("signature"),
            )
            for i, (t, c, label, k, sig) in enumerate(RULES)
        ]
    )


def _hits(joined: Column, rule: Column) -> Column:
    """Intervals of a rule's matches, from the lengths of the pieces around them."""
    found = F.regexp_extract_all(joined, rule["signature"], F.lit(0))
    between = F.split(joined, rule["signature"], -1)
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.char_length(pair["gap"])
        end = start + F.char_length(pair["hit"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end")))).alias("out"))

    pairs = F.transform(found, lambda hit, i: F.struct(F.get(between, i).alias("gap"), hit.alias("hit")))
    spans = F.aggregate(pairs, first, step)["out"]
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("neg_end"), rule["tier"].alias("tier"),
            rule["rule"].alias("rule"), rule["label"].alias("label"), rule["conf"].alias("conf"),
        ),
    )


def _resolved(detections: Column) -> Column:
    """Labels and best confidence of the detections that no other one contains.

    In order of start, longest first, an interval lies in an earlier one just
    if it ends no later than the furthest end so far; that end is kept per
    tier, and only tiers as strong as its own count.
    """
    start = F.struct(
        F.array(*[F.lit(-1)] * TIERS).alias("ends"),
        F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("conf"),
        F.lit(0).alias("n"),
    )

    def step(acc: Column, d: Column) -> Column:
        end = -d["neg_end"]
        reach = F.array_max(F.slice(acc["ends"], F.lit(1), d["tier"] + 1))
        free = reach < end
        return F.struct(
            F.transform(acc["ends"], lambda e, t: F.when(t == d["tier"], F.greatest(e, end)).otherwise(e)).alias("ends"),
            F.when(free, F.array_union(acc["labels"], F.array(d["label"]))).otherwise(acc["labels"]).alias("labels"),
            F.when(free, F.greatest(acc["conf"], d["conf"])).otherwise(acc["conf"]).alias("conf"),
            (acc["n"] + F.when(free, 1).otherwise(0)).alias("n"),
        )

    return F.aggregate(F.array_sort(detections), start, step)


def _places(words: Column, phrase: str) -> Column:
    """Word indexes at which the phrase's words stand consecutively."""
    parts = phrase.split()
    at = F.transform(
        words,
        lambda w, i: F.when(
            (w == parts[0]) & F.array_join(F.slice(words, i + 1, len(parts)), " ").eqNullSafe(F.lit(phrase)), i.cast("long")
        ),
    )
    return F.filter(at, lambda i: i.isNotNull())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_detections."""
    rows = docs.select(F.col(id_col).alias("doc_id"), words_joined(text_col).alias("joined"))
    gated = F.lit(False)
    for gate in GATES:
        gated = gated | F.col("joined").contains(gate)
    # one space stands before each word and one at the end
    n_words = F.char_length("joined") - F.char_length(F.replace("joined", F.lit(" "), F.lit(""))) - 1
    based = F.lit(False)
    for phrase, _ in BASE:
        based = based | F.col("joined").contains(f" {phrase} ")
    words = F.split(F.btrim("joined"), " ")
    places = [F.when(F.col("joined").contains(f" {p} "), _places(words, p)) for p, _ in BASE]
    tried = F.filter(_rule_table(), lambda r: F.contains(F.col("joined"), r["keyword"]))
    hits = F.flatten(F.transform(tried, lambda r: _hits(F.col("joined"), r)))
    found = rows.select(
        "doc_id",
        n_words.cast("long").alias("n_words"),
        F.when(based, F.flatten(F.array_compact(F.array(*places)))).alias("places"),
        F.when(based, F.array_compact(F.array(*[F.when(pl.isNotNull(), F.lit(label)) for pl, (_, label) in zip(places, BASE)]))).alias("base"),
        F.when(gated, _resolved(hits)).alias("rules"),
    )
    none = F.array().cast("array<string>")
    base = F.coalesce("base", none)
    return found.select(
        "doc_id",
        "n_words",
        F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).cast("long").alias("n_base"),
        F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("rules.labels", none))), ",").alias("labels"),
        F.greatest(F.when(F.size(base) > 0, 0.5).otherwise(0.0), F.coalesce("rules.conf", F.lit(0.0))).alias("score"),
        F.coalesce(F.col("rules.n"), F.lit(0)).cast("long").alias("n_detections"),
    )
