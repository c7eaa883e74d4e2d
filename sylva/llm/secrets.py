"""Secret scans: plain patterns, and automata inferred from labelled credentials.

Base: three patterns, leftmost non-overlapping per kind. What they find are the
labelled credentials: a label is the kind whose pattern matched.

Grammar inference (the ALERGIA scheme): per label the credentials, as strings
over character classes, form a prefix tree with counts; going through the
states from the root, a state is merged with an earlier one if their stop and
transition frequencies, and those of all states behind them, agree within the
Hoeffding bound at ``ALPHA``. The merged trees are probabilistic automata.
Merging may fold all positions into one state, so an automaton keeps its
strings' lengths beside its steps: a string's likelihood is that of its steps,
given that it goes on, times that of its length. A step that a state has never
seen costs ``UNSEEN`` and leads on as the state's commonest step does, so one
wrong character does not lose the format.

Background: one more automaton, inferred from ordinary runs, and the frequent
shapes. A shape is a run's classes with repeats squeezed (an IPv4 address is
``9.9.9.9``); a shape that many different runs have is ordinary by itself, with
its share as likelihood and its characters drawn evenly from their classes.

A candidate - any run of ``MIN_RUN`` or more credential characters, in the
alphabet and from the length of the base, or what is left of one around the
base matches - is reported if, per character, its best label's likelihood
exceeds the better background by ``MARGIN``; nothing else decides.

Texts are read once: that pass writes the base spans and the candidates to the
shared checkpoint folder. Training reads a bounded sample of them (the smallest
hashes per label, whole strings of ``SAMPLE_CHARACTERS`` together); shapes are
counted over all candidates; scoring reads all candidates, a batch at a time.

Defined results: null and empty texts have no spans; long texts are scanned
whole; repeated rows get equal results; a label without examples has no
automaton and without any the base spans are all; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylva.session import ship_package

from .common import stored

#: Fixed values of the base contract.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32
# a run shorter than the bound fails wherever it is entered, so the bound can stand in the pattern
ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{ACCESS_LENGTH - 4},}}")
HEX = re.compile(rf"[0-9a-f]{{{HEX_LENGTH},}}")

#: Shortest candidate, and the runs: as the values of the assign pattern.
MIN_RUN = ASSIGN_LENGTH
#: Words that a match of the assign pattern begins with, in lower case.
LEADS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Rows turned into Python values at a time.
SLICE = 512
#: Training strings per label and their characters together, and the confidence of the merging test.
SAMPLE = 1500
SAMPLE_CHARACTERS = 1 << 20
ALPHA = 0.05
#: A shape is frequent if one in so many runs has it, in several different values; longer shapes never are.
SHAPE_SHARE, SHAPE_VALUES, SHAPE_LENGTH = 20_000, 5, 12
#: A frequent shape's length is one of so many, about.
SHAPE_SPREAD = 40
#: Nats per character by which a credential must be likelier than an ordinary run.
MARGIN = 0.5
#: Likelihood of a step that the automaton has never seen.
UNSEEN = math.log(1e-4)

#: Characters in classes; each other character of the alphabet is a class of its own.
_CLASSES = (("0123456789", "9"), ("abcdef", "a"), ("ghijklmnopqrstuvwxyz", "z"), ("ABCDEF", "A"), ("GHIJKLMNOPQRSTUVWXYZ", "Z"))
_CLASS = {c: k for chars, k in _CLASSES for c in chars}
#: Characters in each class: a class's likelihood is shared among them.
_SIZE = Counter(_CLASS.values())
_NAMES = "9azAZ+/_.=-"
_CODE = np.full(256, len(_NAMES), np.int64)  # a last code for characters outside the alphabet
for _i, _name in enumerate(_NAMES):
    _CODE[ord(_name)] = _i
for _c, _k in _CLASS.items():
    _CODE[ord(_c)] = _NAMES.index(_k)
#: Characters of the base's alphabet, by their Latin-1 code.
_RUN = _CODE < len(_NAMES)
#: Shapes as numbers: a digit per squeezed class, exact in a float up to SHAPE_LENGTH digits.
_SHAPE_BASE = len(_NAMES) + 2
_POWERS = float(_SHAPE_BASE) ** np.arange(SHAPE_LENGTH)
_SHARED = np.array([-math.log(_SIZE.get(n, 1)) for n in _NAMES] + [0.0])


def classes(text: str) -> str:
    return "".join([_CLASS.get(c, c) for c in text])


def shape(text: str) -> str:
    """The classes of a run, repeats squeezed."""
    return re.sub(r"(.)\1+", r"\1", classes(text), flags=re.DOTALL)


def _shape_number(name: str) -> float:
    return float(sum((_NAMES.find(c) % (len(_NAMES) + 1) + 1) * _SHAPE_BASE**k for k, c in enumerate(name)))


def shape_of(column: str) -> Column:
    """``shape`` as a Spark expression."""
    members, names = "".join(m for m, _ in _CLASSES), "".join(k * len(m) for m, k in _CLASSES)
    return F.regexp_replace(F.translate(column, members, names), r"(.)\1+", "$1")


# -- grammar inference --------------------------------------------------------


class Runs:
    """Strings side by side, longest first, for scoring position by position."""

    def __init__(self, texts: list[str] | pa.StringArray):
        if isinstance(texts, pa.StringArray):  # runs of the alphabet: a byte per character
            ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
            self.sizes = np.diff(ends).astype(np.int64)
        else:
            raw = [t.encode("latin-1", "replace") for t in texts]
            data = np.frombuffer(b"".join(raw), np.uint8)
            self.sizes = np.array([len(d) for d in raw], np.int64)
        self.order = np.argsort(-self.sizes, kind="stable")
        self.codes = _CODE[data]
        starts = np.cumsum(self.sizes) - self.sizes
        self.start = starts[self.order]
        self.longest_first = self.sizes[self.order]
        # how many strings still have a character at each position
        self.alive = len(self.sizes) - np.searchsorted(self.longest_first[::-1], np.arange(self.sizes.max(initial=0)), "right")

    def shared(self) -> np.ndarray:
        """Log likelihood of the characters within their classes, per string."""
        ends = np.concatenate([[0.0], np.cumsum(_SHARED[self.codes])])
        at = np.cumsum(self.sizes)
        return ends[at] - ends[at - self.sizes]

    def shapes(self) -> np.ndarray:
        """Number of each string's shape; -1 for one of more than ``SHAPE_LENGTH`` classes."""
        of = np.repeat(np.arange(len(self.sizes)), self.sizes)
        new = np.ones(len(self.codes), bool)
        new[1:] = (self.codes[1:] != self.codes[:-1]) | (of[1:] != of[:-1])
        at = np.flatnonzero(new)
        of = of[at]
        count = np.bincount(of, minlength=len(self.sizes))
        rank = np.arange(len(at)) - (np.cumsum(count) - count)[of]
        short = rank < SHAPE_LENGTH
        digits = (self.codes[at[short]] + 1) * _POWERS[rank[short]]
        return np.where(count <= SHAPE_LENGTH, np.bincount(of[short], digits, len(self.sizes)), -1.0)


@dataclass
class Automaton:
    """Per state: log probability of stopping, and of each class with the state it leads to; the strings' lengths."""

    stop: list[float]
    step: list[dict[str, tuple[float, int]]]
    lengths: Counter

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """(states, classes): log likelihood of each step given that the string goes on, and where it leads."""
        cost = np.full((len(self.step), len(_NAMES) + 1), UNSEEN)
        to = np.zeros((len(self.step), len(_NAMES) + 1), np.int64)
        for s, arcs in enumerate(self.step):
            going = sum(math.exp(p) for p, _ in arcs.values())
            # an unseen class leads on as the commonest one does
            to[s] = max(arcs.values(), default=(0.0, s))[1]
            for c, (p, t) in arcs.items():
                if c in _NAMES:
                    cost[s, _NAMES.index(c)] = max(p - math.log(going), UNSEEN)
                    to[s, _NAMES.index(c)] = t
        return cost, to

    def length(self, sizes: np.ndarray) -> np.ndarray:
        """Log likelihood of lengths: those seen, and a geometric tail for all others."""
        n = sum(self.lengths.values())
        mean = sum(k * v for k, v in self.lengths.items()) / n
        sizes, place = np.unique(sizes, return_inverse=True)
        tail = math.log(0.05) - np.log(mean + 1) + sizes * math.log(mean / (mean + 1)) if mean else np.full(len(sizes), UNSEEN)
        seen = np.array([self.lengths.get(int(k), 0) for k in sizes]) / n
        return np.logaddexp(np.log(0.95 * seen + 1e-300), tail)[place]

    def score(self, runs: Runs) -> np.ndarray:
        """Mean log likelihood per character (with the length) of each string."""
        cost, to = self.tables()
        state = np.zeros(len(runs.order), np.int64)
        total = np.zeros(len(runs.order))
        for at, n in enumerate(runs.alive):
            code = runs.codes[runs.start[:n] + at]
            total[:n] += cost[state[:n], code]
            state[:n] = to[state[:n], code]
        out = np.empty(len(total))
        out[runs.order] = total
        return (out + runs.shared() + self.length(runs.sizes)) / (runs.sizes + 1)

    def per_character(self, text: str) -> float:
        return float(self.score(Runs([text]))[0])


@dataclass
class Scorer:
    """Automata of the labels, and the background: an automaton of ordinary runs and the frequent shapes."""

    labels: list[Automaton]
    ordinary: Automaton | None
    shapes: dict[str, float]  # log share of all runs

    def background(self, runs: Runs) -> np.ndarray:
        number = sorted((_shape_number(name), share) for name, share in self.shapes.items())
        numbers, shares = np.array([*[n for n, _ in number], np.inf]), np.array([*[s for _, s in number], -np.inf])
        mine = runs.shapes()
        at = np.searchsorted(numbers, mine)
        share = np.where((numbers[at] == mine) & (runs.sizes <= 255), shares[at], -np.inf)
        by_shape = (share - math.log(SHAPE_SPREAD) + runs.shared()) / (runs.sizes + 1)
        return np.maximum(by_shape, self.ordinary.score(runs))

    def secrets(self, texts: list[str] | pa.StringArray, margin: float = MARGIN) -> np.ndarray:
        """Which runs are likelier as a credential than as an ordinary run."""
        if not len(texts) or not self.labels or self.ordinary is None:
            return np.zeros(len(texts), bool)
        runs = Runs(texts)
        best = np.maximum.reduce([a.score(runs) for a in self.labels])
        return best - self.background(runs) >= margin


def infer(strings: list[str], alpha: float = ALPHA) -> Automaton:
    """Merge the prefix tree of ``strings`` into a probabilistic automaton."""
    ends: list[int] = [0]
    seen: list[int] = [0]  # visits: stops and steps on
    arcs: list[dict[str, list[int]]] = [{}]  # class -> [state, count]
    for text, n in sorted(Counter(map(classes, strings)).items()):
        s = 0
        seen[0] += n
        for c in text:
            if c not in arcs[s]:
                arcs[s][c] = [len(ends), 0]
                ends.append(0)
                seen.append(0)
                arcs.append({})
            arcs[s][c][1] += n
            s = arcs[s][c][0]
            seen[s] += n
        ends[s] += n
    bound = math.sqrt(0.5 * math.log(2 / alpha))
    none = (-1, 0)

    def differ(f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > bound * (n1**-0.5 + n2**-0.5)

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            if differ(ends[x], seen[x], ends[y], seen[y]):
                return False
            for c in arcs[x].keys() | arcs[y].keys():
                (i, f), (j, g) = arcs[x].get(c, none), arcs[y].get(c, none)
                if differ(f, seen[x], g, seen[y]):
                    return False
                if i >= 0 and j >= 0:
                    todo.append((i, j))
        return True

    def fold(a: int, b: int) -> None:
        """Add the tree under ``b`` to the states from ``a`` on."""
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            ends[x] += ends[y]
            seen[x] += seen[y]
            for c, (j, n) in arcs[y].items():
                if c in arcs[x]:
                    arcs[x][c][1] += n
                    todo.append((arcs[x][c][0], j))
                else:
                    arcs[x][c] = [j, n]

    red = [0]
    while True:
        border = [(r, c) for r in red for c in sorted(arcs[r]) if arcs[r][c][0] not in red]
        if not border or not seen[0]:
            break
        # the most visited state has the most evidence: decide it first
        parent, c = max(border, key=lambda rc: arcs[rc[0]][rc[1]][1])
        blue = arcs[parent][c][0]
        target = next((r for r in red if compatible(r, blue)), None)
        if target is None:
            red.append(blue)
        else:
            arcs[parent][c][0] = target
            fold(target, blue)
    number = {s: k for k, s in enumerate(red)}
    return Automaton(
        [math.log(ends[s] / seen[s]) if ends[s] else UNSEEN for s in red],
        [{c: (math.log(n / seen[s]), number[t]) for c, (t, n) in arcs[s].items()} for s in red],
        Counter(map(len, strings)),
    )


# -- scanning -----------------------------------------------------------------


def _assigns(text: str) -> Iterator[re.Match]:
    """Matches of the assign pattern, tried only where one of its words stands."""
    low = text.lower()
    if len(low) != len(text):  # a letter that is two in lower case: places differ
        yield from ASSIGN.finditer(text)
        return
    places = []
    for lead in LEADS:
        at = low.find(lead)
        while at >= 0:
            places.append(at)
            at = low.find(lead, at + 1)
    reach = 0
    for at in sorted(places):
        if at >= reach and (m := ASSIGN.match(text, at)):
            yield m
            reach = m.end()


def _edges(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each stretch of true values."""
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2]


def _laid_out(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts as one byte per code point, a blank after each; where each begins; which bytes are of the alphabet."""
    data = np.frombuffer(" ".join([*texts, ""]).encode("latin-1", "replace"), np.uint8)
    return data, np.cumsum([0, *[len(t) + 1 for t in texts]]), _RUN[data]


def _base(texts: list[str], begin: np.ndarray, inside: np.ndarray) -> list[list[tuple[int, int, int, str]]]:
    """(start, kind, end, credential) of the base matches of each text, in order."""
    out = []
    for t in texts:
        out.append([(m.start(), 0, m.end(), m[2]) for m in _assigns(t) if len(m[2]) >= ASSIGN_LENGTH])
        out[-1] += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(t)]
    start, end = _edges(inside)
    long = end - start >= HEX_LENGTH  # a hex match lies within one run
    for a, b in zip(start[long].tolist(), end[long].tolist()):
        k = int(np.searchsorted(begin, a, "right")) - 1
        at = int(begin[k])
        out[k] += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(texts[k], a - at, b - at)]
    return [sorted(spans) for spans in out]


def _others(begin: np.ndarray, inside: np.ndarray, base: list[list[tuple[int, int, int, str]]]):
    """What the base spans leave of the runs, in pieces of ``MIN_RUN`` or more: text, start and end of each, and their bytes' places."""
    inside = inside.copy()
    for at, spans in zip(begin.tolist(), base):
        for a, _, b, _ in spans:
            inside[at + a : at + b] = False
    start, end = _edges(inside)
    long = end - start >= MIN_RUN
    start, end = start[long], end[long]
    step = np.zeros(len(inside) + 1, np.int8)
    step[start] = 1
    step[end] = -1
    text = np.searchsorted(begin, start, "right") - 1
    return text, start - begin[text], end - begin[text], np.cumsum(step[:-1], dtype=np.int8).view(bool)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``_base`` of one text."""
    _, begin, inside = _laid_out([text])
    return _base([text], begin, inside)[0]


def other_runs(text: str, spans: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """``_others`` of one text."""
    _, begin, inside = _laid_out([text])
    _, start, end, _ = _others(begin, inside, [spans])
    return [(a, b, text[a:b]) for a, b in zip(start.tolist(), end.tolist())]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


_BASE = "array<struct<start:int,end:int,kind:int,value:string>>"
_OTHER = "array<struct<start:int,end:int,value:string>>"


def read_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The one pass over the texts: doc_id, the base spans as ``base`` and the other runs as ``runs``."""
    ship_package(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("value", pa.string())]))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            data, begin, inside = _laid_out(texts)
            base = _base(texts, begin, inside)
            doc, start, end, kept = _others(begin, inside, base)
            rows = [[{"start": a, "end": b, "kind": k, "value": v} for a, k, b, v in some] for some in base]
            value = pa.StringArray.from_buffers(
                len(start), pa.py_buffer(np.append(0, np.cumsum(end - start)).astype(np.int32)), pa.py_buffer(data[kept])
            )
            flat = pa.StructArray.from_arrays([pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), value], ["start", "end", "value"])
            ends = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            runs = pa.ListArray.from_arrays(pa.array(ends), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind), runs], ["doc_id", "base", "runs"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(step, f"doc_id {id_type}, base {_BASE}, runs {_OTHER}")


def _values(found: DataFrame, kind: int) -> DataFrame:
    """The credentials of a kind, or (kind 3) the other runs."""
    if kind == len(KINDS):
        return found.select(F.explode("runs.value").alias("value"))
    return found.select(F.explode("base").alias("s")).where(F.col("s.kind") == kind).select("s.value")


def _sample(mine: DataFrame, sample: int) -> list[str]:
    """Different strings with the smallest hashes; whole ones, up to ``SAMPLE_CHARACTERS`` together.

    The number of different strings tells which hashes may be among the
    smallest (with room to spare), so only about ``2 * sample`` rows are moved.
    """
    h = F.xxhash64("value")
    about = mine.agg(F.approx_count_distinct("value", 0.02)).first()[0]
    if about > 2 * sample:
        mine = mine.where(h < F.lit(int(-(1 << 63) + (1 << 64) * 2 * sample / about)))
    some = mine.where(F.length("value") <= SAMPLE_CHARACTERS).select("value").distinct().orderBy(h, "value").limit(sample)
    out, held = [], 0
    for r in some.collect():
        if held + len(r.value) <= SAMPLE_CHARACTERS:
            out.append(r.value)
            held += len(r.value)
    return out


def frequent_shapes(ordinary: DataFrame) -> dict[str, float]:
    """Shapes of one in ``SHAPE_SHARE`` ordinary runs and ``SHAPE_VALUES`` different values at least: log share.

    At most ``SHAPE_SHARE`` of them. Values are told apart by 63 hash buckets.
    """
    n = ordinary.count()
    bucket = F.expr("shiftleft(1L, cast(pmod(xxhash64(value), 63) as int))")
    counted = (
        ordinary.select(F.when(F.length("value") <= 255, shape_of("value")).alias("shape"), bucket.alias("bucket"))
        .where(F.length("shape") <= SHAPE_LENGTH)
        .groupBy("shape")
        .agg(F.count(F.lit(1)).alias("n"), F.bit_or("bucket").alias("buckets"))
        .where((F.bit_count("buckets") >= SHAPE_VALUES) & (F.col("n") * SHAPE_SHARE >= n))
    )
    return {r["shape"]: math.log(r["n"] / n) for r in counted.collect()}


def train(found: DataFrame, sample: int = SAMPLE) -> Scorer:
    """An automaton per label that has examples, from at most ``sample`` strings each, and the background."""
    strings = [_sample(_values(found, kind), sample) for kind in range(len(KINDS) + 1)]
    automata = [infer(some) if some else None for some in strings]
    return Scorer([a for a in automata[:-1] if a], automata[-1], frequent_shapes(_values(found, len(KINDS))))


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{(*KINDS, 'inferred')[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_inferred."""
    found = stored(read_texts(docs, id_col, text_col), "secret-spans")
    scorer = found.sparkSession.sparkContext.broadcast(train(found))  # bounded by the sample and SHAPE_SHARE
    id_type = docs.schema[id_col].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            runs = batch.column(2)
            ends = runs.offsets.to_numpy() - runs.offsets[0].as_py()
            flat = runs.flatten()
            # each different candidate of the batch is scored once
            coded = flat.field("value").dictionary_encode()
            good = scorer.value.secrets(coded.dictionary, margin)[coded.indices.to_numpy()]
            counts = np.zeros((len(KINDS), batch.num_rows), np.int64)
            shas, lines = [none] * batch.num_rows, [""] * batch.num_rows
            added = np.diff(np.append(0, np.cumsum(good))[ends])
            base_sizes = np.diff(batch.column(1).offsets.to_numpy())
            for k in np.flatnonzero(base_sizes + added).tolist():
                spans = [(s["start"], s["kind"], s["end"]) for s in batch.column(1)[k].as_py()]
                for _, kind, _ in spans:
                    counts[kind, k] += 1
                shas[k] = hashlib.sha256(_listed(spans).encode()).hexdigest()
                for i in (ends[k] + np.flatnonzero(good[ends[k] : ends[k + 1]])).tolist():
                    spans.append((flat.field("start")[i].as_py(), len(KINDS), flat.field("end")[i].as_py()))
                lines[k] = _listed(sorted(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, counts), pa.array(shas), pa.array(lines), pa.array(added, pa.int64())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_inferred"],
            )

    return found.mapInArrow(
        step, f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_inferred long"
    )
