"""SentencePiece encoding and decoding by streaming Viterbi.

A text becomes the sequence of vocabulary pieces with the highest total score
(ties: the longer last piece). The search runs over the text once, from left to
right. Only the scores of the last ``longest piece`` boundaries can still be
extended, so only those are kept; whenever all back-pointer paths that survive
in this window meet in one boundary, the ids before it are final, are handed
out, and their back-pointers are dropped. A text of any length is encoded in
the memory of its longest undecided stretch.

Spaces are written as the mark U+2581 and one mark is put in front, as
SentencePiece does. In a vocabulary where the mark only ever begins a piece,
every space is such a meeting point, so the ids of a word do not depend on its
neighbours and are remembered. Characters without a piece, and marks that the
text itself holds, become UTF-8 byte pieces; decoding gives back exactly the
text that was encoded.

Defined results: null text is encoded as empty and has no ids; an empty table
gives an empty result; repeated rows get equal ids; other columns are not read
by ``digests`` and come back untouched from ``with_ids``, whose ``ids`` column
replaces one of that name.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylva.session import ship_package

MARK = "▁"
#: Stands for a mark of the text itself; a lone surrogate is in no text and no piece.
_OWN_MARK = "\ud800"
#: Scores under this are of pieces that the vocabulary never uses.
UNUSED = -1e8
#: A character without a piece scores this much less than the worst piece.
UNKNOWN_PENALTY = 10.0
#: Words whose ids a Python worker remembers, in each of two generations.
WORD_CACHE = 500_000


class Viterbi:
    """Streaming search. ``feed`` takes text and returns final ids; ``finish`` returns the rest."""

    def __init__(self, vocab: "Vocabulary"):
        self.v = vocab
        self.text = ""  # not yet committed
        self.done = 0  # boundaries before this one are final for the search
        self.score = [0.0]  # best score of each boundary of self.text, from the committed one
        self.back: list[tuple[int, int]] = [(0, -1)]  # (previous boundary, piece; -1: bytes)
        self.widest = 0

    def _extend(self, upto: int) -> None:
        """Relax all pieces that start before boundary ``upto``."""
        text, score, back = self.text, self.score, self.back
        size, root, unknown = len(text), self.v.tree, self.v.unknown
        missing = size + 1 - len(score)
        if missing > 0:
            score += [-np.inf] * missing
            back += [(0, -1)] * missing
        for i in range(self.done, upto):
            here, j, at, single = score[i], i, root, False
            while j < size:
                step = at.get(text[j])
                if step is None:
                    break
                j += 1
                at, gain, piece = step
                if piece >= 0:
                    single = single or j == i + 1
                    if here + gain > score[j]:
                        score[j] = here + gain
                        back[j] = (i, piece)
            if not single and here + unknown > score[i + 1]:
                score[i + 1] = here + unknown
                back[i + 1] = (i, -1)
        self.done = max(self.done, upto)

    def _ids(self, end: int) -> list[int]:
        steps = []
        while end:
            start, piece = self.back[end]
            steps.append((start, end, piece))
            end = start
        out: list[int] = []
        for start, end, piece in reversed(steps):
            out += [piece] if piece >= 0 else self.v.byte_ids(self.text[start:end])
        return out

    def _commit(self) -> list[int]:
        """Final ids up to the last boundary that every surviving path goes through."""
        # every longer path ends a piece in one of these boundaries
        reach = range(self.done, min(self.done + self.v.longest, len(self.score)))
        live = {j for j in reach if self.score[j] > -np.inf}
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(self.back[last][0])
        meet = live.pop() if live else 0
        if not meet:
            return []
        out = self._ids(meet)
        best = self.score[meet]
        self.text, self.done = self.text[meet:], self.done - meet
        self.score = [s - best for s in self.score[meet:]]
        self.back = [(0, -1)] + [(a - meet, p) for a, p in self.back[meet + 1 :]]
        return out

    def feed(self, more: str) -> list[int]:
        """Take ``more`` text; ids that no later text can change."""
        out: list[int] = []
        step = 4 * self.v.longest
        for at in range(0, len(more), step):
            self.text += more[at : at + step]
            # a piece may still grow past the end: starts within reach of it wait
            self._extend(max(self.done, len(self.text) - self.v.longest))
            self.widest = max(self.widest, len(self.text))
            out += self._commit()
        return out

    def finish(self) -> list[int]:
        self._extend(len(self.text))
        out = self._ids(len(self.text))
        self.text, self.done, self.score, self.back = "", 0, [0.0], [(0, -1)]
        return out


class Vocabulary:
    """Pieces with scores, read from a SentencePiece model file."""

    _by_path: dict[str, "Vocabulary"] = {}

    def __init__(self, pieces: list[tuple[str, float]], byte_first: int):
        """``pieces`` by id (control, byte and unused ones as the empty string)."""
        self.scores = {p: (s, i) for i, (p, s) in enumerate(pieces) if p and s > UNUSED}
        self.longest = max(map(len, self.scores), default=1)
        self.unknown = min((s for s, _ in self.scores.values()), default=0.0) - UNKNOWN_PENALTY
        if MARK not in self.scores:  # a space must have an id, if only as the last resort
            self.scores[MARK] = (self.unknown, [p for p, _ in pieces].index(MARK))
        # a tree of characters: character -> (subtree, score, id; -1 where no piece ends)
        self.tree: dict[str, tuple] = {}
        for p, (score, i) in self.scores.items():
            at = self.tree
            for c in p[:-1]:
                at = at.setdefault(c, ({}, 0.0, -1))[0]
            at[p[-1]] = (at.get(p[-1], ({},))[0], score, i)
        self.byte_first = byte_first
        self.words_apart = all(MARK not in p[1:] for p in self.scores)
        self.lines_apart = all("\n" not in p for p in self.scores)
        self.bytes_of = [p.replace(MARK, " ").encode() for p, _ in pieces]
        self.bytes_of[byte_first : byte_first + 256] = [bytes([b]) for b in range(256)]
        self.recent: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    @classmethod
    def at(cls, path: str) -> "Vocabulary":
        if path not in cls._by_path:
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            n = sp.get_piece_size()
            plain = [not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n)]
            pieces = [(sp.id_to_piece(i), sp.get_score(i)) if plain[i] else ("", 0.0) for i in range(n)]
            cls._by_path[path] = cls(pieces, sp.piece_to_id("<0x00>"))
        return cls._by_path[path]

    def byte_ids(self, text: str) -> list[int]:
        return [self.byte_first + b for b in text.replace(_OWN_MARK, MARK).encode()]

    def search(self, marked: str) -> list[int]:
        stream = Viterbi(self)
        if len(marked) <= self.longest:  # fits the window
            stream.text = marked
            return stream.finish()
        return stream.feed(marked) + stream.finish()

    def _word(self, word: str, after_space: bool) -> bytes:
        marked = (MARK if after_space else "") + (word.replace(MARK, _OWN_MARK) if MARK in word else word)
        got = self.recent.get(marked)
        if got is None:
            got = self.before.get(marked)
            if got is None:
                got = np.array(self.search(marked), "<u4").tobytes()
            if len(marked) <= 64:
                if len(self.recent) >= WORD_CACHE:
                    self.before, self.recent = self.recent, {}
                self.recent[marked] = got
        return got

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        if not (self.words_apart and self.lines_apart):
            return np.array(self.search(MARK + text.replace(MARK, _OWN_MARK).replace(" ", MARK)), "<u4")
        newline = np.array([self.byte_first + 10], "<u4").tobytes()
        out = []
        for k, line in enumerate(text.split("\n")):
            words = line.split(" ")
            if k:
                out.append(newline)
                if words[0]:
                    out.append(self._word(words[0], False))
            else:
                out.append(self._word(words[0], True))
            out += [self._word(w, True) for w in words[1:]]
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text whose ids these are."""
        table = self.bytes_of
        raw = b"".join([table[i] for i in ids.tolist()])
        return raw[1:].decode() if len(ids) else ""


def digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_crc32, n_chars, decoded_sha256, round_trip.

    The ids are unsigned 32-bit little-endian in the checksum; the decoded text
    comes from the ids alone.
    """
    ship_package(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabulary.at(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = [vocab.encode(t) for t in texts]
                back = [vocab.decode(i) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(i) for i in ids], pa.int64()),
                        pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()),
                        pa.array([len(b) for b in back], pa.int64()),
                        pa.array([hashlib.sha256(b.encode()).hexdigest() for b in back]),
                        pa.array([b == t for b, t in zip(back, texts)]),
                    ],
                    ["doc_id", "n_tokens", "ids_crc32", "n_chars", "decoded_sha256", "round_trip"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        step, f"doc_id {id_type}, n_tokens long, ids_crc32 long, n_chars long, decoded_sha256 string, round_trip boolean"
    )


def with_ids(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """The documents with their ids in the column ``ids``."""
    ship_package(docs.sparkSession)
    keep = [c for c in docs.columns if c.lower() != "ids"]
    at = keep.index(text_col)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabulary.at(model)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                ids = [vocab.encode(t or "") for t in part.column(at).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*keep, "ids"])

    rows = docs.select(*keep)
    schema = T.StructType([*rows.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(step, schema)
