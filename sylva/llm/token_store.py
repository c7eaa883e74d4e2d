"""Token ids in binary shards with a shared zstandard dictionary.

A dictionary is trained on the serialised id arrays of a bounded sample of
documents. Each document is then compressed by itself with that dictionary, so
one document can be read without its neighbours. A shard holds

* a header: magic, format version, bytes per id, number of documents, SHA-256
  of the dictionary,
* the compressed documents back to back,
* the index, per document: id present, id, offset, length, number of ids,
* a footer: place of the index, magic.

Shards are cut in ascending document order from range partitions and written,
one row per shard, as a Parquet table next to the dictionary in the shared
checkpoint folder, so the write commits atomically and survives lost executors.

Defined results: null text is encoded as empty (just the end id); null ids come
first; rows with equal ids are ordered by their checksum; very long documents
are one entry like any other; an empty table gives no shards and an empty
result; other columns are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylva.session import checkpoint_dir, ship_package

from .common import stored

END_ID = 2
#: The dictionary: its size, and the bound of its training sample.
DICTIONARY_BYTES = 64 * 1024
SAMPLE_DOCUMENTS = 1000
#: Of a chosen document's whole id array, so many pieces of so many bytes, evenly spread, are trained on.
SAMPLE_PIECES, PIECE_BYTES = 8, 4096
SHARD_BYTES = 8 << 20
#: Shards that one task of the write cuts, about.
SHARDS_PER_TASK = 2
#: zstandard level: with a trained dictionary on short arrays higher ones gain little.
LEVEL = 1
#: Words and parts of words whose ids a Python worker remembers.
WORD_CACHE = 300_000
#: Parts that one call of the model encodes, and bytes of text that are encoded together.
PARTS_PER_CALL = 20_000
TEXT_BYTES = 8 << 20

MAGIC = b"SYTOKENS"
_HEADER = struct.Struct("<8sHHI32s")
_FOOTER = struct.Struct("<Q8s")
_ENTRY = np.dtype([("has_id", "u1"), ("id", "<i8"), ("offset", "<u8"), ("length", "<u4"), ("n", "<u4")])


# -- encoding -----------------------------------------------------------------

#: Letters of Latin-1, then ASCII marks but the apostrophe.
_PLAIN = "\\A(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-&(-/:-@\\[-`{-~]*)\\z"
_LETTERS = "\\A[A-Za-zÀ-ÖØ-öø-ÿ]+\\z"
#: Byte-level tokenizers write a byte that is no visible Latin-1 character as chr(256 + its rank among those).
#: Blanks are left alone here: they stand between parts.
_SEEN = {32, *range(33, 127), *range(161, 173), *range(174, 256)}
_STAND_IN = "".join(chr(b) if b in _SEEN else chr(256 + b - sum(33 <= v < b for v in _SEEN)) for b in range(256))


def _binary(data: bytes | np.ndarray, offsets: np.ndarray) -> pa.LargeBinaryArray:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype("<i8")), pa.py_buffer(data)])


class WordEncoder:
    """Whole-text encoding word by word, each different word once.

    The tokenizer never joins characters across a blank or a line feed, so a
    text's ids are its words' ids one after another. A plain word, Latin-1
    letters with any ASCII marks behind them (no apostrophe), is two parts:
    normalising only lower-cases it (its letters are composed already) and
    splitting only parts the marks from it, so the model is asked for its parts.
    Other words are encoded by the whole tokenizer.
    """

    _by_path: dict[str, "WordEncoder"] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.end = np.array([END_ID], self.kind).tobytes()
        # the same model over parts with blanks between, and which ids end a part
        self.parts = Tokenizer(self.tokenizer.model)
        self.parts.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends_part = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.ends_part[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        # parts and words whose ids are remembered, the last used first
        self.known = pa.array([], pa.string())
        self.known_ids = pa.array([], pa.large_binary())

    @classmethod
    def at(cls, path: str) -> "WordEncoder":
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def _packed(self, encodings) -> pa.LargeBinaryArray:
        ids = [e.ids for e in encodings]
        offsets = np.cumsum([0, *map(len, ids)]) * self.width
        return _binary(np.fromiter((i for x in ids for i in x), self.kind).tobytes(), offsets)

    def _part_ids(self, parts: list[str]) -> pa.LargeBinaryArray:
        """Ids of parts of plain words, all from one call of the model.

        Bytes stand for themselves or for the tokenizer's stand-ins of
        ``_STAND_IN``. The last id of a part, and no other, ends with the
        model's suffix; a model that does not tell the parts so is asked part
        by part.
        """
        text = " ".join(parts)
        if not text.isascii():
            text = codecs.charmap_decode(text.encode(), "strict", _STAND_IN)[0]
        ids = np.array(self.parts.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
        ends = np.flatnonzero(self.ends_part[ids]) + 1
        if len(ends) != len(parts):
            return self._packed(self.parts.encode_batch_fast(text.split(" "), add_special_tokens=False))
        return _binary(ids.astype(self.kind).tobytes(), np.concatenate([[0], ends]) * self.width)

    def _new(self, units: pa.StringArray) -> pa.LargeBinaryArray:
        """Ids of different parts and words that are not remembered."""
        plain = pc.match_substring_regex(units, _LETTERS)
        order = pc.array_sort_indices(plain)  # other words first
        units, others = units.take(order), len(units) - (pc.sum(plain).as_py() or 0)
        got = [self._packed(self.tokenizer.encode_batch_fast(units.slice(0, others).to_pylist(), add_special_tokens=False))]
        for at in range(others, len(units), PARTS_PER_CALL):
            got.append(self._part_ids(units.slice(at, PARTS_PER_CALL).to_pylist()))
        return pa.concat_arrays(got).take(pc.array_sort_indices(order))

    def _unit_ids(self, units: pa.StringArray) -> pa.LargeBinaryArray:
        """Ids of different parts and words; those used least recently are forgotten."""
        place = pc.index_in(units, self.known)
        missing = units.filter(place.is_null())
        ids = self.known_ids
        if len(missing):
            fresh = pc.cumulative_sum(place.is_null().cast(pa.int64()))  # from 1
            place = pc.coalesce(place.cast(pa.int64()), pc.add(fresh, len(ids) - 1))
            ids = pa.concat_arrays([ids, self._new(missing)])
        ids = ids.take(place)
        unused = pc.invert(pc.is_in(self.known, units))
        self.known, self.known_ids = (
            pa.concat_arrays([new, old.filter(unused).slice(0, max(0, WORD_CACHE - len(new)))])
            for new, old in ((units, self.known), (ids, self.known_ids))
        )
        return ids

    def _word_ids(self, words: pa.StringArray) -> pa.LargeBinaryArray:
        """Ids of different words."""
        split = pc.extract_regex(words, _PLAIN)
        letters, marks = pc.struct_field(split, "letters"), pc.struct_field(split, "marks")
        units = pc.coalesce(pc.utf8_lower(letters), words).dictionary_encode()
        marks = marks.fill_null("").dictionary_encode()
        ids = self._unit_ids(units.dictionary).take(units.indices)
        behind = [m if not m else self._part_ids([m])[0].as_py() for m in marks.dictionary.to_pylist()]
        behind = pa.array([m or b"" for m in behind], pa.large_binary()).take(marks.indices)
        return pc.binary_join_element_wise(ids, behind, pa.scalar(b"", pa.large_binary()))

    def _plain(self, word: str) -> bytes | None:
        """Ids of one plain word, None for other words."""
        split = pc.extract_regex(pa.scalar(word), _PLAIN).as_py()
        if split is None:
            return None
        return b"".join(self._part_ids([part])[0].as_py() for part in (split["letters"].lower(), split["marks"]) if part)

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text (null: empty), the end id behind them."""
        if not len(texts):
            return []
        split = pc.split_pattern(pc.replace_substring(texts.cast(pa.string()).fill_null(""), "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        ids = self._word_ids(words.dictionary).take(words.indices)
        places = np.frombuffer(ids.buffers()[1], "<i8")[split.offsets.to_numpy()].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        return [b"".join((data[a:b], self.end)) for a, b in zip(places, places[1:])]

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0]


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``TEXT_BYTES`` of that column; a longer text is one by itself."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(ends // TEXT_BYTES)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


# -- shards -------------------------------------------------------------------


def pack(dictionary_hash: bytes, width: int, ids: list[int | None], counts: list[int], frames: list[bytes]) -> bytes:
    entries = np.zeros(len(frames), _ENTRY)
    entries["has_id"] = [i is not None for i in ids]
    entries["id"] = [i or 0 for i in ids]
    entries["length"] = [len(f) for f in frames]
    entries["n"] = counts
    entries["offset"] = _HEADER.size + np.cumsum(entries["length"], dtype=np.uint64) - entries["length"]
    body = b"".join(frames)
    head = _HEADER.pack(MAGIC, 1, width, len(frames), dictionary_hash)
    return head + body + entries.tobytes() + _FOOTER.pack(len(head) + len(body), MAGIC)


@dataclass
class Shard:
    """Reader of one shard. ``ids(k)`` decompresses only document ``k``."""

    data: bytes
    dictionary: bytes

    def __post_init__(self):
        import zstandard

        magic, version, self.width, n, want = _HEADER.unpack_from(self.data)
        place, tail = _FOOTER.unpack_from(self.data, len(self.data) - _FOOTER.size)
        if magic != MAGIC or tail != MAGIC or version != 1:
            raise ValueError("not a token shard")
        if hashlib.sha256(self.dictionary).digest() != want:
            raise ValueError("the shard was written with another dictionary")
        self.index = np.frombuffer(self.data, _ENTRY, n, place)
        self._zstd = zstandard.ZstdDecompressor(dict_data=dictionary_of(self.dictionary))

    def ids(self, k: int) -> np.ndarray:
        e = self.index[k]
        frame = self.data[int(e["offset"]) : int(e["offset"]) + int(e["length"])]
        return np.frombuffer(self._zstd.decompress(frame), f"<u{self.width}").astype("<u4")

    def find(self, doc_id: int) -> np.ndarray | None:
        """The ids of a document by binary search in the index."""
        known = self.index["id"][self.index["has_id"] == 1]
        k = int(np.searchsorted(known, doc_id))
        if k == len(known) or known[k] != doc_id:
            return None
        return self.ids(len(self.index) - len(known) + k)


def dictionary_of(data: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(data)


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary; plain sample content where there is too little to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size] or b"\0" * 8


@dataclass
class TokenStore:
    """A written store: its folder, its dictionary and the shard table."""

    path: str
    dictionary: bytes
    shards: DataFrame

    def read(self) -> DataFrame:
        """One row per document, from the shards: doc_id, start, n_tokens, ids_crc32."""
        dictionary = self.dictionary

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, seq, payload in zip(*[batch.column(k) for k in range(3)]):
                    shard = Shard(payload.as_py(), dictionary)
                    crcs, counts = [], []
                    for k in range(len(shard.index)):
                        ids = shard.ids(k)
                        crcs.append(zlib.crc32(ids.tobytes()))
                        counts.append(len(ids))
                    counts = np.array(counts, np.int64)
                    n = len(counts)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, part.as_py(), np.int32)),
                            pa.array(np.full(n, seq.as_py(), np.int32)),
                            pa.array(shard.index["id"].astype(np.int64), mask=shard.index["has_id"] == 0),
                            pa.array(np.cumsum(counts) - counts),
                            pa.array(counts),
                            pa.array(np.array(crcs, np.int64)),
                        ],
                        ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"],
                    )

        documents = self.shards.select("part", "seq", "payload").mapInArrow(
            step, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long"
        )
        # ids before each range partition, then before each shard in it
        sums = self.shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
        before = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
        within = Window.partitionBy("part").orderBy("seq")
        base = self.shards.select("part", "seq", (F.sum("n_tokens").over(within) - F.col("n_tokens")).alias("inner"))
        base = base.join(before, "part").select("part", "seq", (F.col("before") + F.col("inner")).alias("base"))
        return documents.join(base, ["part", "seq"]).select(
            "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
        )


def pieces_of(ids: bytes, width: int) -> list[bytes]:
    """Up to ``SAMPLE_PIECES`` pieces of an id array, from places spread over all of it."""
    if len(ids) <= SAMPLE_PIECES * PIECE_BYTES:
        return [ids]
    last = (len(ids) - PIECE_BYTES) // width
    return [ids[at * width : at * width + PIECE_BYTES] for at in (k * last // (SAMPLE_PIECES - 1) for k in range(SAMPLE_PIECES))]


def _dictionary(docs: DataFrame, id_col: str, text_col: str, tokenizer: str) -> bytes:
    """Train on the documents with the smallest hashes of their ids.

    The hashes are chosen first, so only the chosen texts are moved; they are
    encoded whole where they lie, and one task trains on their pieces.
    """
    h = F.xxhash64(id_col)
    highest = docs.select(h.alias("h")).orderBy("h").limit(SAMPLE_DOCUMENTS).agg(F.max("h")).first()[0]
    chosen = (
        docs.where(h <= F.lit(highest if highest is not None else 0))
        .select(F.col(text_col).cast("string").alias("text"), h.alias("h"))
        .orderBy("h", F.xxhash64("text"))  # repeated ids share a hash
        .limit(SAMPLE_DOCUMENTS)
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.at(tokenizer)
        for b in batches:
            for part in _slices(b, 0):
                for raw in encoder.encode_all(part.column(0)):
                    yield pa.RecordBatch.from_arrays([pa.array(pieces_of(raw, encoder.width), pa.binary())], ["piece"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = [piece for b in batches for piece in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([train_dictionary(samples)])], ["dictionary"])

    pieces = chosen.select("text").mapInArrow(encode, "piece binary")
    return bytes(pieces.coalesce(1).mapInArrow(train, "dictionary binary").first()[0])


def write(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, path: str | None = None) -> TokenStore:
    """Encode, compress and write every document; returns the store read back from its files."""
    spark = docs.sparkSession
    ship_package(spark)
    dictionary = _dictionary(docs, id_col, text_col, tokenizer)
    digest = hashlib.sha256(dictionary).digest()

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder = WordEncoder.at(tokenizer)
        zstd = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary_of(dictionary))
        for batch in batches:
            for part in _slices(batch, 1):
                raw = encoder.encode_all(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(r) // encoder.width for r in raw], pa.int64()),
                        pa.array([zlib.crc32(r) for r in raw], pa.int64()),
                        pa.array([zstd.compress(r) for r in raw], pa.binary()),
                    ],
                    ["doc_id", "n", "crc", "frame"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    frames = stored(rows.mapInArrow(compress, "doc_id long, n long, crc long, frame binary"), "token-frames")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = WordEncoder.at(tokenizer).width
        number = TaskContext.get().partitionId()
        seq, ids, counts, held, size = 0, [], [], [], 0

        def shard():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int32()),
                    pa.array([seq], pa.int32()),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([sum(counts)], pa.int64()),
                    pa.array([pack(digest, width, ids, counts, held)], pa.binary()),
                ],
                ["part", "seq", "n_docs", "n_tokens", "payload"],
            )

        for batch in batches:
            for i, n, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                ids.append(i)
                counts.append(n)
                held.append(f)
                size += len(f) + _ENTRY.itemsize
                if size >= shard_bytes:
                    yield shard()
                    seq, ids, counts, held, size = seq + 1, [], [], [], 0
        if ids:
            yield shard()

    total = frames.agg(F.sum(F.octet_length("frame"))).first()[0] or 0
    parts = max(1, -(-total // (SHARDS_PER_TASK * shard_bytes)))
    ordered = frames.repartitionByRange(parts, "doc_id", "crc").sortWithinPartitions("doc_id", "crc")
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/token-store-{uuid.uuid4().hex}"
    ordered.mapInArrow(cut, "part int, seq int, n_docs long, n_tokens long, payload binary").write.parquet(f"{path}/shards")
    spark.createDataFrame([(digest.hex(), bytearray(dictionary))], "sha256 string, dictionary binary").write.parquet(f"{path}/dictionary")
    return open_store(docs.sparkSession, path)


def open_store(spark, path: str) -> TokenStore:
    schema = "part int, seq int, n_docs long, n_tokens long, payload binary"
    sha, dictionary = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(dictionary).hexdigest() != sha:
        raise ValueError("the dictionary is damaged")
    return TokenStore(path, bytes(dictionary), spark.read.schema(schema).parquet(f"{path}/shards"))
