import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sylva.llm import token_store
from sylva.llm.common import tokenizer_path

from .conftest import ODD, SF

FILE = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def slow(library, rows):
    out, start = [], 0
    ids = [(r[0], np.array([*library.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")) for r in rows]
    for i, x in sorted(ids, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32(r[1].astype("<u2").tobytes()))):
        out.append((i, start, len(x), zlib.crc32(x.tobytes())))
        start += len(x)
    return out


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


@pytest.mark.parametrize("shard_bytes", [token_store.SHARD_BYTES, 20_000])
def test_whole_table(shared, library, shard_bytes):
    docs = shared.read.parquet(f"{SF}/documents.parquet")
    store = token_store.write(docs, FILE, shard_bytes=shard_bytes)
    assert told(store.read()) == slow(library, [(r.doc_id, r.text) for r in docs.collect()])
    again = token_store.open_store(shared, store.path)
    assert again.dictionary == store.dictionary and again.shards.count() >= (1 if shard_bytes > 1e6 else 4)


def test_word_by_word_encoding(library):
    rng = random.Random(4)
    encoder = token_store.WordEncoder.at(FILE)
    bits = ["Word", "don't", " ", "  ", "\n", "\t", " ", "́", "é", "ΑΣ", "Σ ", "😀", "123", "<|endoftext|>", "<|", "İ", "...", "\x85", "x̧́"]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        want = [*library.encode(text, add_special_tokens=False).ids, 2]
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == want, repr(text)


def test_short_document_access(shared, library):
    docs = shared.read.parquet(f"{SF}/documents.parquet")
    store = token_store.write(docs, FILE, shard_bytes=50_000)
    payload = store.shards.orderBy("part", "seq").collect()[1].payload
    shard = token_store.Shard(bytes(payload), store.dictionary)
    some = docs.where(docs.doc_id == int(shard.index["id"][3])).first()
    assert shard.find(some.doc_id).tolist() == [*library.encode(some.text, add_special_tokens=False).ids, 2]
    assert shard.find(-5) is None
    # only that document's bytes are needed
    e = shard.index[3]
    broken = bytearray(payload)
    broken[int(shard.index[4]["offset"])] ^= 0xFF
    assert (token_store.Shard(bytes(broken), store.dictionary).ids(3) == shard.ids(3)).all() and e["n"] == len(shard.ids(3))


def test_wrong_dictionary_is_refused(shared, make_docs):
    store = token_store.write(make_docs([(1, "some text")]), FILE)
    payload = bytes(store.shards.first().payload)
    with pytest.raises(ValueError):
        token_store.Shard(payload, b"another dictionary")
    with pytest.raises(ValueError):
        token_store.Shard(b"x" * len(payload), store.dictionary)
    assert hashlib.sha256(store.dictionary).digest() in payload


def test_odd_rows(odd, library):
    assert told(token_store.write(odd, FILE).read()) == slow(library, ODD)


def test_empty(empty):
    assert token_store.write(empty, FILE).read().collect() == []


def test_plain_words_equal_the_library():
    import random

    from tokenizers import Tokenizer

    rng = random.Random(9)
    letters = "abcxyzABCXYZ" + "".join(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))
    marks = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and c != 39)
    words = ["".join(rng.choices(letters, k=rng.randint(1, 12))) + "".join(rng.choices(marks, k=rng.choice([0, 0, 1, 2, 3]))) for _ in range(20_000)]
    words += [*letters, *(f"a{m}" for m in marks), "x<|", "ab<|>", "É" * 50 + "!?"]
    encoder, library = token_store.WordEncoder(FILE), Tokenizer.from_file(FILE)
    for word, want in zip(words, library.encode_batch_fast(words, add_special_tokens=False)):
        assert encoder._plain(word) == np.array(want.ids, "<u2").tobytes(), word
    for word in ("it's", "a1", "don't", "ªb", "µm", "x×y", "a b", "a\tb", "é", "İ", "<|endoftext|>"):
        assert encoder._plain(word) is None


def test_a_part_is_asked_once_for_all_its_words(library, monkeypatch):
    encoder = token_store.WordEncoder(FILE)
    asked, ask = [], encoder._part_ids
    monkeypatch.setattr(encoder, "_part_ids", lambda parts: asked.extend(parts) or ask(parts))
    texts = ["Word, word. WORD\nÉté", None, "", "été, wOrD! it's 12 words", "word"]
    for _ in range(2):  # the second time from memory
        got = encoder.encode_all(pa.array(texts))
        assert [np.frombuffer(g, "<u2").tolist() for g in got] == [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert sorted(p for p in asked if p.isalpha()) == ["word", "words", "été"]


def test_forgotten_words_and_slices(library, monkeypatch):
    rng = random.Random(11)
    bits = ["Word,", "don't", "", "\n", "\t", "Größe.", "ÑANDÚ", "x!!", "!!", "😀", "123", "<|endoftext|>", "İ", "naïve\x85", "µm", "ÿ", "<|", "</w>", "a</w>"]
    texts = [" ".join(rng.choice(bits) + rng.choice(["", rng.choice("abcÀÿ")]) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    texts[7], texts[90] = None, "long " * 900
    want = [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    monkeypatch.setattr(token_store, "PARTS_PER_CALL", 3)
    for cache, size in ((0, 300), (5, 1000), (30, 1 << 20)):
        monkeypatch.setattr(token_store, "WORD_CACHE", cache)
        monkeypatch.setattr(token_store, "TEXT_BYTES", size)
        encoder = token_store.WordEncoder(FILE)
        slices = list(token_store._slices(batch, 0))
        assert sum(s.num_rows for s in slices) == len(texts) and (len(slices) > 1 or size > 1000)
        got = [g for s in slices for g in encoder.encode_all(s.column(0))]
        assert [np.frombuffer(g, "<u2").tolist() for g in got] == want


def test_a_model_that_does_not_mark_the_ends_of_parts(library):
    encoder = token_store.WordEncoder(FILE)
    encoder.ends_part[:] = False
    text = "Größe und noch ein Wort, zwei!"
    assert np.frombuffer(encoder.encode(text), "<u2").tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]
