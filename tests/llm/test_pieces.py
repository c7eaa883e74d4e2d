import hashlib
import random
import zlib

import numpy as np
import pytest

from sylva.llm import pieces
from sylva.llm.common import tokenizer_path

from .conftest import ODD, SF

MODEL = tokenizer_path("piece_bpe_32k.model")


def slow_encode(v, text):
    """Whole-text Viterbi over all pieces, without streaming, words or a cache."""
    if not text:
        return []
    own = pieces._OWN_MARK
    s = pieces.MARK + text.replace(pieces.MARK, own).replace(" ", pieces.MARK)
    best = [(0.0, 0, -1)] + [(-np.inf, 0, -1)] * len(s)
    for j in range(1, len(s) + 1):
        for i in range(max(0, j - v.longest), j):
            if s[i:j] in v.scores:
                score, piece = v.scores[s[i:j]]
                if best[i][0] + score > best[j][0]:
                    best[j] = (best[i][0] + score, i, piece)
        if s[j - 1] not in v.scores and best[j - 1][0] + v.unknown > best[j][0]:
            best[j] = (best[j - 1][0] + v.unknown, j - 1, -1)
    out, j = [], len(s)
    while j:
        _, i, piece = best[j]
        out = ([piece] if piece >= 0 else [v.byte_first + b for b in s[i:j].replace(own, pieces.MARK).encode()]) + out
        j = i
    return out


@pytest.fixture(scope="module")
def vocab():
    return pieces.Vocabulary.at(MODEL)


def toy():
    marks = [pieces.MARK + w for w in ("ab", "a", "abc")]
    names = ["", pieces.MARK, *marks, "a", "b", "c", "ab", "bc", "abca", "ca", "cab", "bcabc", " x"]
    rng = random.Random(2)
    return pieces.Vocabulary([(n, -rng.randint(1, 9)) for n in names] + [("", 0.0)] * 256, len(names))


def test_against_plain_search(vocab):
    rng = random.Random(1)
    for _ in range(150):
        text = "".join(rng.choice(["the ", "ing", "\n", "  ", "é", "😀", "▁", "z", "tion", "123", "\t", "Word"]) for _ in range(rng.randint(0, 25)))
        assert vocab.encode(text).tolist() == slow_encode(vocab, text)
        assert vocab.decode(vocab.encode(text)) == text


def test_streaming_commits_early_and_agrees():
    v = toy()
    rng = random.Random(7)
    for _ in range(100):
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 300)))
        stream = pieces.Viterbi(v)
        got = []
        while text and len(got) >= 0:
            marked = pieces.MARK + text
            cuts = sorted(rng.sample(range(len(marked) + 1), min(3, len(marked))))
            for a, b in zip([0, *cuts], [*cuts, len(marked)]):
                got += stream.feed(marked[a:b])
            got += stream.finish()
            break
        assert got == slow_encode(v, text)
        assert stream.widest <= 150  # the window stays short however long the text is


def test_long_unspaced_text_is_streamed(vocab):
    stream = pieces.Viterbi(vocab)
    text = "abcdefgh" * 5000
    early = stream.feed(text)
    assert stream.widest < 300 and len(early) > 1000
    assert vocab.decode(np.array([28705] + early + stream.finish(), "<u4")) == text


def test_unigram_library_agrees_on_the_score(vocab):
    from tokenizers import Tokenizer, models

    names = sorted(vocab.scores, key=lambda p: vocab.scores[p][1])
    lib = Tokenizer(models.Unigram([(n, vocab.scores[n][0]) for n in names] + [("<unk>", vocab.unknown)], unk_id=len(names)))
    score = {vocab.scores[n][1]: vocab.scores[n][0] for n in names}
    for word in ("thinking", "erthoution", "Zukunft", "averyveryverylongwordwithoutspaces"):
        marked = pieces.MARK + word
        ours = sum(score[i] for i in vocab.search(marked))
        theirs = sum(vocab.scores[t][0] for t in lib.encode(marked).tokens)
        assert ours == theirs


def test_digests_of_the_whole_table(shared, vocab):
    docs = shared.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = pieces.digests(docs, MODEL).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.round_trip and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    for r in got[:25]:
        ids = np.array(slow_encode(vocab, texts[r.doc_id][:20_000]), "<u4")
        if len(texts[r.doc_id]) <= 20_000:
            assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


def test_odd_rows(odd, vocab):
    got = pieces.digests(odd, MODEL).collect()
    assert len(got) == len(ODD) and all(r.round_trip for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2)} == {0}
    wide = pieces.with_ids(odd, MODEL)
    assert sorted(wide.columns) == sorted(odd.columns)
    by_text = {r.text: r.ids for r in wide.collect()}
    assert by_text[None] == [] and by_text["tie of two  texts"] == slow_encode(vocab, "tie of two  texts")


def test_empty(empty):
    assert pieces.digests(empty, MODEL).collect() == []
    assert pieces.with_ids(empty, MODEL).collect() == []
