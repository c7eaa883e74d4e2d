import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from sylva.llm import suffix_dedup

from .conftest import ODD, SF


def slow(rows, length):
    """(doc number -> set of removed bytes) by a table of all windows."""
    where = defaultdict(list)
    raw = [(r[1] or "").encode() for r in rows]
    for d, t in enumerate(raw):
        for i in range(len(t) - length + 1):
            key = hash(t[i : i + length]) if length > 64 else t[i : i + length]
            where[key].append((d, i))
    gone = [set() for _ in rows]
    for hits in where.values():
        if len(hits) > 1:
            for d, i in hits:
                gone[d].update(range(i, i + length))
    out = []
    for r, t, g in zip(rows, raw, gone):
        flags = [i in g for i in range(len(t))]
        runs = sum(f and not (i and flags[i - 1]) for i, f in enumerate(flags))
        kept = bytes(b for b, f in zip(t, flags) if not f)
        out.append((r[0] is None, r[0] or 0, len(t), len(g), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def told(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_whole_table(shared):
    docs = shared.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert told(suffix_dedup.dedup(docs)) == slow(rows, 200)


@pytest.mark.parametrize("hot", [50_000, 3])
def test_overlaps_periods_and_boundaries(make_docs, hot):
    rng = random.Random(hot)
    passages = ["".join(rng.choice("abc") for _ in range(n)) for n in (19, 20, 21, 33, 60)]
    rows = []
    for i in range(60):
        parts = [rng.choice([*passages, "z" * rng.randint(0, 45), "".join(rng.choice("defghé") for _ in range(rng.randint(0, 30)))]) for _ in range(rng.randint(0, 5))]
        rows.append((i, "".join(parts)))
    got = suffix_dedup.dedup(make_docs(rows, 4), length=20, gram=6, hot_limit=hot)
    assert told(got) == slow(rows, 20)


def test_segments_do_not_change_anchors(monkeypatch):
    rng = np.random.default_rng(2)
    text = rng.integers(97, 101, 5000).astype(np.uint8).tobytes() + b"q" * 700
    whole = suffix_dedup.text_anchors([text], 50, 8)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 400)
    cut = suffix_dedup.text_anchors([text], 50, 8)

    def windows(found):
        return {(p - o) for _, _, p, most, least in zip(*found) for o in range(least, most + 1)}

    assert windows(whole) == windows(cut) == set(range(len(text) - 49))


def test_suffix_sort_and_collision_verification(monkeypatch):
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 60, 190)
    begin = np.cumsum(sizes) - sizes
    data = rng.integers(0, 3, sizes.sum()).astype(np.uint8)
    start = begin + rng.integers(0, sizes)
    size = np.minimum(begin + sizes - start, 40)
    group = np.sort(rng.integers(0, 4, len(start)))
    want = sorted(range(len(start)), key=lambda i: (group[i], data[start[i] : start[i] + size[i]].tobytes(), i))
    order, common = suffix_dedup.verified_runs(data, begin, start, size, group, 40)
    assert order.tolist() == want
    # every comparison misled: the bytes decide
    monkeypatch.setattr(suffix_dedup, "common_extension", lambda sums, a, b, place_a, place_b, most: most)
    again, common_again = suffix_dedup.verified_runs(data, begin, start, size, group, 40)
    assert again.tolist() == want and (common == common_again).all()


def test_odd_rows(odd):
    rows = [(r[0], None if r[1] is None else r[1][:3000] if r[0] in (7, 8) else r[1]) for r in ODD]
    got = {r.doc_id: r for r in suffix_dedup.dedup(odd).collect() if r.doc_id}
    assert got[1].n_bytes == got[2].n_bytes == 0 and got[1].kept_sha256 == hashlib.sha256(b"").hexdigest()
    for i, size in ((7, 300_000), (8, 200_000)):  # periodic texts lose everything
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (size, size, 1)
    assert got[10].n_removed == 0 and len(rows) == suffix_dedup.dedup(odd).count()


def test_copies_lose_all_and_near_copies_their_passage(make_docs):
    rng = random.Random(9)
    body = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60))
    rows = [(1, body), (2, body), (3, "intro " + body[:250] + " outro"), (4, body[:199])]
    assert told(suffix_dedup.dedup(make_docs(rows))) == slow(rows, 200)


def test_empty(empty):
    assert suffix_dedup.dedup(empty).collect() == []


def test_lengths_beyond_the_packed_reach_are_refused(make_docs):
    with pytest.raises(ValueError, match="the length must be"):
        suffix_dedup.dedup(make_docs([(1, "a")]), length=400)
