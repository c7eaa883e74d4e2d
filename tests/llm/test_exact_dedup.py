import hashlib
import random
import re
from collections import defaultdict

import pytest

from sylva.llm import exact_dedup

from .conftest import ODD


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def brute(rows):
    """Per digest: the id that stays, and the size."""
    groups = defaultdict(list)
    for r in rows:
        groups[hashlib.sha256(norm(r[1]).encode()).hexdigest()].append((-len(r[1] or ""), r[0] is None, r[0] or 0))
    return {d: (None if min(g)[1] else min(g)[2], len(g)) for d, g in groups.items()}


@pytest.mark.parametrize("capacity", [4, 1024])
def test_against_brute_force(make_docs, capacity):
    rng = random.Random(3)
    texts = ["hot copy"] * 40 + [rng.choice(["a b", "ab ", "a  b", "c", "", "d e f"]) for _ in range(60)] + [f"text {i}" for i in range(50)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = exact_dedup.decisions(make_docs(rows, 5), capacity=capacity).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.keep_id, r.group_size) == want[r.text_sha256]
        assert r.kept == (r.doc_id == r.keep_id)
    assert sum(r.kept for r in got) == len(want)


def test_heavy_texts_are_found_and_verified(make_docs):
    rows = [(i, "hot") for i in range(300)] + [(1000 + i, f"t{i}") for i in range(300)]
    slim = exact_dedup._slim(make_docs(rows, 6), "doc_id", "text")
    heavy = exact_dedup.winners(slim, capacity=8).collect()
    assert [(r.keep_id, r.group_size) for r in heavy] == [(0, 300)]


@pytest.mark.parametrize("capacity", [2, 1024])
def test_odd_rows(odd, capacity):
    got = exact_dedup.decisions(odd, capacity=capacity).collect()
    assert len(got) == len(ODD)
    want = brute(ODD)
    assert all((r.keep_id, r.group_size) == want[r.text_sha256] for r in got)
    assert sum(r.kept for r in got) == len(want)
    assert {r.doc_id for r in got if r.group_size == 3} == {1, 2, 3}


@pytest.mark.parametrize("capacity", [2, 1024])
def test_keep_one(odd, capacity):
    got = exact_dedup.keep_one(odd, capacity=capacity)
    assert got.columns == odd.columns
    assert sorted(norm(r.text) for r in got.collect()) == sorted({norm(r[1]) for r in ODD})


def test_empty(empty):
    assert exact_dedup.decisions(empty).collect() == []
    assert exact_dedup.keep_one(empty).collect() == []
