import random
import re

import numpy as np
import pytest
import xxhash

from sylva.llm import simhash

from .conftest import ODD, SF


def slow_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    votes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes))


def slow_components(prints, max_bits=3):
    root = {f: f for f in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= max_bits:
                root[find(a)] = find(b)
    return {f: find(f) for f in prints}


def check(rows, got):
    prints = {(r[0], r[1]): slow_fingerprint(r[1]) for r in rows}
    comp = slow_components(set(prints.values()))
    lowest = {}
    for (i, _), f in prints.items():
        if i is not None:
            lowest[comp[f]] = min(i, lowest.get(comp[f], i))
    want = sorted((r[0] is None, r[0] or 0, f"{prints[r[0], r[1]]:016x}", str(lowest.get(comp[prints[r[0], r[1]]]))) for r in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, str(r.component_id)) for r in got) == want


@pytest.mark.parametrize("limit", [4096, 3])
def test_whole_table(shared, limit):
    docs = shared.read.parquet(f"{SF}/documents.parquet")
    check([(r.doc_id, r.text) for r in docs.collect()], simhash.components(docs, cell_limit=limit).collect())


@pytest.mark.parametrize("limit", [4096, 4])
def test_dense_clusters_and_chains(shared, limit):
    rng = random.Random(5)
    prints = set()
    for _ in range(6):  # chains and balls, and noise around them
        x = rng.getrandbits(64)
        for _ in range(60):
            prints.add(x)
            y = x
            for b in rng.sample(range(64), rng.randint(1, 4)):
                y ^= 1 << b
            prints.add(y)
            x = y if rng.random() < 0.4 else x
    prints |= {rng.getrandbits(64) for _ in range(200)} | {0, 1, 3, 2**64 - 1}
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    fps = shared.createDataFrame(signed, "fp long").repartition(4)
    got = simhash.connected(simhash.links(fps, cell_limit=limit)).collect()
    of = {p: p for p in prints}
    for r in got:
        of[r.u % 2**64] = r.root % 2**64
    want = slow_components(prints)
    assert len({(of[p], want[p]) for p in prints}) == len(set(of.values())) == len(set(want.values()))


def test_every_close_pair_shares_a_cell():
    rng = random.Random(1)
    first = simhash.first_masks(3)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 3)):
            y ^= 1 << b
        shared = [m for m in first if x & m == y & m]
        assert shared
        for m in shared[:3]:
            assert any(x & k == y & k for k in simhash.second_masks(m, 3))
    assert all(64 - k.bit_count() <= 12 for m in first for k in simhash.second_masks(m, 3))


def test_pivots_discard_no_close_pair():
    rng = np.random.default_rng(0)
    fp = rng.integers(0, 2**64, 50, dtype=np.uint64)
    near = fp ^ (np.uint64(1) << rng.integers(0, 64, 50, dtype=np.uint64))
    both = np.concatenate([fp, near])
    root = simhash.link_cells(np.zeros(100, int), both, 3, simhash.pivots())
    assert (root[:50] == root[50:]).all() and len(set(root)) == 50


def test_odd_rows(odd):
    check(ODD, simhash.components(odd).collect())


def test_keep_one(odd):
    got = simhash.keep_one(odd)
    assert got.columns == odd.columns
    ids = [r.doc_id for r in got.collect()]
    # empty texts share fingerprint zero; ties and repeats leave one row, also without an id
    assert sorted(i for i in ids if i is not None) == [1, 4, 6, 7, 8, 9, 10] and ids.count(None) == 1


def test_keep_one_decides_by_row(make_docs):
    one, two, three = ("a b c d e f", "quite other words stand in here", "and a third text of its own kind")
    rows = [(5, one), (5, two), (7, two), (None, one), (None, three), (None, three), (9, three), (11, "one last text that no other has")]
    got = simhash.keep_one(make_docs(rows))
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(5, one), (5, two), (9, three), (11, rows[-1][1])]


def test_empty(empty):
    assert simhash.components(empty).collect() == []
    assert simhash.keep_one(empty).collect() == []


def test_no_links(make_docs):
    got = simhash.components(make_docs([(1, "one two three four"), (2, "something else entirely here")])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (2, 2)]


def test_self_links_are_no_components(shared):
    assert simhash.connected(shared.createDataFrame([(1, 1)], "u long, v long")).count() == 0
