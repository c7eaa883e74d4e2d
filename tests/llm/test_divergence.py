import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sylva.llm import divergence as D

from .conftest import SF


def slow(rows, ranks=200):
    """Plain loops over Python integers: rows of (text, lang, source)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        n[lang, source].update(terms)
        df[lang].update(set(terms))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, k in df[lang].items() if k >= 3]
        v = len(kept)
        size = {s: sum(n[lang, s][t] for t in kept) for s in sources}
        whole = {t: sum(n[lang, s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + 10**9 * (n[lang, s][t] + 1) // (size[s] + v) for t in kept} for s in sources}
        q = {t: 1 + 10**9 * (whole[t] + 1) // (sum(size.values()) + v) for t in kept}
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            term = [(-f(p[s][t], q[t]), t.encode()) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", i.decode(), -x, r + 1) for r, (x, i) in enumerate(sorted(pair))]
            out += [(lang, s, "term", i.decode(), -x, r + 1) for r, (x, i) in enumerate(sorted(term)[:ranks])]
    return sorted(out)


def told(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_whole_table_in_many_blocks_and_chunks(shared):
    docs = shared.read.parquet(f"{SF}/documents.parquet")
    want = slow([(r.text, r.lang, r.source) for r in docs.collect()])
    assert told(D.audit(docs, block=64, chunk=4)) == want
    assert told(D.audit(docs)) == want


def test_odd_rows(odd, make_docs):
    rows = [(r.text, r.lang, r.source) for r in odd.collect()]
    assert told(D.audit(odd)) == slow(rows)
    rng = random.Random(3)
    words = ["Alpha", "beta", "ÇA", "Éé", "x_y", "naïve", "it's", "a1b", "zz", "ß"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 9))), rng.choice(["en", "", None, "fr"]), rng.choice(["s", "", None, "t", "Ü"])) for i in range(90)]
    rows += [(100 + i, text, lang, source) for i, (text, lang, source) in enumerate([(None, "xx", "a"), ("", "xx", "b"), ("one term", "xx", "c"), ("ééé " * 3, "yy", "z")])]
    assert told(D.audit(make_docs(rows), block=3, chunk=2)) == slow([r[1:] for r in rows])


def test_equal_groups_and_ties(make_docs):
    rows = [(i, "b a c d", "en", f"s{i % 3}") for i in range(9)]
    got = told(D.audit(make_docs(rows)))
    assert got == slow([r[1:] for r in rows]) and {r[4] for r in got} == {0} and len(got) == 6  # no term has p > q


def test_empty(empty):
    out = D.audit(empty)
    assert out.collect() == [] and dict(out.dtypes)["value"] == "bigint" and dict(out.dtypes)["rank"] == "int"


def test_counting_hands_on_bounded_tables(make_docs, monkeypatch):
    monkeypatch.setattr(D, "HELD", 5)
    rows = [(i, f"w{chr(97 + i % 26)} common", "en", f"s{i % 2}") for i in range(60)]
    assert told(D.audit(make_docs(rows))) == slow([r[1:] for r in rows])


def test_share_is_exact_for_large_counts():
    counts, totals = [0, 7, 10**9, 9 * 10**13], [1, 10**13, 3 * 10**13 + 1, 9 * 10**13 + 12345]
    assert D.share(np.array(counts), np.array(totals)).tolist() == [1 + 10**9 * (c + 1) // t for c, t in zip(counts, totals)]


def test_forest_shares_equal_subtrees_and_prices_pairs_once():
    rng = np.random.default_rng(1)
    rows = np.zeros((3, 1000), np.int64)
    rows[:, :20] = rng.integers(1, 50, (3, 20))
    rows[2] = rows[1]
    forest = D.Forest(rows)
    assert forest.nodes() < 3 * 2 * 64 + 30  # the zeros are a chain of single nodes
    assert forest.roots[1] == forest.roots[2] != forest.roots[0]
    walk, x, y, times, looked = forest.meet(np.array([0, 1]), np.array([1, 2]))
    assert looked < 400  # of 2 x 2047 node pairs
    for i, (a, b) in enumerate([(0, 1), (1, 2)]):
        got = Counter({(int(c), int(d)): int(t) for w, c, d, t in zip(walk, x, y, times) if w == i})
        assert got == Counter(zip(rows[a].tolist(), rows[b].tolist()))


def test_more_ranks_than_the_blocks_hand_on(make_docs):
    with pytest.raises(ValueError):
        D.audit(make_docs([(1, "a")]), ranks=1000)
