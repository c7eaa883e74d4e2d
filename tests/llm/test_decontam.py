import hashlib
import random
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest

from sylva.llm import decontam as D

from .conftest import SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def slow(docs, items, window=10):
    grams = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            grams.setdefault(tuple(w[i : i + window]), set()).add("" if item is None else str(item))
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, held = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if found := grams.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    held |= found
        names = hashlib.sha256(",".join(sorted(held)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(held), names, bool(hit)))
    return sorted(out, key=repr)


def told(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)


def bench(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id long, text string, doc_id string, place int")


def test_whole_tables(shared):
    docs = shared.read.parquet(f"{SF}/documents.parquet")
    items = shared.read.parquet(f"{SF}/benchmark.parquet")
    want = slow([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert any(r[5] for r in want)
    assert told(D.contamination(docs, items)) == want
    index = D.build(docs, segment_words=700)
    assert told(D.report(index, D.matches(index, items, block_words=900))) == want


def test_a_row_group_holds_one_segment(shared, make_docs):
    # a segment is megabytes: a row group of all of a task's would be held whole by its writer and its readers
    docs = [(i, f"words of text {i}") for i in range(12)]
    index = D.build(make_docs(docs, partitions=1), segment_words=200)
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in index.segments.inputFiles()]
    held = [f.row_group(k).num_rows for f in files for k in range(f.num_row_groups)]
    assert held == [1] * index.segments.count() and len(held) > len(files)
    items = [(1, "words of text 7"), (2, "of text")]
    assert told(D.report(index, D.matches(index, bench(shared, items)))) == slow(docs, items)


def test_odd_rows(shared, odd):
    rows = [(1, None), (2, ""), (3, " ,.!"), (4, "word"), (4, "MARK ça"), (None, "UNIQUE text of the"), (None, "tenth row"), (5, "word " * 40), (6, "ÇA"), (7, "not there at all"), (6, "ÇA")]
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert told(D.contamination(odd, bench(shared, rows))) == slow(docs, rows)


def test_few_words_many_matches(shared, make_docs):
    rng = random.Random(11)
    text = lambda n: " ".join(rng.choices(["a", "b", "Cc", "d1", "é"], k=n))
    docs = [(i, text(rng.randint(0, 60))) for i in range(50)] + [(99, None), (None, text(30))]
    items = [(i, text(rng.randint(1, 7))) for i in range(30)]
    for window in (1, 3, 10):
        assert told(D.contamination(make_docs(docs), bench(shared, items), window)) == slow(docs, items, window)


def test_no_match_across_documents(shared, make_docs):
    docs = make_docs([(1, "one two three four five"), (2, "six seven eight nine ten")], partitions=1)
    items = bench(shared, [(1, "one two three four five six seven eight nine ten")])
    assert [r[5] for r in told(D.contamination(docs, items))] == [False, False]
    index = D.build(docs)
    assert D.matches(index, items, slop=20).collect() == []


def test_empty_tables(shared, empty, make_docs):
    items = bench(shared, [])
    assert told(D.contamination(empty, items)) == [] and told(D.contamination(empty, bench(shared, [(1, "a")]))) == []
    assert told(D.contamination(make_docs([(1, "a b")]), items)) == slow([(1, "a b")], [])


def test_spans_of_phrases(shared, make_docs):
    docs = make_docs([(1, "x a b c d y a b c"), (2, "c b a"), (3, "a b c d")])
    index = D.build(docs)
    got = D.join_documents(index, D.matches(index, bench(shared, [(5, "a b c d"), (6, "b c")]), window=3))
    assert sorted(tuple(r) for r in got.collect()) == [(1, "5", 1, 4), (1, "5", 6, 8), (1, "6", 2, 3), (1, "6", 7, 8), (3, "5", 0, 3), (3, "6", 1, 2)]


def near(docs, items, window, slop):
    """Proximity by its definition: the rarest term fixed, each other one within slop of its place."""
    n = Counter(w for _, t in docs for w in words(t))
    out = set()
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            g = w[i : i + window]
            o1 = min(range(len(g)), key=lambda o: (n[g[o]], o))
            for doc, text_ in docs:
                d = words(text_)
                for p in range(len(d)):
                    if d[p] == g[o1] and all(
                        o == o1 or any(0 <= q < len(d) and d[q] == g[o] for q in range(p + o - o1 - slop, p + o - o1 + slop + 1)) for o in range(len(g))
                    ):
                        out.add((doc, str(item)))
    return out


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_proximity(shared, make_docs, slop):
    rng = random.Random(slop)
    vocabulary = [f"w{chr(97 + i)}" for i in range(12)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 6)))) for i in range(25)]
    index = D.build(make_docs(docs), segment_words=300)
    found = D.join_documents(index, D.matches(index, bench(shared, items), window=4, slop=slop))
    rows = found.collect()
    assert {(r.doc_id, r.item_id) for r in rows} == near(docs, items, 4, slop)
    length = {i: len(words(t)) for i, t in docs}
    assert all(0 <= r.first_word <= r.last_word < length[r.doc_id] for r in rows)


def test_rarest_terms_come_first_and_share_their_first_step():
    items = [("1", [b"the", b"cat", b"sat", b"the"]), ("2", [b"cat", b"sat", b"the", b"zzz"])]
    w = D.plan(items, Counter({"the": 100, "cat": 5, "sat": 7}), window=3)
    assert [[w.terms[t] for _, t in order] for order, _, _ in w.plans] == [["cat", "sat", "the"], ["cat", "sat", "the"]]
    assert len(w.anchors) == 1 and [p[2] for p in w.plans] == [[0], [0, 1]]  # zzz is not in the index


def test_wide_slop_is_refused(shared, make_docs):
    index = D.build(make_docs([(1, "a")]))
    with pytest.raises(ValueError):
        D.matches(index, bench(shared, [(1, "a")]), slop=40)
