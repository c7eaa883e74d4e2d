import numpy as np
import pytest

import corpus_pipeline
from sylva.llm import mixing, pieces, quality
from sylva.llm.common import documents, tokenizer_path

from .conftest import SF
from .test_exact_dedup import norm
from .test_pieces import slow_encode
from .test_simhash import slow_components, slow_fingerprint


@pytest.fixture(scope="module")
def stages(shared):
    """Rows after each stage, the documents first."""
    docs = documents(shared, SF)
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(shared, docs, SF), f"test-{name}")
        out.append(docs.collect())
    return out


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "simhash", "mixing", "pieces"]


def test_against_plain_stages(shared, stages):
    start, good, exact, near, mixed, encoded = stages
    columns = start[0].__fields__
    for rows in stages[:-1]:
        assert all(r.__fields__ == columns for r in rows[:1])
    model = quality.train(documents(shared, SF), quality.labels_of(shared, SF))
    rows = sorted(start, key=lambda r: r.doc_id)
    scores = model.scores([r.text for r in rows])
    rows = [r for r, s in zip(rows, scores) if s >= quality.THRESHOLD]
    assert sorted(r.doc_id for r in good) == [r.doc_id for r in rows]

    groups = {}
    for r in rows:
        groups.setdefault(norm(r.text), []).append((-len(r.text), r.doc_id))
    keep = {min(g)[1] for g in groups.values()}
    assert {r.doc_id for r in exact} == keep and len(exact) == len(keep)

    rows = [r for r in rows if r.doc_id in keep]
    prints = {r.doc_id: slow_fingerprint(r.text) for r in rows}
    root = slow_components(set(prints.values()))
    first = {}
    for i, f in prints.items():
        first[root[f]] = min(i, first.get(root[f], i))
    assert {r.doc_id for r in near} == set(first.values()) and len(near) == len(first)

    planned = mixing.plan_sample(shared.createDataFrame(near, documents(shared, SF).schema)).collect()
    assert {r.doc_id for r in mixed} == {r.doc_id for r in planned if r.sampled} and len(mixed) > 0

    vocab = pieces.Vocabulary.at(tokenizer_path("piece_bpe_32k.model"))
    assert {r.doc_id for r in encoded} == {r.doc_id for r in mixed}
    for r in encoded:
        assert vocab.decode(np.array(r.ids, "<u4")) == r.text
        if len(r.text) < 3000:
            assert r.ids == slow_encode(vocab, r.text)


def test_whole_rows_survive(stages):
    by_id = {r.doc_id: r for r in stages[0]}
    for rows in stages[1:-1]:
        assert all(by_id[r.doc_id] == r for r in rows)
    assert all(tuple(by_id[r.doc_id]) == tuple(r)[:5] for r in stages[-1])


def test_odd_rows_and_empty_tables(shared, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(shared, docs, SF), "test-odd")
            assert set(odd.columns) <= set(docs.columns)
    assert docs.count() == 0
