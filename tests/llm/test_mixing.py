import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sylva.llm import mixing

from .conftest import ODD, SF


def slow_topic(text):
    for name, pattern in mixing.TOPICS:
        if re.search(pattern, text or ""):
            return name
    return "prose"


def slow_rake(cells, targets, rounds=mixing.ROUNDS):
    """Plain iterative proportional fitting; targets per margin."""
    total = sum(cells.values())
    w = {c: n / total for c, n in cells.items()}
    for _ in range(rounds):
        for axis, goal in enumerate(targets):
            now = defaultdict(float)
            for c, x in w.items():
                now[c[axis]] += x
            for c in w:
                w[c] = w[c] * goal[c[axis]] / now[c[axis]] if now[c[axis]] else 0.0
    return w


def goals(cells, exponents):
    out = []
    for axis, e in enumerate(exponents):
        sums = defaultdict(float)
        for c, n in cells.items():
            sums[c[axis]] += n
        raw = {k: v**e for k, v in sums.items() if v}
        out.append(defaultdict(float, {k: v / sum(raw.values()) for k, v in raw.items()}))
    return out


def test_whole_table(shared):
    docs = shared.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    got = mixing.plan_sample(docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)
    cells = defaultdict(int)
    for r in got:
        row = rows[r.doc_id]
        assert r.n_tokens == len(re.findall(r"[^\x20\x09-\x0D]+", row.text)) and r.topic == slow_topic(row.text)
        cells[r.source, r.lang, r.topic] += r.n_tokens
    want = slow_rake(cells, goals(cells, [mixing.EXPONENTS[m] for m in mixing.MARGINS]))
    for r in got:
        assert r.cell_weight == pytest.approx(want[r.source, r.lang, r.topic], rel=0.02)
    # the factor is the same wherever the probability is not cut off at 1
    free = {round(r.probability * cells[r.source, r.lang, r.topic] / r.cell_weight, 3) for r in got if 0 < r.probability < 1}
    assert max(free) <= min(free) * 1.001
    spent = sum(n * p for n, p in {(r.doc_id, r.n_tokens): (r.n_tokens, r.probability) for r in got}.values())
    assert spent == pytest.approx(mixing.BUDGET * sum(cells.values()), rel=1e-6)
    assert {r.doc_id for r in got if r.sampled} == {r.doc_id for r in mixing.sample(docs).collect()}


def test_given_targets_are_met(make_docs):
    rows = [(i, "w " * (1 + i % 7), ("en", "de")[i % 3 == 0], ("hot", "rare")[i % 5 == 0]) for i in range(300)]
    targets = {"source": {"hot": 0.5, "rare": 0.5}, "lang": {"en": 0.4, "de": 0.6}, "topic": {"prose": 1.0}}
    got = mixing.plan_sample(make_docs(rows), targets=targets, budget=0.3).collect()
    weight = {(r.source, r.lang, r.topic): r.cell_weight for r in got}
    for axis, name in ((0, "source"), (1, "lang")):
        for value, share in targets[name].items():
            assert sum(w for c, w in weight.items() if c[axis] == value) == pytest.approx(share, rel=mixing.TOLERANCE)
    assert sum(r.n_tokens * r.probability for r in got) == pytest.approx(0.3 * sum(r.n_tokens for r in got), rel=1e-6)


def test_expected_sample_meets_the_targets(shared):
    got = mixing.plan_sample(shared.read.parquet(f"{SF}/documents.parquet")).collect()
    cells = defaultdict(int)
    for r in got:
        cells[r.source, r.lang, r.topic] += r.n_tokens
    targets = goals(cells, [mixing.EXPONENTS[m] for m in mixing.MARGINS])
    spent = sum(r.n_tokens * r.probability for r in got)
    assert any(r.probability > 1 for r in got)
    for axis, goal in enumerate(targets):
        share = defaultdict(float)
        for r in got:
            share[(r.source, r.lang, r.topic)[axis]] += r.n_tokens * r.probability / spent
        for value, wanted in goal.items():
            assert share[value] == pytest.approx(wanted, rel=10 * mixing.TOLERANCE), value
    assert all(r.sampled in (int(r.probability), int(r.probability) + 1) for r in got)


def test_drawn_copies_meet_the_targets(make_docs):
    rows = [(i, "a b c", "en", "rare" if i % 20 == 0 else "hot") for i in range(4000)]
    docs = make_docs(rows)
    targets = {"source": {"hot": 0.5, "rare": 0.5}}
    plan = {r.doc_id: r for r in mixing.plan_sample(docs, targets=targets).collect()}
    drawn = Counter(r.doc_id for r in mixing.sample(docs, targets=targets).collect())
    assert drawn == Counter({i: r.sampled for i, r in plan.items() if r.sampled})
    rare = sum(n for i, n in drawn.items() if i % 20 == 0)
    assert {r.probability for r in plan.values() if r.source == "rare"} == {6.0} and rare == 1200
    assert rare / sum(drawn.values()) == pytest.approx(0.5, abs=0.03)


def test_contradicting_targets_are_refused(make_docs):
    docs = make_docs([(i, "a b c", ("en", "de")[i % 2], ("x", "y")[i % 2]) for i in range(40)])
    targets = {"source": {"x": 0.9, "y": 0.1}, "lang": {"en": 0.1, "de": 0.9}}
    with pytest.raises(ValueError, match="not met together"):
        mixing.plan_sample(docs, targets=targets)
    # default targets that contradict: told, not raised
    told = mixing.plan_sample(make_docs([(i, "a b c " * (1 + 8 * (i % 2)), ("en", "de")[i % 2], ("x", "y")[i % 2]) for i in range(40)]))
    assert all(r.deviation > mixing.ACCEPT for r in told.collect())
    assert all(r.deviation <= mixing.TOLERANCE for r in mixing.plan_sample(make_docs([(1, "a", "en", "x"), (2, "b", "en", "y")])).collect())


def test_given_topics_and_numbered_copies(make_docs):
    docs = make_docs([(i, ("prose of words", "int main()")[i % 10 == 0], "en", "x") for i in range(200)])
    topics, targets = [("code", r"\(\)")], {"topic": {"code": 0.5, "prose": 0.5}}
    plan = mixing.plan_sample(docs, targets=targets, budget=1.0, topics=topics).collect()
    assert Counter(r.topic for r in plan) == {"code": 20, "prose": 180}
    got = mixing.sample(docs, targets=targets, budget=1.0, topics=topics, copy_col="copy").collect()
    assert len({(r.doc_id, r.copy) for r in got}) == len(got) == sum(r.sampled for r in plan)
    with pytest.raises(ValueError, match="already"):
        mixing.sample(docs, copy_col="Rank")


def test_clashing_names(make_docs):
    docs = make_docs([(i, "a b", "en", f"s{i % 2}") for i in range(20)])
    clash = docs.withColumns({c: F.lit(7) for c in ("cell_weight", "cell_probability", "drawn", "cell_source")})
    got = mixing.sample(clash)
    assert got.columns == clash.columns and got.where("cell_probability <> 7").count() == 0 and got.count() == mixing.sample(docs).count()


def test_source_without_a_target_is_left_out(make_docs):
    rows = [(i, "a b c", "en", ("x", "y")[i % 2]) for i in range(40)]
    got = mixing.plan_sample(make_docs(rows), targets={"source": {"x": 1.0}}).collect()
    assert {r.probability for r in got if r.source == "y"} == {0.0} and not any(r.sampled for r in got if r.source == "y")


def test_full_budget_keeps_everything(make_docs):
    docs = make_docs([(i, "a b c", "en", f"s{i % 3}") for i in range(30)])
    assert mixing.sample(docs, budget=1.0).count() == 30


def test_native_plan(shared):
    plan = mixing.sample(shared.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_shuffled_cells_give_the_same(make_docs, monkeypatch):
    docs = make_docs([(i, f"w{i} " * (i % 9), ("en", None)[i % 4 == 0], f"s{i % 5}") for i in range(100)])
    broadcast = sorted(map(tuple, mixing.plan_sample(docs).select("doc_id", "probability", "sampled").collect()))
    monkeypatch.setattr(mixing, "BROADCAST_CELLS", 0)
    assert sorted(map(tuple, mixing.plan_sample(docs).select("doc_id", "probability", "sampled").collect())) == broadcast


def test_odd_rows(odd):
    got = mixing.plan_sample(odd).collect()
    assert len(got) == len(ODD)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {0}
    assert all(r.probability is not None and r.sampled is not None for r in got)
    kept = mixing.sample(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.sampled for r in got)


def test_only_blank_texts(make_docs):
    assert mixing.sample(make_docs([(1, None), (2, " ")])).count() == 2


def test_empty(empty):
    assert mixing.plan_sample(empty).collect() == [] and mixing.sample(empty).collect() == []


def test_draw_is_uniform(shared):
    u = shared.range(20000).select(mixing.draw("id", "id").alias("u")).agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(u[0] - 0.5) < 0.01 and 0 <= u[1] and u[2] < 1
