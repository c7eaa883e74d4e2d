import re

import pytest

from sylva.llm import licences

from .conftest import ODD, SF


def slow(text):
    """The contract's base and the rules with suppression by comparing all pairs."""
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, base = [], set()
    for phrase, label in licences.BASE:
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                base.add(label)
    joined = "".join(f" {w}" for w in words) + " "
    found = []
    for number, (tier, conf, label, _, signature) in enumerate(licences.RULES):
        found += [(m.start(), -m.end(), tier, number, label, conf) for m in re.finditer(signature, joined)]
    kept = [d for d in found if not any(e != d and e[0] <= d[0] and e[1] <= d[1] and e[2] <= d[2] and ((e[0], e[1]) != (d[0], d[1]) or e[2:4] < d[2:4]) for e in found)]
    return (
        len(words),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | {d[4] for d in kept})),
        max([0.5 * bool(base), *(d[5] for d in kept)]),
        len(kept),
    )


def told(r):
    return (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score, r.n_detections)


NOTICES = [
    "Licensed under the Apache License, Version 2.0. MIT License",
    "SPDX-License-Identifier: GPL-3.0-or-later",
    "GNU Lesser General Public License v2.1; the GNU GENERAL PUBLIC LICENSE",
    "mit license mit license general public license apache license",
    "This work is licensed under CC BY-NC 4.0. and a creative commons attribution license",
    "mit\n\tlicense, but not mitlicense nor mit-licensees; permit license",
    "License: BSD 3-Clause. distributed under the Mozilla Public License 2.0",
    "Lİcense MIT LİCENSE K mit licence",
]


def test_hundreds_of_rules():
    assert len(licences.RULES) >= 200
    assert all(re.compile(r[4]) for r in licences.RULES)


def test_notices(make_docs):
    rows = list(enumerate([*NOTICES, " ".join(NOTICES * 3), "mit license " * 500]))
    got = {r.doc_id: told(r) for r in licences.scan(make_docs(rows)).collect()}
    for i, text in rows:
        assert got[i] == slow(text), text[:80]
    assert got[0][5] == "apache,mit" and got[1][6] == 1.0 and got[2][5] == "gpl,lgpl" and got[9][1] == 500


def test_whole_table(shared):
    docs = shared.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = licences.scan(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert told(r) == slow(texts[r.doc_id])


def test_native_plan(shared):
    plan = licences.scan(shared.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_odd_rows(odd):
    got = licences.scan(odd).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, *map(str, told(r))) for r in got) == sorted(
        (i is None, i or 0, *map(str, slow(t))) for i, t, *_ in ODD
    )


def test_empty(empty):
    assert licences.scan(empty).collect() == []


UNGATED = [
    "This program is released under the GNU GPL v3",
    "distributed under CC BY-SA 4.0",
    "available under BSD 3-Clause",
    "governed by the Mozilla Public, subject to Apache 2.0",
    "Released under Expat. Nothing else",
    "the Expat license",
    "subject to change, unreleased under GPL",
]


def every_rule(text):
    """Labels, best confidence and number of kept detections, each rule tried on each text."""
    joined = "".join(f" {w}" for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())) + " "
    found = []
    for number, (tier, conf, label, _, signature) in enumerate(licences.RULES):
        found += [(m.start(), -m.end(), tier, number, label, conf) for m in re.finditer(signature, joined)]
    kept = [d for d in found if not any(e != d and e[0] <= d[0] and e[1] <= d[1] and e[2] <= d[2] and ((e[0], e[1]) != (d[0], d[1]) or e[2:4] < d[2:4]) for e in found)]
    return {d[4] for d in kept}, max([0.0, *(d[5] for d in kept)]), len(kept)


def test_no_gate_drops_a_match(make_docs):
    rows = list(enumerate([*UNGATED, *[n for n in NOTICES if n.isascii()]]))
    for r in licences.scan(make_docs(rows)).collect():
        labels, conf, n = every_rule(rows[r.doc_id][1])
        assert set(r.labels.split(",")) - {""} == labels | set(r.base_labels.split(",")) - {""}, rows[r.doc_id]
        assert r.score == max(conf, 0.5 * bool(r.n_base)) and r.n_detections == n
        assert n > 0 or r.doc_id == len(UNGATED) - 1


@pytest.mark.parametrize("text", [" ", "a", ".", "a.b", "é!"])
def test_word_counts(make_docs, text):
    assert told(licences.scan(make_docs([(1, text)])).first()) == slow(text)
