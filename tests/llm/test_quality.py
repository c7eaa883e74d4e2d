import zlib

import numpy as np
import pytest

from sylva.llm import quality

from .conftest import ODD

SF = "/root/testdata/sf0.01"


def test_features_against_plain_loops():
    texts = ["The cat\tsat.", "", "a", "xy  zz é😀b"]
    doc, bucket = quality.features(texts)
    for d, text in enumerate(texts):
        padded = f" {text} ".replace("\t", " ")
        grams = [padded[i : i + n] for n in (3, 4) for i in range(len(padded) - n + 1) if " " not in padded[i : i + n][1:-1]]
        n = len(text.split())
        assert np.count_nonzero(doc == d) == len(grams) + n + max(n - 1, 0)
    same, other = quality.features(["word other", "x word"]), quality.features(["word"])
    assert set(other[1]) <= set(same[1][same[0] == 0]) and set(other[1]) <= set(same[1][same[0] == 1])


def test_fit_against_plain_loops():
    rng = np.random.default_rng(3)
    rows = [(int(k % 2), np.unique(rng.integers(k % 2, 40, 6)).astype("<i4"), None) for k in range(30)]
    rows = [(y, ids, rng.integers(1, 4, len(ids)).astype("<f4")) for y, ids, _ in rows]
    dim, epochs, rate = 3, 2, 0.5
    got = quality.fit(rows, dim, epochs, rate, seed=9)

    from math import exp

    rng, size = np.random.default_rng(9), 1 << quality.BUCKET_BITS
    vectors = rng.uniform(-1 / dim, 1 / dim, (size, dim))
    vectors = {i: [float(x) for x in vectors[i]] for i in range(40)}
    out = rng.uniform(-1 / dim, 1 / dim, (dim, 2)).tolist()
    bias, step = [0.0, 0.0], 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            y, ids, counts = rows[k]
            lr = rate * (1 - step / (epochs * len(rows)))
            step += 1
            share = [float(c) / (float(sum(counts)) + quality.PRIOR) for c in counts]
            hidden = [sum(w * vectors[i][d] for w, i in zip(share, ids)) for d in range(dim)]
            logit = [sum(hidden[d] * out[d][c] for d in range(dim)) + bias[c] for c in range(2)]
            p = [exp(x) / sum(map(exp, logit)) for x in logit]
            error = [p[c] - (c == y) for c in range(2)]
            back = [sum(out[d][c] * error[c] for c in range(2)) for d in range(dim)]
            for c in range(2):
                bias[c] -= lr * 0.1 * error[c]
                for d in range(dim):
                    out[d][c] -= lr * hidden[d] * error[c]
            for w, i in zip(share, ids):
                vectors[i] = [v - lr * quality.SPREAD * w * b for v, b in zip(vectors[i], back)]
    for i in range(40):
        assert got.weight[i] == pytest.approx(sum(vectors[i][d] * (out[d][1] - out[d][0]) for d in range(dim)), abs=1e-9)
    assert got.bias == pytest.approx(bias[1] - bias[0], abs=1e-9)


def test_conflicting_labels_and_text_ids(shared, odd):
    labels = shared.createDataFrame([(6, 1), (6, 0), (4, 1), (4, 1), (8, 0)], "doc_id long, quality int")
    plain = shared.createDataFrame([(6, 0), (4, 1), (8, 0)], "doc_id long, quality int")
    assert quality.train(odd, labels).bias == quality.train(odd, plain).bias != 0
    named = odd.withColumn("doc_id", quality.F.concat(quality.F.lit("d"), "doc_id"))
    given = plain.withColumn("doc_id", quality.F.concat(quality.F.lit("d"), "doc_id"))
    assert quality.score(named, quality.train(named, given)).schema["doc_id"].dataType.simpleString() == "string"


@pytest.fixture(scope="module")
def trained(shared):
    docs = shared.read.parquet(f"{SF}/documents.parquet")
    return docs, quality.train(docs, quality.labels_of(shared, SF))


def test_held_out_accuracy(shared, trained):
    docs, model = trained
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    assert len(got) == docs.count()
    labels = {r.doc_id: r.quality for r in quality.labels_of(shared, SF).collect()}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(got[i].predicted, y) for i, y in labels.items() if got[i].held_out]
    assert np.mean([p == y for p, y in held]) >= 0.85
    assert np.mean([p for p, y in held if y == 1]) >= 0.95  # clean documents stay


def test_held_out_labels_and_other_columns_change_nothing(shared, trained):
    docs, model = trained
    labels = quality.labels_of(shared, SF)
    flipped = labels.withColumn("quality", quality.F.when(quality.held_out("doc_id"), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    again = quality.train(docs.withColumn("lang", quality.F.lit("xx")).withColumn("source", quality.F.lit(None)), flipped)
    assert (again.weight == model.weight).all() and again.bias == model.bias


def test_equal_texts_score_alike_in_any_batch(trained):
    _, model = trained
    text = "Some words of a text. " * 50
    alone = model.scores([text])[0]
    assert set(model.scores(["other words", text, None, text, "x" * 3_000_000, text])[[1, 3, 5]]) == {alone}


def test_keep_good(shared, trained):
    docs, model = trained
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    want = {r.doc_id for r in quality.score(docs, model).collect() if r.predicted == 1}
    assert {r.doc_id for r in kept.collect()} == want


def test_odd_rows_and_labels(shared, odd):
    labels = shared.createDataFrame([(6, 1), (6, 1), (4, 0), (7, 1), (8, 0), (None, 1), (99, 0), (5, None)], "doc_id long, quality int")
    model = quality.train(odd, labels)
    got = quality.score(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert quality.keep_good(odd, model).columns == odd.columns


def test_without_labels(shared, odd):
    model = quality.train(odd, shared.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality.score(odd, model).collect()} == {0.5}  # and no warning about empty texts


def test_empty(shared, empty, trained):
    assert quality.score(empty, trained[1]).collect() == []
    assert quality.keep_good(empty, trained[1]).collect() == []
