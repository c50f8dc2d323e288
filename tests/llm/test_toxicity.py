"""Positive-unlabelled learning: the risk's gradient, held-out rows and odd input."""

import random
import zlib

import numpy as np

from daybook.llm import toxicity

DOC, LABEL = "doc_id long, text string, score string, predicted int", "doc_id long, toxic int, score string"
BAD = ["blunk", "varg", "snork", "plib"]


def corpus(n, seed=1):
    """Texts of invented words; a fifth hold several bad words, or forms of one."""
    rng = random.Random(seed)
    good = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    out = []
    for _ in range(n):
        words, toxic = [rng.choice(good) for _ in range(rng.choice([30, 100, 900]))], rng.random() < 0.2
        if toxic:
            for _ in range(max(2, len(words) // 25)):
                words[rng.randrange(len(words))] = rng.choice([*BAD, "grumm" + rng.choice(good)])
        out.append((" ".join(words), int(toxic)))
    return out


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def tables(spark, rows, labelled):
    docs = spark.createDataFrame([(i, t, "mine", 9) for i, (t, _) in enumerate(rows)], DOC)
    labels = spark.createDataFrame([(i, y, "x") for i, (_, y) in enumerate(rows) if labelled(i)], LABEL)
    return docs, labels


def test_held_out_documents_are_told_apart(spark):
    rows = corpus(900)
    docs, labels = tables(spark, rows, lambda i: i % 2 == 0)
    model = toxicity.fit(docs, labels)
    found = {r.doc_id: r for r in toxicity.predict(docs, model).collect()}
    out = [i for i in range(len(rows)) if held(i)]
    assert len(found) == len(rows) and np.mean([found[i].predicted == rows[i][1] for i in out]) > 0.97
    # labels of held-out rows, whatever they say, change nothing
    flipped = spark.createDataFrame([(i, 1 - y if held(i) else y, "x") for i, (_, y) in enumerate(rows) if i % 2 == 0], LABEL)
    again = toxicity.fit(docs, flipped)
    assert np.array_equal(again.weights, model.weights) and again.bias == model.bias
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.score < 0.5}


def test_odd_input(spark):
    rows = corpus(300)
    docs, labels = tables(spark, rows, lambda i: True)
    model = toxicity.fit(docs, labels)
    texts = [None, "", " 12 \n", "blunk " * 200_000, "漢字 ñandú 😀", "blunk varg", "blunk varg"]
    odd = spark.createDataFrame([(None if i == 4 else 7, t, "mine", 1) for i, t in enumerate(texts)], DOC)
    got = toxicity.predict(odd, model).collect()
    assert len(got) == len(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    scores = sorted(r.score for r in got)
    assert scores[-1] > 0.9 and sum(abs(s - toxicity.sigmoid(np.float64(model.bias))) < 1e-9 for s in scores) >= 3
    assert toxicity.predict(docs.limit(0), model).count() == 0
    # nothing to learn from, repeated rows, null labels
    for empty in (labels.limit(0), labels.selectExpr("doc_id", "cast(null as int) as toxic"), labels.selectExpr("doc_id", "0 as toxic")):
        assert {r.score for r in toxicity.predict(docs.limit(3), toxicity.fit(docs, empty)).collect()} == {0.0}
    assert toxicity.fit(docs.limit(0), labels).bias is None
    twice = toxicity.fit(docs.unionByName(docs), labels.unionByName(labels), positives=20, unlabelled=30)
    assert twice.bias is not None and np.isfinite(twice.weights).all()


def test_bounds_hold(spark):
    docs, labels = tables(spark, corpus(200), lambda i: True)
    ids = labels.selectExpr("doc_id as id")
    assert len(toxicity._sampled_windows(docs.unionByName(docs), ids, 50)) == 50


def test_step_follows_the_risk():
    # on separable samples the corrected risk falls, and the prior shifts the bias as it should
    rng = np.random.default_rng(2)
    row = lambda bad: (np.array([1, 2 if bad else 3]), np.array([1.0, 1.0]))
    positive, unlabelled = [row(True)] * 50, [row(rng.random() < 0.3) for _ in range(400)]
    model = toxicity.train(positive, unlabelled, prior=0.3)
    z = lambda bad: model.bias + model.weights[row(bad)[0]].sum()
    assert z(True) > 1 and z(False) < -1
    assert toxicity.train([], unlabelled, 0.3).bias is None and toxicity.train(positive, unlabelled, 0.0).bias is None
    assert toxicity.train(positive, unlabelled, 1.0).bias > 5
