import random

import numpy as np

from featurelake.llm import ordinal, toxicity
from tests.llm.conftest import make_docs, prose

LABELS = "doc_id long, quality int, toxic int, score double"


def labelled(n=700):
    rng = random.Random(2)
    bad = ["grobnik", "vexlar", "smurd"]
    pairs, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        words = prose(rng, rng.randint(5, 60)).split()
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", "en", "ish", "a"]))
        poor = int(rng.random() < 0.2)
        text = " ".join(w + "***" for w in words) if poor else " ".join(words)
        pairs.append((i, text))
        labels.append((i, 1 - poor, toxic, 0.0))
    return pairs, labels


def test_held_out_accuracy_and_edges(spark):
    pairs, labels = labelled()
    extra = [(9000, None), (9001, ""), (9002, "grobnik " * 4000), (None, "vexlar"), (0, pairs[0][1])]
    docs = make_docs(spark, pairs + extra)
    out = toxicity.toxicity(docs, spark.createDataFrame(labels + [(None, 1, 1, 0.0), (9001, 1, None, 0.0)], LABELS)).collect()
    truth = {i: t for i, _, t, _ in labels}
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 80 and len(out) == len(pairs) + len(extra)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    by = {r["doc_id"]: r for r in out}
    assert by[9000]["score"] == by[9001]["score"] < 0.2 and by[9002]["predicted"] == 1 and by[None]["predicted"] == 1
    assert all(0 <= r["score"] <= 1 for r in out) and by[9002]["evidence"]


def test_scores_use_the_text_only(spark):
    pairs, labels = labelled(400)
    lab = spark.createDataFrame(labels, LABELS)
    train = [p for p in pairs]
    a = {r["doc_id"]: r["score"] for r in toxicity.toxicity(make_docs(spark, train + [(5000, pairs[7][1])]), lab).collect()}
    assert a[5000] == a[7]


def test_index_is_exact(spark):
    rng = np.random.default_rng(0)
    n, terms, k = 900, 60, 15
    rows = []
    for i in range(n):
        ids = rng.choice(terms, rng.integers(0, 8), replace=False).tolist()
        rows.append((i * 3, int(rng.integers(2)), ids, rng.integers(1, 5, len(ids)).tolist()))
    index = toxicity.BlockMaxIndex(list(rows), 1 + rng.random(terms))
    dense = np.zeros((n, terms))
    for r, (_, _, ids, tf) in enumerate(rows):
        if ids:
            dense[r, ids] = index.weights(ids, tf)
    for _, _, ids, tf in rows[:200]:
        if not ids:
            continue
        q = np.zeros(terms)
        q[ids] = index.weights(ids, tf)
        sims = np.round(dense @ q, 9)
        best = sorted((-s, rows[r][0]) for r, s in enumerate(sims) if s > 0)[:k]
        got = [(-s, int(index.ids[r])) for s, r in index.nearest(ids, tf, k)]
        assert np.allclose([s for s, _ in got], [s for s, _ in best])
        assert [i for _, i in got] == [i for _, i in best]


def test_without_labels_and_empty(spark, corpus, no_docs):
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in toxicity.toxicity(corpus, none).collect()} == {0.0}
    assert toxicity.toxicity(no_docs, none).count() == 0
    kept = toxicity.without_toxic(corpus, none)
    assert kept.count() == corpus.count() and kept.columns == corpus.columns


def test_ordinal_grades(spark, corpus, no_docs):
    pairs, labels = labelled()
    docs = make_docs(spark, pairs + [(9000, None), (9001, ""), (None, "x y z")])
    lab = spark.createDataFrame(labels + [(None, 1, 1, 0.0), (3, None, 0, 0.0)], LABELS)
    out = ordinal.quality(docs, lab).collect()
    truth = {i: (0 if not q else 1 if t else 2) for i, q, t, _ in labels}
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([(r["p_ge_1"] >= 0.5) == (truth[r["doc_id"]] > 0) for r in held]) > 0.95
    assert np.mean([r["kept"] for r in held if truth[r["doc_id"]] > 0]) > 0.95
    for r in out:
        assert 1 >= r["p_ge_1"] >= r["p_ge_2"] >= 0 and abs(r["expected_grade"] - r["p_ge_1"] - r["p_ge_2"]) < 1e-12
    mean = lambda g: np.mean([r["expected_grade"] for r in held if truth[r["doc_id"]] == g])
    assert mean(0) < mean(1) <= mean(2) + 0.2
    none = spark.createDataFrame([], LABELS)
    assert ordinal.quality(no_docs, none).count() == 0
    assert ordinal.quality(corpus, none).count() == corpus.count()


def test_gradient_matches_differences():
    rng = np.random.default_rng(1)
    rows = [(int(rng.integers(3)), rng.choice(50, 4, replace=False).tolist(), rng.normal(size=4).tolist()) for _ in range(200)]
    model = ordinal.CumulativeLink().fit(rows, steps=300, rate=0.1)

    def loss(w, b):
        total = 0.0
        for y, s, v in rows:
            z = float(w[s] @ np.array(v))
            cdf = [0.0, *(1 / (1 + np.exp(z - x)) for x in b), 1.0]
            total -= np.log(cdf[y + 1] - cdf[y])
        return total / len(rows) + ordinal.RIDGE / 2 * float(w @ w)

    at = loss(model.w, model.b)
    assert model.b[0] < model.b[1]
    for i in range(10):   # a minimum: no small step helps
        for e in (1e-3, -1e-3):
            w = model.w.copy()
            w[i] += e
            assert loss(w, model.b) > at - 1e-5
    for k in range(2):
        for e in (1e-3, -1e-3):
            b = model.b.copy()
            b[k] += e
            assert loss(model.w, b) > at - 1e-5
