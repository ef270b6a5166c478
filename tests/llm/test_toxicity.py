import random

import numpy as np
import pytest

from tablesync.llm import toxicity as X

SYLLABLES = ["the", "an", "er", "on", "in", "sh", "ou", "nd", "es"]


def corpus(n, seed):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices(SYLLABLES, k=rng.randrange(1, 4))) for _ in range(rng.randrange(5, 200))]
        if i % 3 == 0:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(["vilex", "nastyq", "grumblor"]))
        texts.append(" ".join(words).encode())
        labels.append(int(i % 3 == 0))
    return texts, labels


@pytest.fixture(scope="module")
def network():
    return X.train(*corpus(600, 1))


def test_held_out_accuracy(network):
    texts, labels = corpus(300, 2)
    words = X.Words()
    rows = [words.row(X.words_of(t)) for t in texts]
    scores = network.scores(rows, network.vectors(words.features()))
    assert ((scores >= X.THRESHOLD) == np.array(labels)).mean() > 0.9


def test_gradients_are_those_of_differences():
    network = X.Network(3)
    words = X.Words()
    rows = [words.row(b"a bb ccc dd a".split()), words.row(b"dd".split()), words.row([])]
    features, at, wanted = words.features(), X.padded(rows), np.array([1, 0, 1], np.float32)

    def loss():
        logit, _ = network.forward(network.vectors(features), at)
        return float(np.mean(np.logaddexp(0, logit.astype(np.float64)) - wanted * logit))

    grads, _ = network.gradients(network.vectors(features), features, at, wanted)
    for name, grad in grads.items():
        place = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        held = network.weights[name][place]
        found = []
        for shift in (0.01, -0.01):
            network.weights[name][place] = held + shift
            found.append(loss())
        network.weights[name][place] = held
        assert (found[0] - found[1]) / 0.02 == pytest.approx(float(grad[place]), rel=0.05, abs=2e-4), name


def test_windows_overlap_and_cover_all():
    for n in (0, 1, 32, 33, 48, 49, 200):
        parts = list(X.windows(np.arange(n)))
        assert {int(x) for p in parts for x in p} == set(range(n)) and all(len(p) <= X.LENGTH for p in parts)


def test_rows(spark, docs_of, network):
    texts, labels = corpus(60, 5)
    rows = [(i, t.decode()) for i, t in enumerate(texts)] + [(100, None), (101, ""), (None, "x"), (102, "vilex " + "the " * 50_000), (1, texts[1].decode())]
    docs = docs_of(rows).withColumnRenamed("lang", "score")
    found = X.score_documents(docs, network).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    assert all(r.held_out == X.is_held_out(r.doc_id) for r in found)
    assert X.score_documents(docs.limit(0), network).count() == 0
    known = spark.createDataFrame([(i, y, 1) for i, y in enumerate(labels)] + [(0, None, 1), (None, 1, 1), (100, 1, 1)], "doc_id long, toxic int, lang int")
    chosen, marks = X.learning_sample(docs, known, size=5)
    assert len(chosen) == 10 and sum(marks) == 5
    allowed = {t for i, t in enumerate(texts) if not X.is_held_out(i)}
    assert set(chosen) <= allowed
    assert X.train([], []).weights.keys() == network.weights.keys()
    assert X.learning_sample(docs, known.limit(0)) == ([], [])
