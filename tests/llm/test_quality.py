"""Signals, votes, the label model and the scorer against plain code."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest

from coldshelf.llm import quality
from coldshelf.llm.textops import Words, flat

WORD = re.compile("[^\x20\x09-\x0d]+")
TEXTS = [
    "The cat sat on the mat. The cat sat on the mat again, and the dog did not!",
    "BUY NOW!!! $$$ ### BUY NOW!!! WIN WIN WIN",
    "",
    "one",
    "der Hund und die Katze sind nicht in dem Haus . " * 12,
    "a b c d e f g h a b c d e f g h a b c d e f g h",
    "same same same same other other, Same same",
]


def plain_signals(text):
    words = [w.encode() for w in WORD.findall(text)]
    lower = [w.lower() for w in words]
    data = text.encode()
    n = max(len(words), 1)
    letters = sum(65 <= c <= 90 or 97 <= c <= 122 for c in data)
    windows = {}
    for i in range(len(lower) - 7):
        windows.setdefault(tuple(lower[i : i + 8]), []).append(i)
    again = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(8)}
    stops = {w.encode() for w in quality.FUNCTION_WORDS}
    return [
        len(words),
        sum(c in b"#*$%&|<>" for c in data) / n,
        sum(65 <= c <= 90 for c in data) / max(letters, 1),
        sum(w.endswith(b"!") for w in words) / n,
        sum(w in stops for w in lower) / n,
        sum(w[-1] in b".?!" for w in words) / n,
        sum(a == b for a, b in zip(lower, lower[1:])) / n,
        len(again) / n,
    ]


def test_signals():
    found = np.array(quality._signals(Words(*flat(pa.array(TEXTS))))).T
    for text, row in zip(TEXTS, found):
        assert row.tolist() == pytest.approx(plain_signals(text)), text


def plain_vote(name, s):
    n, symbols, capitals, calls, stops, ends, echoes, repeats = s
    bad, least = {
        "symbols": (symbols > 0.2, 5),
        "capitals": (capitals > 0.4, 5),
        "calls": (calls > 0.25, 10),
        "function_words": (stops < 0.04 and n >= 40, 20),
        "sentences": ((ends > 0.5 or ends < 0.01) and n >= 40, 20),
        "echoes": (echoes > 0.2 and n >= 10, 10),
        "repeats": (repeats > 0.3 and n >= 20, 20),
    }[name]
    return 0 if bad else 1 if n >= least else 2


def test_votes(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = {r.doc_id: r.votes for r in quality.voted(quality.signals(docs)).collect()}
    for i, text in enumerate(TEXTS):
        assert found[i] == [plain_vote(x.name, plain_signals(text)) for x in quality.LABELLERS]


def plain_em(votes, counts, rounds):
    share, objects = quality.GOOD, [list(quality.OBJECTS) for _ in votes[0]]
    for _ in range(rounds):
        good = []
        for v in votes:
            a, b = share, 1 - share
            for vote, (bad_rate, good_rate) in zip(v, objects):
                a *= (good_rate, 1 - good_rate, 1)[vote]
                b *= (bad_rate, 1 - bad_rate, 1)[vote]
            good.append(a / (a + b))
        for j in range(len(objects)):
            for k, start in enumerate(quality.OBJECTS):
                weight = [c * (g if k else 1 - g) for c, g in zip(counts, good)]
                against = sum(w for w, v in zip(weight, votes) if v[j] == 0)
                cast = sum(w for w, v in zip(weight, votes) if v[j] != 2)
                objects[j][k] = (against + 10 * start) / (cast + 10)
        share = min(max(sum(c * g for c, g in zip(counts, good)) / sum(counts), 1e-3), 1 - 1e-3)
    return share, objects, good


def test_expectation_maximisation():
    rng = np.random.default_rng(2)
    votes = np.unique(rng.integers(0, 3, (60, 4)), axis=0)
    counts = rng.integers(1, 500, len(votes)).astype(float)
    share, objects, _ = plain_em(votes.tolist(), counts.tolist(), 25)
    model = quality.fit_label_model(votes, counts, rounds=25)
    assert model.good == pytest.approx(share) and np.allclose(model.objects, objects)


def test_posteriors_are_products_of_the_votes():
    model = quality.LabelModel(0.8, np.array([(0.7, 0.01), (0.4, 0.1)]))
    for votes in ([0, 0], [0, 1], [1, 2], [2, 2]):
        a, b = 0.8, 0.2
        for vote, (bad_rate, good_rate) in zip(votes, model.objects):
            a *= (good_rate, 1 - good_rate, 1)[vote]
            b *= (bad_rate, 1 - bad_rate, 1)[vote]
        assert model.posterior(np.array([votes]))[0] == pytest.approx(a / (a + b))


def test_scorer_learns_soft_labels_and_scores_them():
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["fine", "good", "prose", "here"] if i % 2 else ["junk", "spam", "##", "!!"], 30)) for i in range(80)]
    words = Words(*flat(pa.array(texts)))
    row, bucket, weight = quality._features(words, 10)
    label = np.where(np.arange(80) % 2, 0.95, 0.05)
    scorer = quality.fit_scorer(row, bucket, weight, label, bits=10)
    found = scorer.score(words)
    # The score by its definition, and the soft labels told apart.
    odds = np.full(80, scorer.bias)
    for r, b, w in zip(row, bucket, weight):
        odds[r] += w * scorer.weights[b]
    assert found == pytest.approx(1 / (1 + np.exp(-odds)))
    assert found[label > 0.5].min() > 0.7 > 0.3 > found[label < 0.5].max()
    for r in range(3):
        assert math.isclose(sum(w * w for w in weight[row == r]), 1)


def test_the_sample_holds_every_document_of_a_small_table(spark):
    docs = spark.createDataFrame([(i, f"{t} {i}") for i in range(40) for t in TEXTS], "doc_id long, text string")
    whole, part = quality.fit(docs), quality.fit(docs, sample=40)
    assert not np.array_equal(whole.weights, part.weights)
    again = quality.fit(docs.repartition(3), sample=10**6)
    assert np.array_equal(whole.weights, again.weights)
