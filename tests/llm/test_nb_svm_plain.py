"""The classifier against a plain one over feature names: dictionaries, no buckets, no arrays."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from fleetlens.llm import nb_svm

GOOD = ["The boats left at dawn, 12 of them.", "Nets were mended by the shore", "She wrote 3 letters home", "A calm sea and a clear sky"]
BAD = ["BUY BUY NOW!!! $$$", "click click here here 99999", "FREE free FREE $1", "now now now Buy!!"]


def kind(c: str) -> str:
    b = ord(c)
    return "A" if "A" <= c <= "Z" else "a" if "a" <= c <= "z" or b > 127 else "0" if "0" <= c <= "9" else c


def features(text: str) -> list[tuple]:
    words = text.split()
    shapes = []
    for w in words:
        kinds = [kind(c) for c in w]
        shapes.append("".join(c for k, c in enumerate(kinds) if k == 0 or kinds[k - 1] != c))
    low = [w.lower() for w in words]
    out = {("word", w) for w in low} | {("shape", s) for s in shapes}
    out |= {("words", *p) for p in zip(low, low[1:])} | {("shapes", *p) for p in zip(shapes, shapes[1:])}
    if words:
        out.add(("again", math.ceil(10 * sum(a == b for a, b in zip(low, low[1:])) / len(words))))
    return sorted(out, key=str)


def plain_scores(texts: list[str], labels: list[int], asked: list[str]) -> list[float]:
    learn = [(features(t), y) for k, (t, y) in enumerate(zip(texts, labels)) if k % 5 != 4]
    counts = [{}, {}]
    for bag, y in learn:
        for f in bag:
            counts[y][f] = counts[y].get(f, 0) + 1
    total = [2**nb_svm.BUCKET_BITS + sum(c.values()) for c in counts]

    def ratio(f: tuple) -> float:
        return math.log((counts[1].get(f, 0) + 1) / total[1]) - math.log((counts[0].get(f, 0) + 1) / total[0])

    share = sum(y for _, y in learn) / len(learn)
    w, bias, alpha = {}, 0.0, [0.0] * len(learn)
    order = np.random.default_rng(7)
    for _ in range(12):
        for i in order.permutation(len(learn)):
            bag, y = learn[i]
            sign, x = (1 if y else -1), {f: ratio(f) / math.sqrt(len(bag)) for f in bag}
            gradient = sign * (sum(w.get(f, 0) * v for f, v in x.items()) + bias) - 1
            new = min(max(alpha[i] - gradient / (sum(v * v for v in x.values()) + 1), 0), 0.5 / (share if y else 1 - share))
            for f, v in x.items():
                w[f] = w.get(f, 0) + (new - alpha[i]) * sign * v
            bias += (new - alpha[i]) * sign
            alpha[i] = new

    def margin(text: str) -> float:
        bag = features(text)
        return sum(w.get(f, 0) * ratio(f) for f in bag) / math.sqrt(max(len(bag), 1)) + bias

    # The curve: the same penalised loss, by plain descent.
    points = [(margin(t), y) for k, (t, y) in enumerate(zip(texts, labels)) if k % 5 == 4]
    a, b = 1.0, 0.0
    for _ in range(60_000):
        off = [1 / (1 + math.exp(-(a * m + b))) - y for m, y in points]
        a -= 0.02 * (sum(e * m for e, (m, _) in zip(off, points)) + 0.1 * (a - 1))
        b -= 0.02 * (sum(off) + 0.1 * b)
    return [1 / (1 + math.exp(-(a * margin(t) + b))) for t in asked]


def bags_of(texts: list[str]) -> list[np.ndarray]:
    doc, bucket = nb_svm.indicators(pa.array(texts))
    return [bucket[doc == k] for k in range(len(texts))]


def test_features_are_the_indicators():
    texts = [*GOOD, *BAD, "", " \t ", "same same same", "Éclair über 1A"]
    assert [len(b) for b in bags_of(texts)] == [len(features(t)) for t in texts]


def test_scores_are_those_of_the_plain_classifier():
    pick = random.Random(5)
    labels = [pick.random() < 0.6 for _ in range(40)]
    texts = [" ".join(pick.choice(GOOD if y else BAD).split()[: pick.randint(2, 9)]) + (" now" if pick.random() < 0.2 else "") for y in labels]
    labels = [int(y) for y in labels]
    asked = [*GOOD, *BAD, "", "a clear FREE sky", "words never seen before"]
    got = nb_svm.fit(bags_of(texts), np.array(labels)).score(pa.array(asked))
    assert got == pytest.approx(plain_scores(texts, labels, asked), abs=2e-3)
    assert min(got[:4]) > 0.5 > max(got[4:8])
