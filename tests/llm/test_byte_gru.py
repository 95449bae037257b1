"""Language identification: gradients against differences, held-out accuracy, positions against a plain network, awkward rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from fleetlens.llm import byte_gru
from fleetlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 5, 40).astype(np.uint8)
    starts, lengths, label, weight = np.array([0, 9, 20]), np.array([9, 4, 7]), np.array([0, 1, 1]), np.array([1.0, 2.0, 0.5])
    network = byte_gru.Network.start(["a", "b"], 3)
    for name in ("bytes_in", "state", "out", "bias"):
        setattr(network, name, getattr(network, name).astype(float))
    read = byte_gru.reading(data, starts, lengths)
    _, found = byte_gru.gradients(network, read, lengths, label, weight)
    for w, g in zip(network.weights(), found, strict=True):
        for at in rng.choice(w.size, min(12, w.size), replace=False):
            place = np.unravel_index(at, w.shape)
            old, ends = w[place], []
            for step in (1e-4, -1e-4):
                w[place] = old + step
                ends.append(byte_gru.gradients(network, read, lengths, label, weight)[0])
            w[place] = old
            assert abs((ends[0] - ends[1]) / 2e-4 - g[place]) < 1e-4


def plain(network: byte_gru.Network, text: bytes) -> np.ndarray:
    """Mean probabilities over all positions of all segments, one byte at a time."""
    total, size = np.zeros(len(network.languages)), network.size

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    def states(d: int, data: bytes) -> list:
        h, out = np.zeros(size), []
        for b in data:
            a, g = network.bytes_in[d, b].astype(float), h @ network.state[d].astype(float)
            z, r = sigmoid(a[:size] + g[:size]), sigmoid(a[size : 2 * size] + g[size : 2 * size])
            h = (1 - z) * np.tanh(a[2 * size :] + r * g[2 * size :]) + z * h
            out.append(h)
        return out

    parts = -(-len(text) // byte_gru.SEGMENT)
    for k in range(parts):
        part = text[len(text) * k // parts : len(text) * (k + 1) // parts]
        for x, y in zip(states(0, part), states(1, part[::-1])[::-1], strict=True):
            e = np.exp(np.concatenate([x, y]) @ network.out.astype(float) + network.bias)
            total += e / e.sum()
    return total / len(text)


def test_predictions_equal_a_plain_network():
    network = byte_gru.Network.start(["a", "b", "c"], 5)
    texts = ["x", "Hello WORLD", "été " * 50, "", "a longer text, " * 40]
    made = byte_gru.predict(network, pa.array(texts))
    for text, row in zip(texts, made, strict=True):
        low = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
        want = plain(network, low) if text else np.zeros(3)
        assert np.allclose(row, want, atol=1e-4)


def test_held_out_accuracy(spark):
    made = QUERIES["op12_language_id"](spark, SF).alias("m")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = made.join(docs, "doc_id").select("held_out", "lang", "lang_pred", "score", "text").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out and r.lang]
    assert len(held) > 100 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("learnt", [True, False])
def test_awkward_rows(spark, learnt):
    long = "the cat and the dog " * 20_000
    rows = [(k, t, lang if learnt else None, "x", 1) for k, (t, lang) in enumerate([
        (None, "en"), ("", "en"), (" \n", "en"), ("123 !!", "en"), ("a", None), ("the cat", "en"), ("le chat est là", "fr"), (long, "en"), ("日本語", "ja"), ("the cat", "en")
    ])]
    rows += [(None, "le chien", "fr", "x", 1), (5, "le chien", "fr", "x", 1)]
    rows += [(100 + k, t, lang if learnt else None, "x", 1) for k in range(20) for t, lang in (("the cat and the dog", "en"), ("le chat et le chien", "fr"))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, lang_pred string, score int")
    if not learnt:
        docs = docs.where("lang IS NULL")
    network = byte_gru.fit_languages(docs)
    got = byte_gru.identify(docs, network).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    assert all((by_id[k].lang_pred, by_id[k].score) == ("und", 0.0) for k in (0, 1, 2, 3))
    if learnt:
        assert by_id[7].lang_pred == "en" and by_id[100].lang_pred in ("en", "fr")
        assert byte_gru.identify(docs, byte_gru.fit_languages(docs)).collect() == got
    else:
        assert network is None and {r.lang_pred for r in got} == {"und"}
    assert byte_gru.identify(docs.limit(0), network).collect() == []
