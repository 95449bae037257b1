"""Language identification: a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through time.

Method. A text's UTF-8 bytes (A-Z as a-z) are cut into segments of at most `SEGMENT` bytes and about equal length. Two gated
recurrent layers read a segment from either end; from both states, a softmax gives every position probabilities of the languages.
Those of all positions of a document are averaged; the language with the highest mean is predicted, and that mean is the score.
States start anew in every segment, so that a long text is as many independent rows as it has segments; no byte is left out.

Training minimises the cross entropy of all positions with Adam, on a bounded sample: at most `FIT_ROWS` documents a language, those
with the smallest hash of their id, of the `FIT_LANGUAGES` most frequent languages, and of each at most `FIT_SEGMENTS` segments
spread over the whole text. Every language has the same weight. The start and the order of the batches are fixed, so that a fit
can be repeated.

Defined cases. A NULL text and one without a letter are `und` with score 0, and not learnt from; so are NULL languages and ids.
Without any row to learn from all is `und`. Repeated rows are predicted each; an id with several rows is learnt from in each. Ties
go to the language first in order. Texts are used whole. Only the id, the text and, for the fit, the language are read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import fold, in_slices

HELD_OUT = 0
SEGMENT = 128
# Bounds of the sample that the network is fitted on.
FIT_LANGUAGES, FIT_ROWS, FIT_SEGMENTS = 100, 1500, 3
LANES = 2048
LETTER = r"\p{L}"

_FOLD = np.arange(256)
_FOLD[65:91] += 32


@dataclass
class Network:
    """Weights of both directions (first axis): of the bytes, of the state, of the state in the new value; and of the softmax."""

    languages: list[str]
    bytes_in: np.ndarray
    state: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @property
    def size(self) -> int:
        return self.state.shape[1]

    @staticmethod
    def start(languages: list[str], size: int) -> Network:
        rng = np.random.default_rng(11)
        bytes_in = rng.normal(0, 0.3, (2, 256, 3 * size))
        # The keeping gate starts towards keeping.
        bytes_in[:, :, :size] += 1
        out = rng.normal(0, 0.2, (2 * size, len(languages)))
        weights = (bytes_in, rng.normal(0, size**-0.5, (2, size, 3 * size)), out, np.zeros(len(languages)))
        return Network(languages, *[w.astype(np.float32) for w in weights])

    def weights(self) -> list[np.ndarray]:
        return [self.bytes_in, self.state, self.out, self.bias]

    def probabilities(self, read: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Sums over the positions of each segment; `read[d, t]` are the bytes that direction d reads at step t, per segment."""
        steps, lanes, size = read.shape[1], read.shape[2], self.size
        gate_in, new_in = (np.ascontiguousarray(self.bytes_in[:, :, c]) for c in (slice(2 * size), slice(2 * size, None)))
        gate_state, new_state = (np.ascontiguousarray(self.state[:, :, c]) for c in (slice(2 * size), slice(2 * size, None)))
        # The gates are sigmoids, as tanh of half the sum; the new value is a tanh.
        gate_in, gate_state = gate_in * np.float32(0.5), gate_state * np.float32(0.5)
        h, states = np.zeros((2, lanes, size), np.float32), np.empty((2, steps, lanes, size), np.float32)
        gates, new = np.empty((2, lanes, 2 * size), np.float32), np.empty((2, lanes, size), np.float32)
        for t in range(steps):
            np.matmul(h, gate_state, out=gates)
            for d in (0, 1):
                gates[d] += gate_in[d].take(read[d, t], axis=0)
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            np.matmul(h, new_state, out=new)
            new *= gates[:, :, size:]
            for d in (0, 1):
                new[d] += new_in[d].take(read[d, t], axis=0)
            np.tanh(new, out=new)
            h -= new
            h *= gates[:, :, :size]
            h += new
            states[:, t] = h
        return self._pooled(states, lengths)

    def _pooled(self, states: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        _, steps, lanes, size = states.shape
        parts = [(states[d].reshape(-1, size) @ self.out[d * size : (d + 1) * size]).reshape(steps, lanes, -1) for d in (0, 1)]
        logits = parts[0] + positions_from_the_end(parts[1], lengths) + self.bias
        made = np.exp(logits - logits.max(axis=2, keepdims=True))
        made *= (np.arange(steps)[:, None] < lengths)[:, :, None] / made.sum(axis=2, keepdims=True)
        return made.sum(axis=0)


def positions_from_the_end(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Values by position, of values by step from the end of each segment (and back)."""
    place = np.maximum(lengths - 1 - np.arange(len(values))[:, None], 0)
    return np.take_along_axis(values, place[:, :, None], axis=0)


def reading(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """[direction, step, segment]: the bytes of each segment from its start and from its end."""
    step = np.arange(lengths.max(initial=0))[:, None]
    ahead = np.minimum(step, np.maximum(lengths - 1, 0))
    return np.stack([data[starts + ahead], data[starts + np.maximum(lengths - 1 - step, 0)]])


def segments(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length) of the segments of texts with these numbers of bytes, lying one after the other."""
    parts = -(-sizes // SEGMENT)
    text = np.repeat(np.arange(len(sizes)), parts)
    k = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    low, high = (sizes[text] * (k + e) // parts[text] for e in (0, 1))
    return text, (np.cumsum(sizes) - sizes)[text] + low, high - low


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, A-Z as a-z, and the number of each."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = b"".join(texts.cast(pa.binary()).to_pylist())
    return _FOLD[np.frombuffer(joined, np.uint8)].astype(np.uint8), sizes


def predict(network: Network, texts: pa.Array) -> np.ndarray:
    """Mean probabilities of the languages, per text; zero for empty texts."""
    data, sizes = text_bytes(texts)
    text, starts, lengths = segments(sizes)
    order = np.argsort(lengths, kind="stable")
    total = np.zeros((len(texts), len(network.languages)))
    for i in range(0, len(order), LANES):
        lanes = order[i : i + LANES]
        np.add.at(total, text[lanes], network.probabilities(reading(data, starts[lanes], lengths[lanes]), lengths[lanes]))
    return total / np.maximum(sizes, 1)[:, None]


def gradients(network: Network, read: np.ndarray, lengths: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Loss of a batch of segments and its gradients, by backpropagation through time."""
    size, (_, steps, lanes) = network.size, read.shape
    h = np.zeros((2, lanes, size), np.float32)
    kept, before = [], [h]
    for t in range(steps):
        a = np.stack([network.bytes_in[d][read[d, t]] for d in (0, 1)])
        g = h @ network.state
        gates = 0.5 + 0.5 * np.tanh(0.5 * (a[:, :, : 2 * size] + g[:, :, : 2 * size]))
        z, r = gates[:, :, :size], gates[:, :, size:]
        new = np.tanh(a[:, :, 2 * size :] + r * g[:, :, 2 * size :])
        kept.append((z, r, new, g[:, :, 2 * size :]))
        h = new + z * (h - new)
        before.append(h)
    ahead, back = np.stack([b[0] for b in before[1:]]), positions_from_the_end(np.stack([b[1] for b in before[1:]]), lengths)
    both = np.concatenate([ahead, back], axis=2)
    logits = both @ network.out + network.bias
    made = np.exp(logits - logits.max(axis=2, keepdims=True))
    made /= made.sum(axis=2, keepdims=True)
    inside = (np.arange(steps)[:, None] < lengths) * weight / lengths
    inside = (inside / inside.sum()).astype(np.float32)
    loss = float(-(np.log(made[:, np.arange(lanes), label] + 1e-9) * inside).sum())
    made[:, np.arange(lanes), label] -= 1
    made *= inside[:, :, None]
    d_out, d_bias = both.reshape(-1, 2 * size).T @ made.reshape(-1, made.shape[2]), made.sum(axis=(0, 1))
    d_both = made @ network.out.T
    late = np.where((np.arange(steps)[:, None] < lengths)[:, :, None], positions_from_the_end(d_both[:, :, size:], lengths), 0)
    d_states = np.stack([d_both[:, :, :size], late])
    d_h, d_state = np.zeros((2, lanes, size), np.float32), np.zeros_like(network.state)
    d_in = np.empty((2, steps, lanes, 3 * size), np.float32)
    for t in reversed(range(steps)):
        z, r, new, g = kept[t]
        d_h = d_h + d_states[:, t]
        d_new = d_h * (1 - z) * (1 - new * new)
        d_in[:, t, :, :size] = d_h * (before[t] - new) * z * (1 - z)
        d_in[:, t, :, size : 2 * size] = d_new * g * r * (1 - r)
        d_in[:, t, :, 2 * size :] = d_new
        d_g = d_in[:, t].copy()
        d_g[:, :, 2 * size :] *= r
        d_state += before[t].transpose(0, 2, 1) @ d_g
        d_h = d_h * z + d_g @ network.state.transpose(0, 2, 1)
    d_bytes = np.zeros_like(network.bytes_in)
    for d in (0, 1):
        order = np.argsort(read[d].ravel(), kind="stable")
        values = read[d].ravel()[order]
        first = np.flatnonzero(np.diff(values, prepend=-1))
        d_bytes[d, values[first]] = np.add.reduceat(d_in[d].reshape(-1, 3 * size)[order], first, axis=0)
    return loss, [d_bytes, d_state, d_out, d_bias]


def train(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, label: np.ndarray, languages: list[str], size: int = 12, rounds: int = 150, batch: int = 128, rate: float = 0.03
) -> Network:
    """Fit on segments of `data`; the rate falls to nothing over the rounds."""
    network = Network.start(languages, size)
    share = np.bincount(label, minlength=len(languages))
    weight = (1 / np.maximum(share, 1))[label]
    rng = np.random.default_rng(5)
    first, second = ([np.zeros_like(w) for w in network.weights()] for _ in range(2))
    for step in range(1, rounds + 1):
        picked = rng.choice(len(label), min(batch, len(label)), replace=False, p=weight / weight.sum())
        _, found = gradients(network, reading(data, starts[picked], lengths[picked]), lengths[picked], label[picked], np.ones(len(picked)))
        norm = np.sqrt(sum(float((g * g).sum()) for g in found))
        for w, g, m, v in zip(network.weights(), found, first, second, strict=True):
            g *= min(1, 1 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (1 - step / rounds) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return network


def sample(docs: DataFrame, lang: str) -> DataFrame:
    """(lang, piece): the segments that the network is fitted on. The number of rows is bounded, whatever the table's size."""
    usable = docs.where(F.col("doc_id").isNotNull() & F.col(lang).isNotNull() & F.col("text").rlike(LETTER) & (fold() != HELD_OUT))
    usable = usable.select("doc_id", F.col(lang).cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = usable.groupBy("lang").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "lang").limit(FIT_LANGUAGES)
    # Hashes below this share of their range are about twice the rows wanted; so few are ordered, whatever a language has.
    likely = usable.join(F.broadcast(counts), "lang").where(F.shiftrightunsigned(F.xxhash64("doc_id"), 1) < F.least(F.lit(1.0), 2.0 * FIT_ROWS / F.col("rows")) * 2.0**63)
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    picked = likely.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= FIT_ROWS)

    def work(texts: pa.Array, others: dict[str, pa.Array]) -> dict[str, object]:
        data, sizes = text_bytes(texts)
        text, starts, lengths = segments(sizes)
        parts = np.bincount(text, minlength=len(texts))
        k = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        # The first segment of every FIT_SEGMENTS-th of a text.
        part = k * FIT_SEGMENTS // parts[text]
        new = np.flatnonzero((k == 0) | (np.diff(part, prepend=-1) != 0))
        pieces = [data[s : s + n].tobytes() for s, n in zip(starts[new].tolist(), lengths[new].tolist(), strict=True)]
        return {"lang": others["lang"].take(pa.array(text[new])), "piece": pieces}

    return in_slices(picked, ["lang", "text"], "lang string, piece binary", work)


def _fit(found: pa.Table) -> Network | None:
    if not found.num_rows:
        return None
    # Rows come in any order; sorted, the fit is the same every time.
    found = found.sort_by([("lang", "ascending"), ("piece", "ascending")])
    names, pieces = found["lang"].to_pylist(), found["piece"].to_pylist()
    languages = sorted(set(names))
    number = {name: k for k, name in enumerate(languages)}
    label, lengths = np.array([number[n] for n in names]), np.array([len(p) for p in pieces], np.int64)
    return train(np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(lengths) - lengths, lengths, label, languages)


def fit_languages(docs: DataFrame, lang: str = "lang") -> Network | None:
    """The network, fitted in one task on the bounded sample; None if there is nothing to learn from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _fit(pa.Table.from_batches(list(batches), pa.schema([("lang", pa.string()), ("piece", pa.binary())])))
        if made is not None:
            yield pa.RecordBatch.from_pydict({"network": pa.array([pickle.dumps((made.languages, *made.weights()))], pa.binary())})

    rows = sample(docs, lang).repartition(1).mapInArrow(run, "network binary").collect()
    return Network(*pickle.loads(rows[0].network)) if rows else None


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score; one row per row of `docs`."""

    def work(texts: pa.Array, others: dict[str, pa.Array]) -> dict[str, object]:
        if network is None:
            return {"doc_id": others["doc_id"], "held_out": others["held_out"], "lang_pred": ["und"] * len(texts), "score": np.zeros(len(texts))}
        lettered = others["lettered"].to_numpy(zero_copy_only=False)
        made = predict(network, pc.if_else(others["lettered"], texts, ""))
        best = made.argmax(axis=1)
        names = [network.languages[k] if ok else "und" for k, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
        return {"doc_id": others["doc_id"], "held_out": others["held_out"], "lang_pred": names, "score": np.where(lettered, made.max(axis=1, initial=0), 0.0).clip(0, 1)}

    marked = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"),
        F.coalesce(F.col("text").rlike(LETTER), F.lit(False)).alias("lettered"), "text",
    )
    return in_slices(marked, ["doc_id", "held_out", "lettered", "text"], "doc_id bigint, held_out boolean, lang_pred string, score double", work)
