"""Quality classifier: naive Bayes log-count ratios as feature scales of a linear support vector machine.

Method. A text becomes a set of n-gram indicators: words, pairs of words, word shapes, pairs of shapes, and steps of the share of
words that repeat the word before. Indicators are hashed into a fixed number of buckets. The ratio of each bucket is the log of
its smoothed share among good and among bad documents; every indicator is scaled by it and divided by the root of the text's
number of indicators. Dual coordinate descent fits the hinge loss (L2-regularised, labels weighted for balance) on four fifths of
a bounded labelled sample; the rest turns margins into probabilities by a logistic curve.

Defined cases. NULL and empty texts have no indicators and get the score of margin 0. Repeated rows get equal scores. NULL ids are
in no fold (`held_out` false) and are scored. Without labels of both classes every score is the share of good labels (0.5 without
any). Only `doc_id` and `text` are read from the documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import Words, fold, hashes, in_slices, keep_rows, labelled_sample, mix, seed, sorted_distinct

FIT_ROWS = 10_000
HELD_OUT = 0
GOOD_SCORE = 0.3
BUCKET_BITS = 18
SHAPES = bytes(
    ord("A") if 65 <= b < 91 else ord("a") if 97 <= b < 123 or b > 127 else ord("0") if 48 <= b < 58 else b for b in range(256)
)
RUN = re.compile(rb"(.)\1+", re.S)


def indicators(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs, sorted by text."""
    words = Words(texts)
    if not len(words.codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    seen = words.words
    plain = hashes([w.lower() for w in seen])
    shape = hashes([RUN.sub(rb"\1", w.translate(SHAPES)) for w in seen], 1)
    shift = np.uint64(64 - BUCKET_BITS)
    rows, buckets = [], []

    def add(doc: np.ndarray, values: np.ndarray) -> None:
        rows.append(doc)
        buckets.append((mix(values) >> shift).astype(np.int64))

    w, s = plain[words.codes], shape[words.codes]
    pairs = words.windows(2)
    add(words.doc, w)
    add(words.doc, s)
    add(words.doc[pairs], mix(w[pairs] ^ seed(1)) + w[pairs + 1])
    add(words.doc[pairs], mix(s[pairs] ^ seed(2)) + s[pairs + 1])
    again = np.bincount(words.doc[pairs], weights=w[pairs] == w[pairs + 1], minlength=len(texts))
    share = np.ceil(10 * again / np.maximum(words.counts, 1)).astype(np.uint64)
    spoken = np.flatnonzero(words.counts)
    add(spoken, share[spoken] + seed(3))
    key = sorted_distinct((np.concatenate(rows) << BUCKET_BITS) | np.concatenate(buckets))
    return key >> BUCKET_BITS, key & ((1 << BUCKET_BITS) - 1)


@dataclass
class NbSvm:
    """Bucket weights (ratio times hyperplane), and the curve from margin to probability."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, texts: pa.Array) -> np.ndarray:
        doc, bucket = indicators(texts)
        return margins(doc, self.weights[bucket], len(texts)) + self.bias

    def score(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(texts) + self.offset, -30, 30)))


def margins(doc: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    size = np.bincount(doc, minlength=rows)
    return np.bincount(doc, weights=values, minlength=rows) / np.sqrt(np.maximum(size, 1))


def ratios(bags: list[np.ndarray], y: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """Log-count ratio of every bucket; a bag holds distinct buckets."""
    counts = np.full((2, 1 << BUCKET_BITS), smoothing)
    for bag, label in zip(bags, y, strict=True):
        counts[label, bag] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def descend(bags: list[np.ndarray], r: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; a row's values, its ratios over the root of its size, are made when it is visited."""
    sign = np.where(y == 1, 1.0, -1.0)
    root = np.sqrt([max(len(bag), 1) for bag in bags])
    alpha = np.zeros(len(y))
    w, bias = np.zeros(1 << BUCKET_BITS), 0.0
    # A constant 1 stands for the bias.
    norm = np.array([r[bag] @ r[bag] for bag in bags]) / root**2 + 1
    random = np.random.default_rng(7)
    for _ in range(rounds):
        for i in random.permutation(len(y)):
            v = r[bags[i]] / root[i]
            slope = sign[i] * (w[bags[i]] @ v + bias) - 1
            new = min(max(alpha[i] - slope / norm[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[bags[i]] += step * v
                bias += step
                alpha[i] = new
    return w, bias


def curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with a small ridge."""
    x = np.column_stack([margin, np.ones(len(margin))])
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (p - y) + 0.1 * (theta - [1, 0])
        theta = theta - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2), grad)
        theta[0] = max(theta[0], 0.1)
    return float(theta[0]), float(theta[1])


def fit(bags: list[np.ndarray], y: np.ndarray) -> NbSvm:
    """Fit on the distinct buckets of each text; every fifth text only serves the curve."""
    size = 1 << BUCKET_BITS
    if len(y) < 10 or y.min() == y.max():
        share = np.clip(y.mean(), 0.01, 0.99) if len(y) else 0.5
        return NbSvm(np.zeros(size), 0.0, 1.0, float(np.log(share / (1 - share))))
    test = np.arange(len(y)) % 5 == 4
    learn = [bag for bag, later in zip(bags, test, strict=True) if not later]
    known = y[~test]
    r = ratios(learn, known)
    share = max(known.mean(), 1e-3)
    cost = np.where(known == 1, 0.5 / share, 0.5 / max(1 - share, 1e-3))
    w, bias = descend(learn, r, known, cost)
    weights = (r * w).astype(np.float32)
    margin = np.array([weights[bag].sum(dtype=np.float64) / np.sqrt(max(len(bag), 1)) for bag in bags[4::5]]) + bias
    slope, offset = curve(margin, y[test])
    return NbSvm(weights, bias, slope, offset)


def fit_classifier(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> NbSvm:
    """Fit on a bounded sample of labelled documents outside the held-out fold; tasks make the indicators.

    The driver holds the sample's buckets once, four bytes each.
    """
    sample = labelled_sample(docs, labels, "quality", HELD_OUT, fit_rows)

    def work(texts: pa.Array, others: dict[str, pa.Array]) -> dict[str, object]:
        doc, bucket = indicators(texts)
        ends = np.searchsorted(doc, np.arange(len(texts) + 1))
        packed = [bucket[ends[i] : ends[i + 1]].astype("<i4").tobytes() for i in range(len(texts))]
        return {"doc_id": others["doc_id"], "label": others["label"], "bag": packed}

    got = in_slices(sample, ["doc_id", "label", "text"], "doc_id bigint, label int, bag binary", work).toArrow()
    order = pc.sort_indices(got, [("doc_id", "ascending"), ("bag", "ascending")]).to_numpy()
    order = order[np.random.default_rng(3).permutation(len(order))]
    bags = [np.frombuffer(b.as_buffer(), "<i4") for b in got["bag"]]
    return fit([bags[i] for i in order], got["label"].to_numpy().astype(np.int64)[order])


def classify(docs: DataFrame, model: NbSvm) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    schema = "doc_id bigint, score double"
    scored = in_slices(docs, ["doc_id", "text"], schema, lambda texts, others: {"doc_id": others["doc_id"], "score": model.score(texts)})
    return scored.select(
        "doc_id", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= GOOD_SCORE, 1).otherwise(0).alias("predicted")
    )


def keep_good(docs: DataFrame, model: NbSvm) -> DataFrame:
    """The rows of `docs` that the classifier predicts to be good."""
    return keep_rows(docs, lambda texts: model.score(texts) >= GOOD_SCORE)
