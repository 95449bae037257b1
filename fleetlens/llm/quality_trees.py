"""Quality rules: boosted trees over document statistics, scored from flat node arrays.

Method. Each text becomes one row of statistics. Gradient boosting with logistic loss grows small trees over histograms of
those statistics; for chosen statistics a split is only allowed if the score moves in the stated direction, and the bounds of
the children keep that true below. The trees are flattened into arrays (feature, threshold, left, right, value), and scoring
walks all rows of a batch down all trees with array indexing.

Defined cases. NULL and empty texts have all statistics 0 and fail the base rule. Repeated rows each get their own, equal
result. NULL ids pass through. Without labels of both classes the trees are empty and every text that the base rule passes is
kept. Only `doc_id` and `text` are read, so further columns cannot clash. Texts are used whole; a text longer than a slice is a
slice of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from fleetlens.llm.common import Words, byte_texts, in_slices, keep_rows, labelled_sample, mix, sorted_distinct, window_hashes

# At most so many labelled documents are used to fit the trees.
FIT_ROWS = 20_000
HELD_OUT = 0
# Below this probability of good quality a document is rejected.
KEEP_SCORE = 0.3

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS = b"0123456789"

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Statistics the trees see, and the direction in which the score may move: 0 is free.
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1,
    "mark_share": -1, "adjacent_share": -1, "distinct_share": 0, "digit_share": 0, "symbol_word_share": -1,
}


def statistics(column: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The base counts by name, and the matrix of FEATURES, one row per text."""
    words, texts = Words(column), byte_texts(column)
    n, doc, rows, kinds = words.counts, words.doc, len(texts), max(1, len(words.dictionary))
    length = pc.utf8_length(words.dictionary).to_numpy(zero_copy_only=False)
    odd = np.fromiter((not w.translate(None, _NOT_LETTERS) for w in words.words), bool, len(words.dictionary))

    def per_doc(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=values, minlength=rows).astype(np.int64)

    chars = per_doc(length[words.codes]) if len(doc) else np.zeros(rows, np.int64)
    wordless = per_doc(odd[words.codes]) if len(doc) else np.zeros(rows, np.int64)
    size = np.fromiter((len(t) for t in texts), np.int64, rows)
    without = {
        name: size - np.fromiter((len(t.translate(None, cut)) for t in texts), np.int64, rows)
        for name, cut in (("symbols", SYMBOLS), ("upper", UPPER), ("letters", LETTERS), ("digits", DIGITS), ("marks", b"!?"))
    }
    lines = np.zeros((2, rows), np.int64)
    for i, text in enumerate(texts):
        spoken = [line for line in text.split(b"\n") if line.strip(b" \t\n\v\f\r")]
        lines[:, i] = len(spoken), len(spoken) - len(set(spoken))
    same = np.zeros(len(doc), bool)
    same[1:] = (words.codes[1:] == words.codes[:-1]) & (doc[1:] == doc[:-1])
    distinct = np.bincount(sorted_distinct(doc * kinds + words.codes) // kinds, minlength=rows)
    base = {"n_words": n, "word_chars": chars, "n_symbols": without["symbols"], "n_dup_lines": lines[1], "n_repeat_words": repeated(words, rows)}
    some = np.maximum(n, 1)
    matrix = np.column_stack([
        np.log1p(n), chars / some, without["symbols"] / np.maximum(size, 1), lines[1] / np.maximum(lines[0], 1),
        base["n_repeat_words"] / some, without["upper"] / np.maximum(without["letters"], 1), without["marks"] / some,
        (per_doc(same) if len(doc) else 0 * n) / some, distinct / some, without["digits"] / np.maximum(size, 1), wordless / some,
    ])
    return base, matrix


_NOT_LETTERS = bytes(b for b in range(256) if b not in LETTERS + DIGITS)


def repeated(words: Words, rows: int, size: int = 5) -> np.ndarray:
    """Per text, the words that lie in windows of `size` words which occur more than once in it."""
    at = words.windows(size)
    if not len(at):
        return np.zeros(rows, np.int64)
    # A window and its text in one number: equal numbers are equal windows of the same text.
    values = mix(window_hashes(words.hashes()[words.codes], at, size) ^ mix(words.doc[at].astype(np.uint64)))
    order = np.sort(values)
    twice = sorted_distinct(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return np.zeros(rows, np.int64)
    place = np.minimum(np.searchsorted(twice, values), len(twice) - 1)
    hit = at[twice[place] == values]
    change = np.zeros(len(words.codes) + 1, np.int64)
    np.add.at(change, hit, 1)
    np.add.at(change, hit + size, -1)
    covered = np.cumsum(change[:-1]) > 0
    return np.bincount(words.doc, weights=covered, minlength=rows).astype(np.int64)


@dataclass
class Trees:
    """Flat trees: node arrays of all trees one after the other; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_trees(
    x: np.ndarray, y: np.ndarray, directions: list[int], trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 64,
    smallest: int = 20, ridge: float = 1.0,
) -> Trees:
    """Boosted trees for labels 0 and 1; `directions` holds -1, 0 or 1 for each column of `x`."""
    nodes: list[list[float]] = []
    roots: list[int] = []
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
    start = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        empty = np.zeros(0, np.int64)
        return Trees(empty, np.zeros(0), empty, empty, np.zeros(0), empty, depth, 30.0)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    margin = np.full(len(y), start)

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        me = len(nodes)
        leaf = float(np.clip(g[rows].sum() / (h[rows].sum() + ridge), low, high))
        nodes.append([0, np.inf, me, me, leaf * rate])
        if level == 0 or len(rows) < 2 * smallest:
            return me
        best = (1e-6, -1, 0, 0.0, 0.0)
        all_g, all_h = g[rows].sum(), h[rows].sum()
        for j, e in enumerate(edges):
            if not len(e):
                continue
            b = binned[rows, j]
            hist = [np.cumsum(np.bincount(b, weights=w, minlength=len(e) + 1))[:-1] for w in (g[rows], h[rows], np.ones(len(rows)))]
            gl, hl, nl = hist
            vl = np.clip(gl / (hl + ridge), low, high)
            vr = np.clip((all_g - gl) / (all_h - hl + ridge), low, high)
            gain = gl**2 / (hl + ridge) + (all_g - gl) ** 2 / (all_h - hl + ridge) - all_g**2 / (all_h + ridge)
            allowed = (nl >= smallest) & (len(rows) - nl >= smallest) & (directions[j] * (vr - vl) >= 0)
            gain = np.where(allowed, gain, 0)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), j, k, float(vl[k]), float(vr[k]))
        if best[1] < 0:
            return me
        _, j, k, vl, vr = best
        goes = binned[rows, j] <= k
        middle = (vl + vr) / 2
        bounds = {0: (low, high, low, high), 1: (low, middle, middle, high), -1: (middle, high, low, middle)}[directions[j]]
        left = grow(rows[goes], g, h, level - 1, *bounds[:2])
        right = grow(rows[~goes], g, h, level - 1, *bounds[2:])
        nodes[me] = [j, float(edges[j][k]), left, right, 0.0]
        return me

    every = np.arange(len(y))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        roots.append(grow(every, y - p, p * (1 - p), depth, -4.0, 4.0))
        made = flat(nodes, roots[-1:], depth, 0.0)
        margin += made.margin(x)
    return flat(nodes, roots, depth, start)


def flat(nodes: list[list[float]], roots: list[int], depth: int, start: float) -> Trees:
    a = np.array(nodes, dtype=np.float64)
    ints = [a[:, k].astype(np.int64) for k in (0, 2, 3)]
    return Trees(ints[0], a[:, 1], ints[1], ints[2], a[:, 4], np.array(roots, np.int64), depth, start)


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Trees:
    """Fit on a bounded sample of labelled documents; only its statistics reach the driver."""
    sample = labelled_sample(docs, labels, "quality", HELD_OUT, fit_rows).select("label", "text")
    schema = "label int, " + ", ".join(f"{c} double" for c in FEATURES)

    def work(texts: pa.Array, others: dict[str, pa.Array]) -> dict[str, object]:
        _, matrix = statistics(texts)
        return {"label": others["label"], **{c: matrix[:, j] for j, c in enumerate(FEATURES)}}

    got = in_slices(sample, ["label", "text"], schema, work).toPandas().sort_values(list(FEATURES)).to_numpy(np.float64)
    return fit_trees(got[:, 1:], got[:, 0], list(FEATURES.values()))


def failed(base: dict[str, np.ndarray]) -> np.ndarray:
    return (base["n_words"] < 10) | (100 * base["n_repeat_words"] > 20 * base["n_words"])


def judge(texts: pa.Array, trees: Trees) -> dict[str, np.ndarray]:
    base, matrix = statistics(texts)
    score = trees.score(matrix)
    bad = failed(base)
    return {**base, "base_failed": bad, "kept": ~bad & (score >= KEEP_SCORE), "quality": score}


def quality_rules(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the trees' probability of good quality."""
    schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in BASE) + ", base_failed boolean, kept boolean, quality double"
    return in_slices(docs, ["doc_id", "text"], schema, lambda texts, others: {"doc_id": others["doc_id"], **judge(texts, trees)})


def keep_good(docs: DataFrame, trees: Trees) -> DataFrame:
    """The rows of `docs` that the rules keep."""
    return keep_rows(docs, lambda texts: judge(texts, trees)["kept"])
