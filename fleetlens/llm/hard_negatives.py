"""Hard negatives: for every anchor and positive, the best-scoring rows of other labels within a window below the positive.

Method. A threshold join in the manner of L2AP, on blocks of rows. Components of a block are put in order of their weight and read
in strips; the norm of what is left of a vector after each strip is known. The inverted index of a block holds, strip by strip, the
rows whose remaining norm times an anchor's norm can still reach the threshold; components behind that are not in it (the
suffix-norm bound). Partial scores are added up strip by strip, and a row leaves the lists when, for all anchors, its partial score
and the product of the remaining norms stay below the threshold. What is left is verified on the components not indexed. Thresholds
start high and are lowered until the windows (an anchor's positives, or the negatives of a positive) are full.

Flow. Rows are dealt over blocks by the hash of their id, whatever their label, so that copies and frequent labels spread. Every
anchor first searches its own block: the score that fills its window there is a lower bound for all blocks. Then blocks and chunks
of anchors meet, each pair in a task of its own, and give at most a full window per anchor back. That is done for the positives,
then for the negatives, whose windows lie in [percent of the positive's score, the positive's score].

Defined cases. Rows with a NULL id, label or vector, or with a NULL or non-finite component, before or after scaling, take no part.
Vectors of different lengths are filled up with zeros. Repeated rows are rows of their own, each returned; an anchor's positives are
rows with another id than its own. Anchors that are equal in id, label and vector count once, different ones under one id each.
Ties go to the smaller id. Windows above their top (positives with a negative score) are empty. Scores are exact up to 2^53; beyond
they are rounded as doubles and held within a long. An empty table gives no rows. Only id, label and vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import stored

STRIP = 8
# Levels of the threshold, in shares of the highest possible score, before the lowest one allowed.
LEVELS = (0.8, 0.6, 0.4, 0.2)
# Scores that a task holds at once.
CELLS = 1 << 21
ANCHOR = ("anchor_id", "variant")
HIGHEST = float(2**63 - 1024)


@dataclass(frozen=True)
class Rule:
    """Components are floor(scale * x); each anchor has `positives`, each of them `negatives` from `percent` of its score on."""

    scale: int = 256
    positives: int = 5
    negatives: int = 5
    percent: int = 80
    # A block has a 64th of the rows within these bounds; a chunk of anchors has `chunk`.
    least: int = 1024
    most: int = 65536
    chunk: int = 65536


def matrix(column: pa.Array, scale: int) -> np.ndarray:
    """Scaled vectors as rows, the shorter ones filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = column.offsets.to_numpy().astype(np.int64)
    sizes, values = np.diff(ends), column.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    out = np.zeros((len(column), sizes.max(initial=0)))
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(values)) - np.repeat(ends[:-1] - ends[0], sizes)] = np.floor(scale * values.astype(float))
    return out


class Block:
    """Rows in strips of their components, with the norms of what is left after each strip."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.argsort(-np.square(vectors).sum(axis=0), kind="stable")
        self.vectors = vectors[:, self.order]
        self.cuts = list(range(0, vectors.shape[1], STRIP))
        self.rest = self.norms(self.vectors)

    def norms(self, vectors: np.ndarray) -> np.ndarray:
        """Norm from each strip on; nothing is left after the last. A little is added for what rounding takes away."""
        squares = np.square(vectors).sum(axis=1)[:, None] if not self.cuts else np.add.reduceat(np.square(vectors), self.cuts, axis=1)
        left = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
        return np.column_stack([np.sqrt(left) * (1 + 1e-9), np.zeros(len(vectors))])

    def reaching(self, anchors: np.ndarray, level: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, anchor, score) of all allowed pairs whose score is at least the anchor's level."""
        norms = self.norms(anchors)
        scores = np.zeros((len(self.vectors), len(anchors)))
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(level <= 0, -np.inf, level / norms[:, 0]).min(initial=np.inf)
        # Strips of a row that the index holds: those from which on its norm can reach a level.
        depth = (self.rest[:, :-1] >= least).sum(axis=1)
        live = np.flatnonzero((depth > 0) & allowed.any(axis=1))
        found = []
        for k, start in enumerate(self.cuts):
            strip = slice(start, start + STRIP)
            scores[live] += self.vectors[live, strip] @ anchors[:, strip].T
            can = (scores[live] + self.rest[live, k + 1, None] * norms[:, k + 1] >= level) & allowed[live]
            ended = depth[live] == k + 1
            row, anchor = np.nonzero(can & ended[:, None])
            found.append((live[row], anchor, np.full(len(row), start + STRIP)))
            live = live[can.any(axis=1) & ~ended]
        row, anchor, done = (np.concatenate(f) for f in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        score = scores[row, anchor]
        for start in self.cuts[1:]:
            open_ = np.flatnonzero(done <= start)
            score[open_] += np.einsum("ij,ij->i", self.vectors[row[open_], start : start + STRIP], anchors[anchor[open_], start : start + STRIP])
        kept = score >= level[anchor]
        return row[kept], anchor[kept], np.clip(score[kept], -HIGHEST, HIGHEST)

    def fill(
        self, anchors: np.ndarray, tops: np.ndarray, lows: np.ndarray, size: int, ids: np.ndarray, allowed: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """(row, anchor, score, window) of the first `size` allowed rows of each window [low, top] of each anchor."""
        full = tops < lows
        bound = np.minimum(tops.max(axis=1, initial=-np.inf), self.norms(anchors)[:, 0] * self.rest[:, 0].max(initial=0))
        for share in (*LEVELS, None):
            asked = np.flatnonzero(~full.all(axis=1))
            if not len(asked):
                return
            low = np.where(full, np.inf, lows).min(axis=1)[asked]
            level = low if share is None else np.where(bound[asked] > 0, np.maximum(low, share * bound[asked]), low)
            row, anchor, score = self.reaching(anchors[asked], level, allowed[:, asked])
            anchor = asked[anchor]
            order = np.lexsort((ids[row], -score, anchor))
            row, anchor, score = row[order], anchor[order], score[order]
            at_end = np.zeros(len(anchors), bool)
            at_end[asked] = level <= low
            for w in range(tops.shape[1]):
                inside = (score <= tops[anchor, w]) & (score >= lows[anchor, w]) & ~full[anchor, w]
                r, a, s = row[inside], anchor[inside], score[inside]
                place = np.arange(len(a)) - np.searchsorted(a, a, "left")
                first = place < size
                done = (np.bincount(a[first], minlength=len(anchors)) == size) | at_end
                out = first & done[a]
                yield r[out], a[out], s[out], w
                full[done, w] = True


def search(rows: pa.Table, asked: pa.Table, rule: Rule, same: bool, size: int) -> pa.Table:
    """The first `size` rows of each window of the `asked` anchors, of the same label and another id or of other labels."""
    vectors, anchors = matrix(rows["vec"], rule.scale), matrix(asked["vec"], rule.scale)
    wide = max(vectors.shape[1], anchors.shape[1])
    vectors, anchors = (np.pad(v, ((0, 0), (0, wide - v.shape[1]))) for v in (vectors, anchors))
    block = Block(vectors)
    anchors = anchors[:, block.order]
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    own, own_labels = asked["anchor_id"].to_numpy(), asked["label"].to_numpy()
    windows = max(asked["tops"].combine_chunks().value_lengths().to_pylist(), default=0)
    # Windows that an anchor does not have lie above their top.
    tops, lows = np.full((len(asked), windows), -np.inf), np.full((len(asked), windows), np.inf)
    for out, name in ((tops, "tops"), (lows, "lows")):
        column = asked[name].combine_chunks()
        sizes = column.value_lengths().to_numpy()
        out[np.arange(windows) < sizes[:, None]] = column.flatten().to_numpy()
    found = []
    step = max(1, CELLS // max(1, len(ids)))
    for i in range(0, len(asked), step):
        part = slice(i, i + step)
        allowed = labels[:, None] == own_labels[part]
        allowed = allowed & (ids[:, None] != own[part]) if same else ~allowed
        for r, a, s, w in block.fill(anchors[part], tops[part], lows[part], size, ids, allowed):
            found.append((r, a + i, s, np.full(len(r), w)))
    row, anchor, score, window = (np.concatenate(f) for f in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 4
    score = score.astype(np.int64)
    return pa.table({"anchor_id": own[anchor], "variant": asked["variant"].to_numpy()[anchor], "place": window.astype(np.int64) + 1, "vec_id": ids[row], "score": score})


FOUND = "anchor_id bigint, variant bigint, place bigint, vec_id bigint, score bigint"


def meet(rows: DataFrame, asked: DataFrame, by: list[str], rule: Rule, same: bool, size: int) -> DataFrame:
    """Every anchor's windows in the blocks that it meets: (anchor_id, variant, place of the window, vec_id, score)."""

    def work(block: pa.Table, anchors: pa.Table) -> pa.Table:
        return search(block, anchors, rule, same, size)

    return rows.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(work, FOUND)


def mine(vectors: DataFrame, anchors: Column, rule: Rule = Rule()) -> DataFrame:
    """Hard negatives of the rows that meet the condition `anchors`, among all rows of (vec_id, label, vec)."""
    sound = ~F.exists("vec", lambda x: x.isNull() | F.isnan(rule.scale * x) | (F.abs(rule.scale * x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), F.col("vec").cast("array<double>").alias("vec"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & sound)
    rows = stored(rows.select("vec_id", "label", F.col("vec").cast(vectors.schema["vec"].dataType).alias("vec")), "vectors")
    n = rows.count()
    blocks = max(1, -(-n // min(rule.most, max(rule.least, n // 64))))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    asked = rows.where(anchors).withColumn("variant", F.xxhash64("label", "vec")).dropDuplicates(["vec_id", "variant"]).withColumnRenamed("vec_id", "anchor_id")
    asked = stored(asked, "anchors")
    chunks = max(1, -(-asked.count() // rule.chunk))
    spread = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint"))))
    chunk = F.pmod(F.xxhash64(F.lit(1), "anchor_id"), F.lit(chunks)).alias("chunk")

    def windows_of(asked: DataFrame, same: bool, size: int, name: str) -> DataFrame:
        """The first `size` rows of each window of `asked` (place, tops, lows), over all blocks."""
        home = meet(rows, asked, ["block"], rule, same, size)
        full = home.groupBy(*ANCHOR, "place").agg(F.count("*").alias("c"), F.min("score").alias("low")).where(F.col("c") == size)
        raised = full.groupBy(*ANCHOR).agg(F.map_from_entries(F.collect_list(F.struct("place", F.col("low").cast("double")))).alias("raised"))
        better = F.transform("lows", lambda low, k: F.greatest(low, F.coalesce(F.element_at("raised", k.cast("bigint") + 1), low)))
        known = asked.join(raised, list(ANCHOR), "left").select(*ANCHOR, "label", "vec", "tops", F.coalesce(better, "lows").alias("lows"), chunk)
        everywhere = stored(known, name).withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
        found = meet(spread, everywhere, ["block", "chunk"], rule, same, size)
        first = Window.partitionBy(*ANCHOR, "place").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= size)

    unbounded = [F.array(F.lit(float(v))).alias(name) for v, name in (("inf", "tops"), ("-inf", "lows"))]
    positives = windows_of(asked.select("*", *unbounded), True, rule.positives, "positives")
    positives = stored(positives.select(*ANCHOR, F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "windows")
    low = F.ceil(F.col("positive_score").cast("decimal(20,0)") * rule.percent / 100).cast("double")
    entries = F.array_sort(F.collect_list(F.struct(F.col("place"), F.col("positive_score").cast("double").alias("top"), low.alias("low"))))
    windows = positives.groupBy(*ANCHOR).agg(entries.alias("e")).select(*ANCHOR, F.expr("e.top").alias("tops"), F.expr("e.low").alias("lows"))
    negatives = windows_of(asked.join(windows, list(ANCHOR)), False, rule.negatives, "negatives")
    return negatives.join(positives, [*ANCHOR, "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
