"""LM scoring: a bigram model in Elias-Fano tries, learnt from the corpus and applied to it.

Method. The probability of a token after a context is (count of both + strength * P(token)) / (count of the context + strength),
with P the add-half unigram probability; it sums to one. Counts of tokens and of pairs are dealt over shards by hash. A shard turns
the pairs it was sent into a trie (contexts, monotone pointers, context-relative successors, quantised values; see
`elias_fano`) and answers what was asked. A frequent context is spread over `splits` shards by its successors.

Flow. Documents are packed into blocks of bounded size and stored. A block sends each shard its distinct keys in order, with their
training counts: one row per block and shard, so that a key is at most one entry per block, however frequent. Shards answer with
counts in the same order; the block looks them up and adds up the scores. The number of shards follows the size of the corpus.

Exactness. Tokens are 64-bit hashes of words. Pairs are 40-bit keys inside a shard; with the million or so pairs of a shard, an
unseen pair is taken for a seen one with a chance of about 1e-6. Values above 4,096 are rounded by less than 0.1 per cent.

Defined cases. A NULL or empty text is its end token. NULL ids are in no fold (`held_out` false) and not learnt from. Repeated
rows are learnt from and scored each. Without training rows N and V are 0 and every token has the base probability 1. Texts are
used whole; only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import Words, fold, mix, seed, slices, stored, texts_of
from fleetlens.llm.elias_fano import SUCCESSOR_BITS, Trie, value_of

HELD_OUT = 1
END, START = seed(11), seed(12)
TOKENS, PAIRS, TOTALS = 1, 2, 0


@dataclass(frozen=True)
class Setup:
    strength: float = 100.0
    block_bytes: int = 4 << 20
    splits: int = 16


def packed_blocks(docs: DataFrame, setup: Setup) -> DataFrame:
    """(block, ids, learn, texts): blocks of documents, each column a compressed Arrow array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        names = ["doc_id", "learn", "text"]
        waiting: list[pa.RecordBatch] = []
        held = 0

        def ready() -> pa.RecordBatch:
            nonlocal number, held
            rows = pa.Table.from_batches(waiting).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(rows)
            waiting.clear()
            number, held = number + 1, 0
            return pa.RecordBatch.from_arrays([pa.array([number - 1], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "rows"])

        for batch in batches:
            texts = texts_of(batch.column(2))
            for a, b in slices(texts, max(1, setup.block_bytes // 4)):
                some = texts.slice(a, b - a)
                waiting.append(pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), some], names=names))
                held += pc.sum(pc.binary_length(some)).as_py() or 0
                if held >= setup.block_bytes:
                    yield ready()
        if waiting:
            yield ready()

    learn = F.coalesce(fold() != HELD_OUT, F.lit(False))
    return docs.select("doc_id", learn.alias("learn"), F.col("text").cast("string").alias("text")).mapInArrow(run, "block bigint, rows binary")


class Block:
    """The tokens of a block of documents as numbers into its distinct tokens, and its distinct pairs."""

    def __init__(self, rows: bytes, shards: int, splits: int):
        self.rows = pa.ipc.open_stream(rows).read_all().combine_chunks()
        n = len(self.rows)
        texts = self.rows["text"].combine_chunks() if n else pa.array([], pa.string())
        words = Words(pc.ascii_lower(texts))
        value = np.concatenate([words.hashes(), [END, START]]).astype(np.uint64)
        order = np.argsort(value)
        rank = np.empty(len(value), np.int64)
        rank[order] = np.arange(len(value))
        self.tokens, self.counts = value[order], words.counts + 1
        ends = np.cumsum(self.counts)
        self.end, self.start = rank[-2], rank[-1]
        # Every document: its words, then the end; its contexts: the start, then its words.
        self.code = np.full(int(ends[-1]) if n else 0, self.end)
        inner = np.ones(len(self.code), bool)
        inner[ends - 1] = False
        self.code[inner] = rank[words.codes]
        self.context = np.concatenate([[self.start], self.code[:-1]]) if n else self.code
        self.context[(ends - self.counts)[:n]] = self.start
        self.doc = np.repeat(np.arange(n), self.counts)
        learn = self.rows["learn"].to_numpy().astype(bool) if n else np.zeros(0, bool)
        pair = self.context * len(value) + self.code
        by_pair = np.argsort(pair)
        first = np.diff(pair[by_pair], prepend=-1) != 0
        pairs = pair[by_pair[first]]
        self.pair = np.empty(len(pair), np.int64)
        self.pair[by_pair] = np.cumsum(first) - 1
        learnt = learn[self.doc]
        self.seen = np.bincount(self.code[learnt], minlength=len(value))
        self.pair_seen = np.bincount(self.pair[learnt], minlength=len(pairs))
        # Shards of tokens are ranges of their hashes, so that tokens in order are in the order of shards.
        self.shard = ((self.tokens >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
        before, after = self.tokens[pairs // len(value)], self.tokens[pairs % len(value)]
        spread = mix(before) + (mix(after) >> np.uint64(40)) % np.uint64(splits) * seed(13)
        self.pair_shard = (mix(spread) % np.uint64(shards)).astype(np.int64)
        high = mix(before ^ seed(14)) >> np.uint64(64 - SUCCESSOR_BITS) << np.uint64(SUCCESSOR_BITS)
        self.key = (high | (mix(after ^ mix(before)) >> np.uint64(64 - SUCCESSOR_BITS))).astype(np.int64)
        # The order in which shards are asked: by shard, then key.
        self.asked = np.arange(len(self.tokens))
        self.pair_asked = np.argsort((self.pair_shard << 2 * SUCCESSOR_BITS) | self.key)

    def cuts(self, kind: int, shards: int) -> np.ndarray:
        owner = self.shard[self.asked] if kind == TOKENS else self.pair_shard[self.pair_asked]
        return np.searchsorted(owner, np.arange(shards + 1))


def five_bytes(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def from_five(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<i8").ravel()


ASKED = "shard int, block bigint, kind int, keys binary, counts binary"
ANSWERED = "block bigint, shard int, kind int, found binary"


def ask(blocks: DataFrame, shards: int, setup: Setup) -> DataFrame:
    """What each block asks each shard, with its training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                b = Block(rows, shards, setup.splits)
                out: list[list[object]] = [[] for _ in range(5)]
                for kind, keys, counts in (
                    (TOKENS, b.tokens[b.asked], b.seen[b.asked]), (PAIRS, b.key[b.pair_asked], b.pair_seen[b.pair_asked]),
                ):
                    cuts = b.cuts(kind, shards)
                    for s in np.flatnonzero(np.diff(cuts)):
                        some = slice(cuts[s], cuts[s + 1])
                        packed = keys[some].astype("<u8").tobytes() if kind == TOKENS else five_bytes(keys[some])
                        for column, value in zip(out, (s, number, kind, packed, counts[some].astype("<u4").tobytes()), strict=True):
                            column.append(value)
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["shard", "block", "kind", "keys", "counts"])

    return blocks.select("block", "rows").mapInArrow(run, ASKED)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ones of sorted keys, with the sums of their counts; keys with no count are left out."""
    keys, counts = keys[counts > 0], counts[counts > 0].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def answer(asked: DataFrame) -> DataFrame:
    """Per shard: its counts and its trie from all training counts, then the answers, and one row of totals (V, N)."""

    def group(rows: pa.Table) -> pa.Table:
        shard = rows["shard"][0].as_py()
        out: list[list[object]] = [[], [], [], []]

        def say(block: int, kind: int, found: bytes) -> None:
            for column, value in zip(out, (block, shard, kind, found), strict=True):
                column.append(value)

        for kind in (TOKENS, PAIRS):
            own = rows.filter(pc.equal(rows["kind"], kind))
            blocks = own["block"].to_pylist()
            keys = [np.frombuffer(k, "<u8") if kind == TOKENS else from_five(k) for k in own["keys"].to_pylist()]
            counts = [np.frombuffer(c, "<u4") for c in own["counts"].to_pylist()]
            if not keys:
                continue
            every = np.concatenate(keys)
            order = np.argsort(every)
            known, total = summed(every[order], np.concatenate(counts)[order])
            if kind == TOKENS:
                say(-1, TOTALS, np.array([len(known), total.sum()], "<i8").tobytes())
                at = np.minimum(np.searchsorted(known, every), max(len(known) - 1, 0))
                found = (np.where(known[at] == every, total[at], 0) if len(known) else np.zeros(len(every))).astype("<u8")
            else:
                # All that is asked goes through the trie once, in order.
                found = np.empty(len(every), "<u2")
                found[order] = Trie.build(known, total).find(every[order])
            ends = np.cumsum([0, *map(len, keys)])
            for k, block in enumerate(blocks):
                say(block, kind, found[ends[k] : ends[k + 1]].tobytes())
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["block", "shard", "kind", "found"])

    return asked.groupBy("shard").applyInArrow(group, ANSWERED)


SCORES = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def add_up(blocks: DataFrame, answers: DataFrame, shards: int, setup: Setup, distinct: int, total: int) -> DataFrame:
    """Scores of the documents of each block from its answers."""

    def group(left: pa.Table, right: pa.Table) -> pa.Table:
        made = []
        for rows in left["rows"].to_pylist():
            b = Block(rows, shards, setup.splits)
            found = {TOKENS: np.zeros(len(b.tokens)), PAIRS: np.zeros(len(b.key))}
            cuts = {kind: b.cuts(kind, shards) for kind in found}
            order = {TOKENS: b.asked, PAIRS: b.pair_asked}
            for shard, kind, data in zip(right["shard"].to_pylist(), right["kind"].to_pylist(), right["found"].to_pylist(), strict=True):
                values = np.frombuffer(data, "<u8") if kind == TOKENS else value_of(np.frombuffer(data, "<u2"))
                found[kind][order[kind][cuts[kind][shard] : cuts[kind][shard + 1]]] = values
            count = found[TOKENS]
            base = (count + 0.5) / (total + 0.5 * (distinct + 1))
            before = count.copy()
            # As many starts as ends were learnt from.
            before[b.start] = count[b.end]
            p = (found[PAIRS][b.pair] + setup.strength * base[b.code]) / (before[b.context] + setup.strength)
            n = len(b.rows)
            sums = [np.bincount(b.doc, weights=x, minlength=n) for x in (np.log10(base)[b.code], np.log10(p))]
            known = np.bincount(b.doc, weights=count[b.code] > 0, minlength=n).astype(np.int64)
            made.append(pa.table([b.rows["doc_id"], pa.array(b.counts), pa.array(known), pa.array(sums[0]), pa.array(sums[1])], names=["doc_id", "n_tokens", "n_known", "base_score", "score"]))
        return pa.concat_tables(made) if made else pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]).empty_table()

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(group, SCORES)


def score(docs: DataFrame, setup: Setup = Setup()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    blocks = stored(packed_blocks(docs, setup), "blocks")
    shards = max(1, blocks.count())
    answers = stored(answer(ask(blocks, shards, setup)), "answers")
    distinct = total = 0
    # One row of two numbers per shard.
    totals = answers.where(f"kind = {TOTALS}").select("found")
    pair = totals.mapInArrow(add_totals, "v bigint, n bigint").agg(F.sum("v"), F.sum("n")).first()
    distinct, total = (int(x or 0) for x in pair)
    scored = add_up(blocks, answers.where(f"kind != {TOTALS}"), shards, setup, distinct, total)
    held_out = F.coalesce(fold() == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score")


def add_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = np.array([np.frombuffer(x, "<i8") for x in batch.column(0).to_pylist()], np.int64).reshape(-1, 2).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in pairs], names=["v", "n"])
