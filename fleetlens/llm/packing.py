"""Packing: tokenised documents placed into fixed-length training sequences by vector bin packing.

Method. A piece is a vector (tokens, one segment, loss-bearing tokens), a sequence a bin with a limit for each. Documents are
tokenised and wait in a bounded buffer. One bin is open: again and again it takes the waiting piece that fits and whose dot
product with the room left (both in shares of the limits) is largest. When nothing fits, the piece with the most tokens is cut so
that it fills the bin. A document longer than a bin is cut the same way. What is left at the end of a partition is cut into
sequences whose lengths are powers of two, which need no padding. Nothing is shuffled: partitions pack on their own and number
their sequences apart (the partition's number times 2^33 plus a count).

Defined cases. A NULL or empty text is its end token alone. NULL ids are packed like others. Repeated rows are packed each. A text
of any length is cut; every id lies in exactly one piece. An empty table gives no pieces. Only the id, text and, if named, loss
columns are read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from fleetlens.llm.common import Words, per_process, slices, texts_of
from fleetlens.llm.word_memory import WordMemory, gathered

END_ID = 1
# Below this, letters are those of the Latin blocks, whose small ones no normalisation changes.
LATIN = "\u0250"
# Marks that may end a word. The apostrophe is left out, as tokenizers treat what follows it apart.
TAIL = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 256
    loss: int = 2048
    waiting: int = 256


class WordTokenizer:
    """Ids of texts from a tokenizer that drops white space: the ids of a text are those of its words in order.

    A word is looked up by its lower-cased (A-Z) head and its tail of ASCII marks, since the tokenizer lower-cases and separates
    letters from marks; so each distinct head is tokenised once. Words in which that might not hold stay whole.

    Words of small letters of the Latin blocks need neither the normaliser nor the splitting pattern: many at once go through the
    merges alone, as one text. Where a word ends is known from the ids, whose entries end with the mark of word ends.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        described = json.loads(self.tokenizer.to_str())
        described |= {"normalizer": None, "pre_tokenizer": None, "post_processor": None, "added_tokens": []}
        self.merges = Tokenizer.from_str(json.dumps(described))
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        suffix = described["model"]["end_of_word_suffix"]
        self.ends[[k for entry, k in self.tokenizer.get_vocab().items() if suffix and entry.endswith(suffix)]] = True
        self.memory = WordMemory(self._encode)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = np.fromiter((w.isalpha() and max(w) < LATIN and w == w.lower() for w in words), bool, len(words))
        sizes, parts = np.zeros(len(words), np.int64), []
        if plain.any():
            text = " ".join([w for w, p in zip(words, plain, strict=True) if p])
            ids = np.array(self.merges.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            sizes[plain] = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            parts.append(ids)
        rest = [e.ids for e in self.tokenizer.encode_batch_fast([w for w, p in zip(words, plain, strict=True) if not p], add_special_tokens=False)]
        sizes[~plain] = [len(ids) for ids in rest]
        parts.append(np.array([k for ids in rest for k in ids], np.int32))
        order = np.argsort(~plain, kind="stable")
        begin = np.zeros(len(words), np.int64)
        begin[order] = np.cumsum(sizes[order]) - sizes[order]
        return gathered(np.concatenate(parts), begin, sizes), sizes

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        words = Words(texts)
        low = pc.ascii_lower(words.dictionary)
        head = pc.ascii_rtrim(low, characters=TAIL)
        # What follows the last letter or number; where that is more than ASCII marks, the word stays whole.
        tail = pc.replace_substring_regex(low, r"^.*[\p{L}\p{N}]", "")
        whole = pc.or_(pc.not_equal(pc.add(pc.binary_length(head), pc.binary_length(tail)), pc.binary_length(low)), pc.match_substring(low, "<"))
        coded = pa.concat_arrays([pc.if_else(whole, low, head), pc.if_else(whole, "", tail)]).dictionary_encode()
        flat, size = self.memory.lists(coded.dictionary.to_pylist())
        code = coded.indices.to_numpy()
        parts = np.column_stack([code[: len(head)], code[len(head) :]])[words.codes].ravel()
        per_part = size[parts]
        every = gathered(flat, (np.cumsum(size) - size)[parts], per_part)
        bounds = np.concatenate([[0], np.cumsum(per_part)])[2 * np.concatenate([words.starts, [len(words.codes)]])]
        for i in range(len(texts)):
            yield np.append(every[bounds[i] : bounds[i + 1]], np.int32(END_ID))


@dataclass
class Item:
    """What is left of a document: ids from `start`; those before `silent` bear no loss."""

    doc_id: int | None
    ids: np.ndarray
    silent: int
    start: int = 0

    def rest(self) -> tuple[int, int]:
        left = len(self.ids) - self.start
        return left, left - min(left, max(0, self.silent - self.start))

    def most(self, tokens: int, loss: int) -> int:
        """Length of the longest next piece within `tokens` and `loss`."""
        left, bearing = self.rest()
        return min(left, tokens, left - bearing + loss)


class Packer:
    """Packs items in the order they come; `pieces` collects (item, start, length, sequence, offset)."""

    def __init__(self, limits: Limits, first: int):
        self.limits, self.sequence = limits, first
        self.items: list[Item] = []
        self.sizes = np.zeros((limits.waiting, 2))
        self.pieces: list[tuple[Item, int, int, int, int]] = []
        self.open: list[tuple[Item, int, int]] = []
        self.room = np.array([limits.tokens, limits.segments, limits.loss])

    def add(self, item: Item) -> None:
        while item.rest()[0] >= self.limits.tokens and (n := item.most(self.limits.tokens, self.limits.loss)):
            self._emit([(item, item.start, n)])
            item.start += n
        if item.rest()[0]:
            while len(self.items) == self.limits.waiting:
                self._fill()
            self.sizes[len(self.items)] = item.rest()
            self.items.append(item)

    def _take(self, k: int, n: int) -> None:
        item = self.items[k]
        loss = item.rest()[1]
        self.open.append((item, item.start, n))
        item.start += n
        left = item.rest()
        self.room -= [n, 1, loss - left[1]]
        if left[0]:
            self.sizes[k] = left
        else:
            last = self.items.pop()
            if k < len(self.items):
                self.items[k] = last
                self.sizes[k] = self.sizes[len(self.items)]

    def _fill(self) -> None:
        """Fill one bin from the waiting items and close it."""
        most = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], float)
        while self.items and self.room[0] > 0 and self.room[1] > 0:
            sizes = self.sizes[: len(self.items)]
            fits = (sizes[:, 0] <= self.room[0]) & (sizes[:, 1] <= self.room[2])
            share = self.room / most
            worth = sizes[:, 0] / most[0] * share[0] + share[1] / most[1] + sizes[:, 1] / most[2] * share[2]
            if fits.any():
                k = int(np.where(fits, worth, -1).argmax())
                self._take(k, int(sizes[k, 0]))
                continue
            # The longest next piece of each, as in Item.most.
            lengths = np.minimum(np.minimum(sizes[:, 0], self.room[0]), sizes[:, 0] - sizes[:, 1] + self.room[2])
            k = int(np.lexsort((sizes[:, 0], lengths))[-1])
            if lengths[k] == 0:
                break
            self._take(k, int(lengths[k]))
        self._close()

    def _close(self) -> None:
        self._emit(self.open)
        self.open = []
        self.room = np.array([self.limits.tokens, self.limits.segments, self.limits.loss])

    def _emit(self, pieces: list[tuple[Item, int, int]]) -> None:
        """One sequence, or, if it is not full, several whose lengths are powers of two."""
        held = sum(n for _, _, n in pieces)
        goal = held if held == self.limits.tokens else 0
        offset = 0
        for item, start, n in pieces:
            while n:
                if not goal:
                    goal = 1 << (held.bit_length() - 1)
                step = min(n, goal - offset)
                self.pieces.append((item, start, step, self.sequence, offset))
                start, n, offset, held = start + step, n - step, offset + step, held - step
                if offset == goal:
                    self.sequence += 1
                    goal = offset = 0

    def end(self) -> None:
        while self.items:
            self._fill()


SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "loss_tokens bigint, input_ids array<int>"
)


def pack(docs: DataFrame, tokenizer: str, limits: Limits = Limits(), silent: str | None = None, ids: bool = True) -> DataFrame:
    """One row per piece; `silent` names a column with the number of leading tokens that bear no loss."""
    fields = docs.sparkSession.createDataFrame([], SCHEMA).schema
    if not ids:
        fields.fields.pop()
        fields.names.pop()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(fields)
        maker = per_process(f"tokenizer {tokenizer}", lambda: WordTokenizer(tokenizer))
        packer = Packer(limits, TaskContext.get().partitionId() << 33)

        def ready() -> pa.RecordBatch:
            pieces, packer.pieces = packer.pieces, []
            parts = [i.ids[s : s + n] for i, s, n, _, _ in pieces]
            columns = [
                [i.doc_id for i, *_ in pieces], [s for _, s, *_ in pieces], [n for _, _, n, *_ in pieces],
                [zlib.crc32(p.astype("<u4").tobytes()) for p in parts], [len(i.ids) for i, *_ in pieces],
                [q for *_, q, _ in pieces], [o for *_, o in pieces],
                [n - min(n, max(0, i.silent - s)) for i, s, n, _, _ in pieces],
            ]
            arrays = [pa.array(c, pa.int64()) for c in columns]
            if ids:
                ends = np.cumsum([0, *columns[2]]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32))))
            return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, out, strict=True)], schema=out)

        for batch in batches:
            texts = texts_of(batch.column(1))
            names = batch.column(0).to_pylist()
            quiet = batch.column(2).to_pylist() if silent else [0] * len(names)
            for a, b in slices(texts):
                for k, made in enumerate(maker.ids(texts.slice(a, b - a)), a):
                    packer.add(Item(names[k], made, quiet[k] or 0))
                    if len(packer.pieces) > 4096:
                        yield ready()
        packer.end()
        yield ready()

    return docs.select("doc_id", "text", *([silent] if silent else [])).mapInArrow(run, fields)
