"""Cross-tokenizer alignment: two tokenizers' tokens of the same text, linked by their byte ranges.

Method. Documents are shuffled by their full text, so that each distinct text is tokenised and aligned once; its pair counts are
weighted by its number of copies, and its measures are joined back to the doc_ids by a 128-bit key of the text. Token A encodes a
space and the text, token B the text, to which it adds that space. Byte offsets where tokens of both end cut them into groups; an A
and a B token are linked if their byte ranges overlap.

No token of either tokenizer goes over a place where a space follows an ASCII character that is not white space (A splits there
before it merges; no piece of B holds a space behind something else, which is checked when it is loaded). So texts are cut there,
and the distinct words of a block of texts are tokenised and aligned, all at once in numpy.

Flow. Texts are worked on in blocks of bounded size. A block stores, per text, the numbers of its words, and for its distinct words
their links as numbers into its distinct id pairs, with counts weighted by copies. Pair counts are summed over blocks; every block
gets the totals of its own pairs back (a pair is asked for once a block, however frequent) and adds them up per word and text.
Broadcast are the highest count of each B id (at most as many as the vocabulary has) and the keys of texts that are more than a
ten-thousandth of all documents, hence fewer than 10,000; the join with those is salted.

Defined cases. NULL and empty texts, and texts whose joined A or B bytes are not the space and the text (U+2581 in a text), have no
tokens: zeros and an empty `groups_sha256`; they add to no count. Repeated rows are copies and each get a row. NULL ids are rows
like others. Texts are used whole; a text longer than a block is a block of its own. An empty table gives no rows. Only the id and
the text are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import byte_texts, per_process, slices, stored, texts_of
from fleetlens.llm.word_memory import gathered

BLOCK_BYTES = 2 << 20
# Words that are encoded at once, as one text.
TEXT_BYTES = 1 << 10
# Parts that the documents of a text above a ten-thousandth of all are dealt over.
SALTS = 64
KEYS = ("key_a", "key_b")


class ByteTokens:
    """Token A: a byte-level BPE file of the `tokenizers` library. `token_bytes[id]` are the bytes of a token."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # The printable stand-ins of byte-level vocabularies: printable bytes are themselves, the others follow from 256 on.
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in set(printable)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
        entries = sorted(self.tokenizer.get_vocab().items(), key=lambda e: e[1])
        self.token_bytes = [bytes(byte_of.get(c, 0) for c in entry) for entry, _ in entries]

    def encode(self, texts: list[str]) -> np.ndarray:
        """The ids of all texts, one after the other."""
        return np.concatenate([np.zeros(0, np.int32), *[np.array(made.ids, np.int32) for made in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]])


class PieceTokens:
    """Token B: a BPE model of `sentencepiece` that puts a space before a text and stands for a space by U+2581."""

    SPACE = "▁"

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        if any(self.SPACE in p.lstrip(self.SPACE) for p in pieces):
            raise ValueError("a piece holds a space behind another character, so that texts cannot be cut before spaces")
        self.token_bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace(self.SPACE, " ").encode() for k, p in enumerate(pieces)]
        self.space = self.model.piece_to_id(self.SPACE)

    def encode(self, texts: list[str]) -> np.ndarray:
        """`texts` begin with a space, which the model adds by itself, but not to an empty text."""
        lists = self.model.encode([t[1:] for t in texts], num_threads=1)
        return np.concatenate([np.zeros(0, np.int32), *[np.array(made if len(t) > 1 else [self.space], np.int32) for made, t in zip(lists, texts, strict=True)]])


class Bytes:
    """Byte strings as one array; `of` gives those of some numbers, one after the other."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(x) for x in strings], np.int64)
        self.begin, self.flat = np.cumsum(self.size) - self.size, np.frombuffer(b"".join(strings), np.uint8)

    def of(self, numbers: np.ndarray) -> np.ndarray:
        return gathered(self.flat, self.begin[numbers], self.size[numbers])


@dataclass
class Aligned:
    """Alignment of words: per word whether it is sound, its numbers of tokens, groups and links, and its groups as text; all links."""

    sound: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[bytes]
    links: np.ndarray


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.tokens = ByteTokens(path_a), PieceTokens(path_b)
        self.bytes = [Bytes(t.token_bytes) for t in self.tokens]
        # Ids as they are written: inside a group, and at the end of the group's part.
        a, b = (range(len(t.token_bytes)) for t in self.tokens)
        self.written = Bytes([b"%d%c" % (k, c) for k in a for c in b",|"] + [b"%d%c" % (k, c) for k in b for c in b",;"])
        self.first_b = 2 * len(a)

    def encode(self, words: pa.Array, closed: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """(ids of A and of B, the end of every word, whether it is sound), of the sound words one after the other.

        Words that end in an ASCII character that is not white space (`closed`) are encoded many at once, as one text: neither
        tokenizer goes over the space that follows. Should the bytes differ after all, every word is encoded alone and tested.
        """
        sound = ~pc.match_substring(words, PieceTokens.SPACE).to_numpy(zero_copy_only=False)
        for alone in (False, True):
            data, ends = joined(words.filter(pa.array(sound)))
            together = closed[sound] & (not alone)
            # A word starts a text if it or the one before stands alone, or if a text has become long enough.
            part = ends // TEXT_BYTES
            last = np.ones(len(ends), bool)
            last[:-1] = ~together[1:] | ~together[:-1] | (part[1:] != part[:-1])
            at = [0, *ends[last].tolist()]
            texts = [data[i:j].decode() for i, j in zip(at, at[1:], strict=False)]
            ids = [t.encode(texts) for t in self.tokens]
            if alone or all(self._is(k, ids[k], data, ends) for k in (0, 1)):
                return ids, ends, sound
            fine = [all(self.bytes[k].of(t.encode([w.decode()])).tobytes() == w for k, t in enumerate(self.tokens)) for w in byte_texts(words.filter(pa.array(sound)))]
            sound[np.flatnonzero(sound)[~np.array(fine, bool)]] = False
        raise AssertionError

    def _is(self, k: int, ids: np.ndarray, asked: bytes, ends: np.ndarray) -> bool:
        """Whether the ids are the bytes asked for, with a token's end at every word's end."""
        told = np.cumsum(self.bytes[k].size[ids])
        return self.bytes[k].of(ids).tobytes() == asked and bool(np.isin(ends, told).all())

    def align(self, words: pa.Array, closed: np.ndarray) -> Aligned:
        """`words` begin with a space and end where both tokenizers end a token."""
        (a, b), ends, sound = self.encode(words, closed)
        size_a, size_b = (x.size[ids] for x, ids in zip(self.bytes, (a, b), strict=True))
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        start_a, start_b = end_a - size_a, end_b - size_b
        common = end_a[np.isin(end_a, end_b, assume_unique=True)]
        # Tokens of the groups up to each, and of the words up to each.
        last_a, last_b = np.searchsorted(end_a, common, "right"), np.searchsorted(end_b, common, "right")
        upto_a, upto_b, upto_groups = (np.searchsorted(e, ends, "right") for e in (end_a, end_b, common))
        low, high = np.searchsorted(end_b, start_a, "right"), np.searchsorted(start_b, end_a, "left")
        links = (np.repeat(a.astype(np.int64), high - low) << 32) | gathered(b, low, high - low)
        upto_links = np.concatenate([[0], np.cumsum(high - low)])[upto_a]
        # Tokens as they are written, group by group: those of A, then those of B.
        group_a, group_b = np.searchsorted(common, end_a, "left"), np.searchsorted(common, end_b, "left")
        final_a, final_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        final_a[last_a - 1], final_b[last_b - 1] = True, True
        written = np.zeros(len(a) + len(b), np.int64)
        written[np.arange(len(a)) + np.concatenate([[0], last_b])[group_a]] = 2 * a.astype(np.int64) + final_a
        written[np.arange(len(b)) + last_a[group_b]] = self.first_b + 2 * b.astype(np.int64) + final_b
        text = self.written.of(written).tobytes()
        bounds = [0, *np.cumsum(self.written.size[written])[upto_a + upto_b - 1].tolist()]
        groups, k = [b""] * len(sound), np.flatnonzero(sound).tolist()
        for at, i, j in zip(k, bounds, bounds[1:], strict=False):
            groups[at] = text[i:j]

        def per_word(upto: np.ndarray) -> np.ndarray:
            out = np.zeros(len(sound), np.int64)
            out[sound] = np.diff(upto, prepend=0)
            return out

        return Aligned(sound, per_word(upto_a), per_word(upto_b), per_word(upto_groups), per_word(upto_links), groups, links)


def joined(words: pa.Array) -> tuple[bytes, np.ndarray]:
    """All words one after the other, and the end of each."""
    bounds = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    return (words.buffers()[2].slice(bounds[0], bounds[-1] - bounds[0]).to_pybytes() if len(words) else b""), bounds[1:] - bounds[0]


def cut(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """The words of a space and each text: their numbers, the distinct words, which of these end in an ASCII character that is not
    white space, and the first word of each text (one more at the end).

    Texts are cut where a space follows such a character.
    """
    spaced = pc.binary_join_element_wise(pa.scalar(""), texts, pa.scalar(" ")).cast(pa.binary())
    if isinstance(spaced, pa.ChunkedArray):
        spaced = spaced.combine_chunks()
    bounds = np.frombuffer(spaced.buffers()[1], np.int32)[spaced.offset : spaced.offset + len(spaced) + 1]
    data = np.frombuffer(spaced.buffers()[2], np.uint8)[: bounds[-1]]
    closing = (data > 0x20) & (data < 0x7F)
    is_start = np.zeros(len(data), bool)
    is_start[1:] = (data[1:] == 0x20) & closing[:-1]
    is_start[: bounds[0]] = False
    is_start[bounds[:-1]] = True
    starts = np.flatnonzero(is_start)
    offsets = np.append(starts, bounds[-1]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), spaced.buffers()[2]]).dictionary_encode()
    codes = words.indices.to_numpy()
    closed = np.zeros(len(words.dictionary), bool)
    closed[codes] = closing[offsets[1:] - 1]
    return codes.astype(np.int32), words.dictionary, closed, np.searchsorted(starts, bounds)


TEXT_COLUMNS = "key_a bigint, key_b bigint, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
BLOCK_COLUMNS = f"block bigint, {TEXT_COLUMNS}, words binary, pairs array<bigint>, counts array<bigint>, word_links binary, word_sizes binary"
MEASURES = "key_a bigint, key_b bigint, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of `values`."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def align_block(aligner: Aligner, texts: pa.Array, copies: np.ndarray) -> tuple[dict[str, object], dict[str, object]]:
    """Columns of the texts of a block, and the links of its words."""
    codes, dictionary, closed, first = cut(texts)
    made = aligner.align(dictionary, closed)
    sizes = np.diff(first)
    doc = np.repeat(np.arange(len(texts)), sizes)
    sound = np.bincount(doc[~made.sound[codes]], minlength=len(texts)) == 0
    used = codes[sound[doc]]
    weight = np.bincount(used, weights=np.repeat(copies, sizes)[sound[doc]].astype(float), minlength=len(dictionary)).astype(np.int64)
    pairs, at = np.unique(made.links, return_inverse=True)
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, at, np.repeat(weight, made.n_links))
    numbers = {name: np.where(sound, _sums(getattr(made, name)[codes], sizes), 0) for name in ("n_a", "n_b", "n_groups", "n_links")}
    listed, groups, digests, words = codes.tolist(), made.groups, [], []
    for good, i, j in zip(sound.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
        digests.append(hashlib.sha256(b"".join([groups[c] for c in listed[i:j]])[:-1]).hexdigest() if good else "")
        words.append(codes[i:j].tobytes() if good else b"")
    # Pairs of unsound texts alone count nothing and are nobody's.
    live = counts > 0
    place = np.where(live, np.cumsum(live) - 1, 0).astype(np.int32)
    own = np.repeat(weight > 0, made.n_links)
    links = {
        "pairs": pairs[live], "counts": counts[live], "word_links": place[at[own]].tobytes(),
        "word_sizes": np.where(weight > 0, made.n_links, 0).astype(np.int32).tobytes(),
    }
    return {**numbers, "groups_sha256": digests, "words": words}, links


def blocks(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Aligned texts of (key_a, key_b, copies, text): per block a row per text and one with the links of the block's words."""
    fields = texts.sparkSession.createDataFrame([], BLOCK_COLUMNS).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(fields)
        aligner = per_process(f"aligner {path_a} {path_b}", lambda: Aligner(path_a, path_b))
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            every = texts_of(batch.column("text"))
            for i, j in slices(every, BLOCK_BYTES):
                part = batch.slice(i, j - i)
                per_text, links = align_block(aligner, every.slice(i, j - i), part.column("copies").to_numpy())
                rows = {k: part.column(k) for k in ("key_a", "key_b", "copies")} | per_text | {"block": np.full(j - i, block)}
                yield pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) if f.name in rows else pa.nulls(j - i, f.type) for f in out], schema=out)
                links = {"block": [block]} | {k: [v] for k, v in links.items()}
                yield pa.RecordBatch.from_arrays([pa.array(links[f.name], f.type) if f.name in links else pa.nulls(1, f.type) for f in out], schema=out)
                block += 1

    return texts.select("key_a", "key_b", "copies", "text").mapInArrow(run, fields)


def pair_totals(asked: DataFrame) -> DataFrame:
    """(pair, total, is_best): links per id pair (A id * 2^32 + B id), and whether no pair of its B id has more."""
    totals = stored(asked.groupBy("pair").agg(F.sum("n").alias("total")), "pairs")
    # At most as many rows as B has ids.
    highest = F.broadcast(totals.groupBy(F.expr("pair & 4294967295").alias("b")).agg(F.max("total").alias("highest")))
    return totals.join(highest, F.expr("pair & 4294967295 = b")).selectExpr("pair", "total", "total = highest AS is_best")


def text_measures(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The measures of each text, by its key."""
    made = stored(blocks(texts, path_a, path_b), "aligned")
    asked = made.where("pairs IS NOT NULL").selectExpr("block", "inline(arrays_zip(pairs, counts))").toDF("block", "pair", "n")
    answers = asked.join(pair_totals(asked), "pair").select("block", "pair", "total", "is_best")

    def add_up(rows: pa.Table, told: pa.Table) -> pa.Table:
        is_text = pc.is_null(rows["pairs"])
        texts, links = rows.filter(is_text), rows.filter(pc.invert(is_text))
        order = np.argsort(told["pair"].to_numpy())
        # The block's pairs are sorted as well, and all of them were told.
        total, best = told["total"].to_numpy()[order], told["is_best"].to_numpy()[order].astype(np.int64)
        at, sizes = (np.frombuffer(links[c][0].as_py(), np.int32) for c in ("word_links", "word_sizes"))
        of_word = [_sums(v[at], sizes) for v in (best, total)]
        coded = [np.frombuffer(w, np.int32) for w in texts["words"].to_pylist()]
        codes, lengths = np.concatenate(coded) if coded else np.zeros(0, np.int32), np.array([len(c) for c in coded], np.int64)
        sums = {name: pa.array(_sums(v[codes], lengths)) for name, v in zip(("n_best", "count_sum"), of_word, strict=True)}
        return pa.table({c.split()[0]: sums.get(c.split()[0], None) if c.split()[0] in sums else texts[c.split()[0]] for c in MEASURES.split(", ")})

    return made.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(add_up, MEASURES)


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per row of `docs`."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The second hash has another seed, so that both together are a key of 128 bits.
    key = [F.xxhash64("text").alias("key_a"), F.xxhash64(F.lit(1), F.col("text")).alias("key_b")]
    filled = F.col("text").isNotNull() & (F.col("text") != "")
    distinct = docs.where(filled).groupBy("text").agg(F.count("*").alias("copies"))
    measures = stored(text_measures(distinct.select("*", *key), path_a, path_b), "measures")
    rows = measures.agg(F.sum("copies")).first()[0] or 0
    hot = measures.where(F.col("copies") > rows // 10_000 + 1)
    # A text with more than a ten-thousandth of the documents: its measures go to every part, and its documents are dealt over the parts.
    spread = measures.withColumn("salt", F.explode(F.when(F.col("copies") > rows // 10_000 + 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    keyed = docs.select("doc_id", *[F.when(filled, k).alias(name) for k, name in zip(key, KEYS, strict=True)])
    dealt = keyed.join(F.broadcast(hot.select(*KEYS, F.lit(SALTS).alias("parts"))), list(KEYS), "left")
    dealt = dealt.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.when(F.col("key_a").isNull(), SALTS).otherwise(F.coalesce("parts", F.lit(1)))).cast("int"))
    joined = dealt.join(spread, [*KEYS, "salt"], "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return joined.select("doc_id", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
