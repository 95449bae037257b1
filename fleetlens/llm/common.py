"""Helpers shared by the operators: batches of texts as numpy arrays, stored frames, the labelled sample."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetlens.session import scratch_path

# Texts are worked on in slices of about this many bytes, so that memory does not follow the size of a batch.
SLICE_BYTES = 2 << 20

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: its lineage is cut and lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def seed(k: int) -> np.uint64:
    return mix(np.array([(k + 1) * 0x9E3779B97F4A7C15 % 2**64], dtype=np.uint64))[0]


def texts_of(column: pa.Array) -> pa.Array:
    """Texts of a column; NULL is empty."""
    return pc.fill_null(column.cast(pa.string()), "")


def byte_texts(texts: pa.Array) -> list[bytes]:
    return texts.cast(pa.binary()).to_pylist()


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges that hold about `limit` bytes each; a longer text is a range of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(texts):
        held = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, held + limit, side="right")))
        yield begin, end
        begin = end


class Words:
    """The words of some texts, split at ASCII white space: `codes` into the distinct `words`, text by text.

    Text i has `counts[i]` words from position `starts[i]`; `doc` is the text of each position.
    """

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(texts)
        bounds = lists.offsets.to_numpy()
        parts = lists.values
        filled = pc.greater(pc.binary_length(parts), 0)
        before = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
        self.counts = np.diff(before[bounds])
        coded = parts.slice(bounds[0], bounds[-1] - bounds[0]).filter(filled.slice(bounds[0], bounds[-1] - bounds[0])).dictionary_encode()
        self.codes = coded.indices.to_numpy().astype(np.int64)
        self.dictionary = coded.dictionary
        self.starts = np.cumsum(self.counts) - self.counts
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    @property
    def words(self) -> list[bytes]:
        return byte_texts(self.dictionary)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each distinct word."""
        return hashes(self.words)

    def windows(self, size: int) -> np.ndarray:
        """Positions at which a window of `size` words lies within one text."""
        left = np.repeat(self.starts + self.counts, self.counts) - np.arange(len(self.codes))
        return np.flatnonzero(left >= size)


def hashes(words: list[bytes], salt: int = 0) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w, salt) for w in words), dtype=np.uint64, count=len(words))


_BASE = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of `size` consecutive word hashes from each position in `at`."""
    total = np.full(len(at), seed(size), dtype=np.uint64)
    for k in range(size):
        total = total * _BASE + values[at + k]
        total ^= total >> np.uint64(29)
    return mix(total)


def sorted_distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


Batches = Iterator[pa.RecordBatch]


def give_back() -> None:
    """Return free memory to the system. Python workers wait for their next task, and what they hold counts while JVM tasks run."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU C library has it
        ctypes.CDLL(None).malloc_trim(0)


def leaving_nothing(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """`run` over the batches of a task; then its memory is given back. What tasks of other operators kept goes before."""

    def whole(batches: Batches) -> Batches:
        if sys.modules.pop(KEPT, None):
            gc.collect()
        yield from run(batches)
        give_back()

    return whole


def in_slices(
    df: DataFrame, columns: list[str], schema: str, work: Callable[[pa.Array, dict[str, pa.Array]], dict[str, object]]
) -> DataFrame:
    """Apply `work` to slices of the last of `columns` (a text); the others come as Arrow arrays; it returns columns of `schema`."""
    spark = df.sparkSession
    fields = spark.createDataFrame([], schema).schema
    *others, text = columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(fields)
        for batch in batches:
            texts = texts_of(batch.column(len(others)))
            for a, b in slices(texts):
                made = work(texts.slice(a, b - a), {c: batch.column(i).slice(a, b - a) for i, c in enumerate(others)})
                yield pa.RecordBatch.from_arrays([arrow(made[f.name], f.type) for f in out], schema=out)

    return df.select(*others, F.col(text).cast("string").alias(text)).mapInArrow(leaving_nothing(run), fields)


def in_rows(df: DataFrame, columns: list[str], schema: str, work: Callable[[dict[str, pa.Array]], dict[str, object]]) -> DataFrame:
    """Apply `work` to batches of `columns`; it returns columns of `schema`."""
    fields = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(fields)
        for batch in batches:
            made = work({c: batch.column(i) for i, c in enumerate(columns)})
            yield pa.RecordBatch.from_arrays([arrow(made[f.name], f.type) for f in out], schema=out)

    return df.select(*columns).mapInArrow(leaving_nothing(run), fields)


def arrow(values: object, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values.cast(kind)
    return pa.array(values, type=kind, from_pandas=False)


def keep_rows(docs: DataFrame, keep: Callable[[pa.Array], np.ndarray], text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose text `keep` marks."""
    fields: StructType = docs.schema
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(place))
            for a, b in slices(texts):
                yield batch.slice(a, b - a).filter(pa.array(keep(texts.slice(a, b - a))))

    return docs.mapInArrow(leaving_nothing(run), fields)


def _place(h: str, words: int) -> tuple[str, str]:
    """The word of a bit table that a hash falls into (a power of two of them), and the bit there."""
    return f"CAST(shiftrightunsigned({h}, 6) & {words - 1} AS INT)", f"CAST({h} & 63 AS INT)"


def bit_table(hashes: DataFrame, words: int) -> DataFrame:
    """One row: an array of `words` numbers whose bits mark the hashes in column `h`, however many there are."""
    word, bit = _place("h", words)
    held = hashes.selectExpr(f"{word} AS word", f"shiftleft(1L, {bit}) AS bit").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    every = hashes.sparkSession.range(0, words, 1, 1).withColumnRenamed("id", "word").join(held, "word", "left")
    filled = F.struct("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))
    return stored(every.agg(F.transform(F.array_sort(F.collect_list(filled)), lambda x: x.bits).alias("bits")), "bits")


def marked(df: DataFrame, hashes: str | list[str], table: DataFrame, words: int) -> DataFrame:
    """The rows of `df` of whose `hashes` one is marked: all that were put in, and some by chance."""
    cells, tests = {}, []
    for k, h in enumerate([hashes] if isinstance(hashes, str) else hashes):
        word, bit = _place(h, words)
        cells[f"cell{k}"] = F.element_at(table.scalar(), F.expr(f"{word} + 1"))
        tests.append(f"shiftrightunsigned(cell{k}, {bit}) & 1 = 1")
    return df.withColumns(cells).where(" OR ".join(tests)).drop(*cells)


KEPT = "fleetlens_worker_state"


def per_process(name: str, make: Callable[[], object]) -> object:
    """What `make` gives, made once in this Python worker and kept for its later tasks, until one of another operator comes."""
    kept = sys.modules.setdefault(KEPT, types.ModuleType(KEPT)).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def fold(doc_id: str = "doc_id", folds: int = 5) -> F.Column:
    """CRC-32 of the id as text, modulo `folds`."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: int, bound: int) -> DataFrame:
    """(doc_id, text, label) of at most `bound` labelled documents outside fold `held_out`.

    The ids are those with the smallest hash, so that the choice does not depend on order or partitions; a document with
    several labels takes the smallest; NULL ids and labels are left out. The list of ids is bounded, hence the broadcast.
    """
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold() != held_out))
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
