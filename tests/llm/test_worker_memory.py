"""What Python workers hold between tasks: nothing of another operator, and no free memory."""

from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
import pyarrow as pa

from fleetlens.llm import common, packing
from fleetlens.llm.queries import tokenizer_path


def test_a_packer_does_not_stay_for_other_operators(spark):
    docs = spark.createDataFrame([(k, f"text {k} of some words") for k in range(64)], "doc_id bigint, text string").repartition(8)
    state = "fleetlens_worker_state"

    def keep(texts: pa.Array) -> np.ndarray:
        return np.full(len(texts), state not in sys.modules)

    assert packing.pack(docs, tokenizer_path()).select("doc_id").distinct().count() == 64
    assert common.keep_rows(docs, keep).count() == 64
    assert packing.pack(docs, tokenizer_path()).select("doc_id").distinct().count() == 64


def test_rows_are_kept_slice_by_slice(spark):
    """Texts about and above the size of a slice, NULL and empty ones; each is judged once and keeps its other columns."""
    sizes = [0, 10, common.SLICE_BYTES + 1, 700_000, 700_000, 700_000, 700_000, None, 5, 3 * common.SLICE_BYTES, 1]
    data = [(k, None if n is None else "x" * n, -k) for k, n in enumerate(sizes)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, other int").coalesce(1)
    kept = common.keep_rows(docs, lambda texts: np.array([len(t) != 700_000 for t in texts.to_pylist()]))
    got = sorted((r.doc_id, r.n, r.other) for r in kept.selectExpr("doc_id", "length(text) AS n", "other").collect())
    assert got == [(k, n, -k) for k, n in enumerate(sizes) if n != 700_000]


def test_free_memory_is_given_back_after_a_task():
    def held() -> float:
        return int(Path("/proc/self/statm").read_text().split()[1]) * 4096 / 1e6

    pins = []

    def run(batches):
        for batch in batches:
            parts = [np.ones(8_000, np.uint8) for _ in range(20_000)]
            # It lies above them, so that the heap does not shrink by itself.
            pins.append(np.ones(8_000, np.uint8))
            assert held() > before + 100
            yield batch
            del parts

    before = held()
    batch = pa.record_batch({"n": [1]})
    assert list(common.leaving_nothing(run)(iter([batch]))) == [batch]
    assert held() < before + 60
