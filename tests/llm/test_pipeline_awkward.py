"""The whole pipeline on awkward and on empty tables."""

from __future__ import annotations

import corpus_pipeline
import pytest
from fleetlens.llm.common import table

SF = "/root/testdata/sf0.001"
CLASHING = "n node component kept h bits word cell0 label item_id score sequence_id start copies path"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The given tables, with more rows and with columns that are named like the stages' own."""
    path = str(tmp_path_factory.mktemp("awkward"))
    docs = table(spark, SF, "documents")
    text = docs.orderBy("doc_id").first().text
    long = " ".join(f"The {k}th harbour lies {k * 7 % 1000} miles north of the old town." for k in range(30_000))
    more = [(900_001, None), (900_002, ""), (900_003, " \n\t"), (900_004, long), (900_004, long), (900_005, long), (None, text), (None, None), (900_006, text)]
    named = spark.createDataFrame(more, "doc_id bigint, text string")
    every = docs.unionByName(named, allowMissingColumns=True)
    every = every.selectExpr("*", *[f"concat('{c}', doc_id) AS {c}" for c in CLASHING.split() if c not in docs.columns])
    every.repartition(3).write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(spark, SF, name).write.parquet(f"{path}/{name}.parquet")
    return path


def test_awkward_documents(spark, folder):
    docs = table(spark, folder, "documents")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept.count()
        made = stage(spark, kept, folder)
        assert made.columns == docs.columns, name
        made.write.parquet(f"{folder}/{name}")
        kept = spark.read.parquet(f"{folder}/{name}")
        assert 0 < kept.count() <= before
        # What a row carries is what it carried.
        assert kept.where("doc_id IS NOT NULL AND node != concat('node', doc_id)").isEmpty()
        if name == "quality rules":
            assert kept.where("text IS NULL OR trim(text) = ''").isEmpty()
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})
    assert not {900_001, 900_002, 900_003, 900_005, 900_006} & set(ids)
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, folder).collect()
    assert {r.doc_id for r in pieces} == set(ids)
    by_doc: dict[int, list] = {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert all(sum(r.length for r in rows) == rows[0].doc_tokens for i, rows in by_doc.items() if i is not None)


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SF, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    made = corpus_pipeline.run(spark, str(tmp_path))
    assert made.count() == 0 and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(made.columns)
