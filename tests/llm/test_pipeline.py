"""The pipeline's stages against plain versions of what they decide."""

from __future__ import annotations

import corpus_pipeline
from fleetlens.llm import quality_trees
from fleetlens.llm.common import table

from test_operators import links

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    every, kept = docs.count(), docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = {r.doc_id: r.text for r in kept.collect()}
        stage(spark, kept, SF).write.parquet(f"{tmp_path}/{k}")
        kept = spark.read.parquet(f"{tmp_path}/{k}")
        assert kept.columns == docs.columns and 0 < kept.count() <= len(before)
        after = {r.doc_id for r in kept.collect()}
        if name == "near duplicates":
            groups, _ = links(before, 5, 80)
            assert after == {i for i, c in groups.items() if i == c}
        if name == "decontamination":
            items = [r.text for r in table(spark, SF, "benchmark").collect()]
            assert after == {i for i, t in before.items() if not any(x in t for x in items)}
        if name == "quality rules":
            made = quality_trees.quality_rules(docs, quality_trees.fit_quality(docs, table(spark, SF, "labels")))
            assert after == {r.doc_id for r in made.where("kept").collect()}
    assert kept.count() < every
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in kept.collect()}


def test_run_twice_gives_the_same(spark):
    one, two = (sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect()) for _ in range(2))
    assert one == two and one
