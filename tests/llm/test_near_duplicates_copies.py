"""Copies of frequent and of rare sets are looked up in two ways, with the same result."""

from __future__ import annotations

import pytest

from fleetlens.llm import minhash

from test_operators import links


@pytest.mark.parametrize("frequent", [1, 4, 10_000])
def test_frequent_and_rare_copies(spark, monkeypatch, frequent):
    hot, rare = "one text that very many documents have word for word", "another text that only a few documents hold as it is"
    texts = {k: hot if k % 2 else rare if k % 10 == 0 else f"text number {k} about {k * 7} boats and {k * 11} nets" for k in range(3, 60)}
    texts |= {70: hot + " indeed", 71: rare.upper(), 72: None, 73: ""}
    monkeypatch.setattr(minhash, "FREQUENT", frequent)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert got == links(texts, 3, 85)[0]


def test_an_id_with_several_texts_links_their_copies(spark, monkeypatch):
    one, two = "the first text is about a boat at sea", "a second text tells of nets and fish"
    rows = [(1, one), (4, one), (4, two), (6, two), (6, None), (8, "nothing like the others is said here"), (None, one), (None, None)]
    monkeypatch.setattr(minhash, "FREQUENT", 2)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.n_shingles > 0) for r in got) == [
        (0, 0, False), (0, 0, True), (1, 1, True), (4, 1, True), (4, 1, True), (6, 1, False), (6, 1, True), (8, 8, True),
    ]
