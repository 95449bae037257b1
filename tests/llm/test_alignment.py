"""Cross-tokenizer alignment against a version in plain Python, and on awkward rows."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from fleetlens.llm import alignment
from fleetlens.llm.queries import QUERIES, tokenizer_path

PATHS = [tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")]
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def both():
    return alignment.ByteTokens(PATHS[0]), alignment.PieceTokens(PATHS[1])


def tokens(both, text: str | None):
    """[(id, start, end)] of either tokenizer over the whole text, or None."""
    if not text:
        return None
    a, b = both
    a_ids, b_ids = a.tokenizer.encode(" " + text, add_special_tokens=False).ids, b.model.encode(text)
    made = []
    for ids, names in ((a_ids, a.token_bytes), (b_ids, b.token_bytes)):
        if b"".join(names[k] for k in ids) != (" " + text).encode():
            return None
        out, at = [], 0
        for k in ids:
            out.append((k, at, at + len(names[k])))
            at += len(names[k])
        made.append(out)
    return made


def brute(both, texts: list[str | None]) -> list[tuple]:
    made, counts = [tokens(both, t) for t in texts], Counter()
    pairs = []
    for m in made:
        found = [(a, b) for a, s, e in m[0] for b, t, f in m[1] if s < f and t < e] if m else []
        pairs.append(found)
        counts.update(found)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    out = []
    for m, found in zip(made, pairs, strict=True):
        if not m:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        groups, left, right = [], [], []
        ends = sorted({e for _, _, e in m[0]} & {e for _, _, e in m[1]})
        for end in ends:
            groups.append(",".join(str(k) for k, s, e in m[0] if s >= (left[-1] if left else 0) and e <= end) + "|" + ",".join(str(k) for k, s, e in m[1] if s >= (left[-1] if left else 0) and e <= end))
            left.append(end)
        best = sum(counts[p] == highest[p[1]] for p in found)
        out.append((len(m[0]), len(m[1]), len(groups), len(found), best, sum(counts[p] for p in found), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


AWKWARD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b   c", "a\n b\n  c\t d", "été à la crème  brûlée", "日本語　テキスト 日本", "x  y  z", "<|endoftext|> <s> </s> <0x41>",
    "▁", "a ▁b c", "a▁ b", "🙂🙂 👩‍👩‍👧 ok", "don't we'll it's 'T", "1234567 3.14 --- ... !!!", "\x00\x01 \x7f a", "ﬁ Ⅳ é", "word " * 300, "word " * 300, "a" * 3000, None, "one", "one", "one",
]


def test_awkward_texts_as_in_plain_python(spark, both):
    docs = spark.createDataFrame([(k if k != 4 else None, t, "x", 7, 1) for k, t in enumerate(AWKWARD)], "doc_id bigint, text string, groups_sha256 string, copies int, salt int")
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in alignment.align(docs, *PATHS).collect()}
    want = {(k if k != 4 else None): row for k, row in enumerate(brute(both, AWKWARD))}
    assert got == want


def test_cut_blocks_do_not_change_results(spark, both, monkeypatch):
    texts = [t for t in AWKWARD if t] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 40)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in alignment.align(docs, *PATHS).collect()}
    assert got == dict(enumerate(brute(both, texts)))


def test_query_as_in_plain_python(spark, both):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    short = [r for r in rows if r.text is None or len(r.text) < 3000]
    docs = spark.createDataFrame([(r.doc_id, r.text) for r in short], "doc_id bigint, text string")
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in alignment.align(docs, *PATHS).collect()}
    assert got == {r.doc_id: row for r, row in zip(short, brute(both, [r.text for r in short]), strict=True)}
    every = QUERIES["op11_cross_tokenizer_alignment"](spark, "/root/testdata/sf0.001")
    assert sorted(r.doc_id for r in every.collect()) == sorted(r.doc_id for r in rows)


def test_long_text_and_empty_table(spark):
    long = " ".join(f"word{k % 5000}" for k in range(60_000))
    docs = spark.createDataFrame([(1, long), (2, long), (3, "word1")], "doc_id bigint, text string")
    one, two, three = (r for r in alignment.align(docs, *PATHS).orderBy("doc_id").collect())
    assert one[1:] == two[1:] and one.n_groups >= 60_000 and three.count_sum > 24
    assert alignment.align(docs.limit(0), *PATHS).collect() == []
    nothing = alignment.align(spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string"), *PATHS).collect()
    assert [tuple(r)[1:] for r in nothing] == [(0, 0, 0, 0, 0, 0, "")] * 2
