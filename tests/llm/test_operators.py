"""The training-data operators against brute force, exact round trips and held-out labels, and on awkward rows."""

from __future__ import annotations

import hashlib
import html
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from fleetlens.llm import chat, decontaminate, elias_fano, html_text, language_model, licenses, minhash, nb_svm, packing, quality_trees, url_trie
from fleetlens.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, score string, kept int, component_id string, lang string"
LONG = " ".join(f"word{k % 5000}" for k in range(60_000))


def low(text: str | None) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def fold(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % 5


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def awkward(spark):
    """NULLs, empty and very long texts, repeated rows, and columns named like results."""
    texts = [None, "", " \n ", "one", LONG, LONG, "a b c d e f g h i j k l", "a b c d e f g h i j k l", None]
    ids = [1, 2, 3, 4, 5, 6, 7, 7, None]
    return spark.createDataFrame([(i, t, "x", 1, "y", None) for i, t in zip(ids, texts, strict=True)], DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def links(texts: dict[int, str | None], words: int, percent: int) -> dict[int, int]:
    sets, parent = {}, {i: i for i in texts}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, t in texts.items():
        w = WORD.findall(low(t))
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    inverted = defaultdict(list)
    for i in sorted(sets):
        for j, shared in Counter(j for s in sets[i] for j in inverted[s]).items():
            if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for s in sets[i]:
            inverted[s].append(i)
    return {i: root(i) for i in texts}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("rule", [minhash.Rule(), minhash.Rule(words=5, percent=80, bands=68, rows=7)])
def test_near_duplicates_brute_force(spark, documents, rule):
    expected, sizes = links(dict(documents), rule.words, rule.percent)
    got = minhash.near_duplicates(spark.createDataFrame(documents, "doc_id bigint, text string"), rule).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {(i, sizes[i], c, i == c) for i, c in expected.items()}


def test_near_duplicates_around_a_pivot(spark):
    """A chain of small edits, of which the pivot is linked with few: the blocks find the rest, in groups and blocks of two."""
    base = [f"w{k}" for k in range(120)]
    rng, texts = np.random.default_rng(5), {}
    for n in range(60):
        own = list(base)
        for k in rng.choice(120, int(rng.integers(0, 5)), replace=False):
            own[k] = f"x{n}_{k}"
        texts[n + 10] = " ".join(own)
    texts[500] = texts[10]
    expected, _ = links(texts, 3, 85)
    rule = minhash.Rule(group=2, block=2)
    got = minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), rule)
    assert {r.doc_id: r.component_id for r in got.collect()} == expected


def test_sketch_fills_and_estimates():
    a = np.arange(300, dtype=np.uint64) * np.uint64(7919)
    sets, docs = np.concatenate([a, a[30:], a[:1]]), np.repeat([0, 1, 2], [300, 270, 1])
    made = minhash.sketch(docs, sets, 4, 480)
    assert (made[:3] != np.iinfo(np.uint64).max).all() and (made[3] == np.iinfo(np.uint64).max).all()
    assert abs((made[0] == made[1]).mean() - 0.9) < 0.06


def test_near_duplicates_awkward(awkward, nothing):
    got = sorted(minhash.near_duplicates(awkward).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [
        (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 5, True), (6, 5, False), (7, 7, True), (7, 7, True), (None, None, True),
    ]
    kept = minhash.one_of_each(awkward, minhash.Rule())
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 2, 3, 4, 5, 7]
    assert minhash.near_duplicates(nothing).count() == 0


def test_classifier_held_out(spark):
    made = QUERIES["op2_quality_classifier"](spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert all(r.held_out == (fold(r.doc_id) == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in made)
    tested = [r.predicted == labels[r.doc_id] for r in made if r.held_out and r.doc_id in labels]
    assert np.mean(tested) > 0.9


def test_classifier_awkward(spark, awkward, nothing):
    model = nb_svm.fit([np.array([1, 2]), np.array([3])] * 10, np.array([0, 1] * 10))
    got = nb_svm.classify(awkward, model).collect()
    assert len(got) == 9 and all(0 <= r.score <= 1 for r in got)
    assert nb_svm.keep_good(awkward, model).columns == awkward.columns
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert nb_svm.classify(awkward, nb_svm.fit_classifier(awkward, labels)).select("score").distinct().count() == 1
    assert nb_svm.classify(nothing, model).count() == 0


def test_descent_separates():
    bags = [np.array([0, 5]), np.array([1, 5])] * 30
    model = nb_svm.fit(bags, np.array([1, 0] * 30))
    assert model.weights[0] > 0 > model.weights[1]


def plain_statistics(text: str) -> tuple[int, ...]:
    words = WORD.findall(text)
    lines, seen, twice = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            twice += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), twice, len(covered)


def test_quality_statistics(spark, documents):
    base, matrix = quality_trees.statistics(pa.array([t or "" for _, t in documents]))
    assert list(zip(*(base[c].tolist() for c in quality_trees.BASE), strict=True)) == [plain_statistics(t or "") for _, t in documents]
    assert matrix.shape == (len(documents), len(quality_trees.FEATURES)) and np.isfinite(matrix).all()


def test_quality_rules(spark, awkward, nothing):
    made = QUERIES["op9_quality_rules"](spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept) for r in made)
    assert np.mean([r.kept == labels[r.doc_id] for r in made if r.doc_id in labels and not r.base_failed and fold(r.doc_id) == 0]) > 0.9
    trees = quality_trees.fit_trees(np.zeros((0, 11)), np.zeros(0), list(quality_trees.FEATURES.values()))
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality_trees.quality_rules(awkward, trees).collect()}
    assert got[None] == got[1] == got[2] == got[3] == got[4] == (True, False) and got[7] == (False, True)
    assert quality_trees.quality_rules(nothing, trees).count() == 0


def test_trees_are_monotonic():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 2))
    y = (np.sin(9 * x[:, 0]) + x[:, 1] + rng.normal(0, 0.3, 3000) > 0.8).astype(float)
    trees = quality_trees.fit_trees(x, y, [1, 0])
    line = np.column_stack([np.linspace(0, 1, 200), np.full(200, 0.5)])
    assert (np.diff(trees.margin(line)) >= -1e-9).all()
    free = quality_trees.fit_trees(x, y, [0, 0])
    assert np.mean((free.score(x) > 0.5) == y) > 0.8


def test_url_filters(spark):
    rows = [
        (1, "http://A.example.org/es/1"), (2, "http://example.org/en/17?x"), (3, "https://b.org/en/1"), (4, "http://x.com/de/"), (5, "http://x.com/fr/z#t"),
        (6, None), (7, "no scheme"), (8, "http://casino-win.example.net/"), (9, "http://org"), (10, "http://x.org/"), (10, "http://x.org/"), (11, "a://b://c/d"),
    ]
    got = url_trie.judge(spark.createDataFrame([(i, u, "h") for i, u in rows], "page_id bigint, url string, host string")).collect()
    assert [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got] == [
        (1, "a.example.org", "/es/1", "example.org/es/", "block"), (2, "example.org", "/en/17", "example.org/en/1", "block"), (3, "b.org", "/en/1", "org/", "allow"),
        (4, "x.com", "/de/", "com/de/", "block"), (5, "x.com", "/fr/z", "com/fr/", "allow"), (6, "", "", None, "allow"), (7, "", "", None, "allow"),
        (8, "casino-win.example.net", "/", None, "block"), (9, "org", "", None, "allow"), (10, "x.org", "/", "org/", "allow"), (10, "x.org", "/", "org/", "allow"),
        (11, "b:", "//c/d", None, "allow"),
    ]
    assert url_trie.judge(spark.createDataFrame([], "page_id bigint, url string")).count() == 0


def test_language_model_brute_force(spark, documents):
    got = {r.doc_id: r for r in language_model.score(spark.createDataFrame(documents, "doc_id bigint, text string"), language_model.Setup(block_bytes=40_000)).collect()}
    tokens = {i: [*WORD.findall(low(t)), None] for i, t in documents}
    one, two, starts = Counter(), Counter(), 0
    for i, t in tokens.items():
        if fold(i) != 1:
            starts += 1
            one.update(t)
            two.update(zip(["<s>", *t[:-1]], t, strict=True))
    total, kinds, strength = sum(one.values()), len(one), language_model.Setup().strength
    assert len(got) == len(documents)
    for i, t in tokens.items():
        p = [(one[w] + 0.5) / (total + 0.5 * (kinds + 1)) for w in t]
        q = [(two[c, w] + strength * x) / ((starts if c == "<s>" else one[c]) + strength) for c, w, x in zip(["<s>", *t[:-1]], t, p, strict=True)]
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold(i) == 1, len(t), sum(one[w] > 0 for w in t), total)
        assert math.isclose(r.base_score, sum(map(math.log10, p)), rel_tol=1e-9)
        assert math.isclose(r.score, sum(map(math.log10, q)), rel_tol=1e-6)


def test_language_model_awkward(awkward, nothing):
    got = language_model.score(awkward).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in got)[0] == (False, 1, 1) and len(got) == 9
    assert language_model.score(nothing).count() == 0


def test_elias_fano_round_trip():
    rng = np.random.default_rng(2)
    for values in ([], [0], [7, 7, 7], np.sort(rng.integers(0, 2**40, 5000)), np.arange(100)):
        values = np.array(values, np.int64)
        assert (elias_fano.decode(np.frombuffer(elias_fano.encode(values), np.uint8)) == values).all()
    keys = np.unique(rng.integers(0, 2**40, 150_000))
    counts = rng.integers(1, 9000, len(keys))
    trie = elias_fano.Trie.build(keys[::2], counts[::2])
    found = elias_fano.value_of(trie.find(keys))
    assert (found[1::2] == 0).all() and np.allclose(found[::2], counts[::2], rtol=1e-3)


def test_licenses(spark, awkward, nothing):
    texts = {
        1: "Licensed under the Apache License, Version 2.0. And MIT  licensed; the MIT-License.", 2: "GNU General  Public License", 3: "Copyright (c) 2020 Some One All rights reserved",
        4: "Released under the terms of the MIT License.", 5: "Licensed under CC BY-NC 4.0.", 6: "nothing here", 7: None, 8: "éapache license", 9: "licensed under the apache license version 3",
        10: "the mit\u00a0license\u3000mit license",
    }
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    picked = {i: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for i, r in got.items()}
    assert picked == {
        1: (14, 2, 3, 12, "apache,mit", "apache,apache-2.0,mit"), 2: (4, 1, 0, 0, "gpl", "gpl"), 3: (8, 0, None, None, "", "copyright"), 4: (8, 1, 6, 6, "mit", "mit,mit-notice"),
        5: (7, 1, 2, 2, "cc-by", "cc-by,cc-by-nc-4.0"), 6: (2, 0, None, None, "", ""), 7: (0, 0, None, None, "", ""), 8: (2, 0, None, None, "", ""), 9: (7, 1, 3, 3, "apache", "apache"),
        10: (3, 0, None, None, "", ""),
    }
    assert licenses.scan(awkward).count() == 9 and licenses.scan(nothing).count() == 0


def test_chat_round_trip(spark):
    rows = [
        (1, 1, "assistant", "a\\### </turn> b"), (1, 0, "user", "hi"), (2, 0, "user", None), (2, 1, None, "x"), (3, None, "assistant", "first"), (None, 0, "user", "q"),
        (4, 0, "tool: \\###", "####"), (1, 2, "user", "\\"), (5, 0, "user", LONG), (5, 0, "user", LONG),
    ]
    turns = spark.createDataFrame([(*r, "c") for r in rows], "conv_id bigint, turn bigint, role string, text string, loss string")
    got = {r.conv_id: r for r in chat.digests(chat.segments(turns)).collect()}
    order = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] or -9, -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        order[conv].append((role or "", text or ""))
    assert got.keys() == order.keys()
    for conv, own in order.items():
        loss = "".join(t for r, t in own if r == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {c: r.valid for c, r in got.items()} == {1: True, 2: False, 3: False, None: True, 4: False, 5: False}
    assert chat.digests(chat.segments(turns.where("false"))).count() == 0


def test_decontamination(spark, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    made = QUERIES["op7_decontamination"](spark, SF).collect()
    whole = {(d, i) for d, t in documents for i, x in items if x in (t or "")}
    assert {(r.doc_id, r.item_id) for r in made} == whole


def test_decontamination_of_changed_slots(spark):
    item = "if Anna buys 3 apples and 5 pears at the market and gives 3 apples to Ben how many pieces of fruit does Anna have left"
    texts = {
        1: f"before {item} after", 2: item.replace("3", "8").replace("Anna", "Maria").replace("Ben", "Tom"),
        3: item.replace("gives 3", "gives 4"), 4: None, 5: "", 6: "other words entirely, and not a copy of it at all", 7: item.split(" pieces")[0],
    }
    docs = spark.createDataFrame([*texts.items(), (1, f"before {item} after"), (None, item)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(9, item), (8, None), (7, "too short"), (None, item)], "item_id bigint, text string")
    got = decontaminate.contaminated(docs, bench).collect()
    # 3 tells of two values for one slot of the item, 7 holds too little of it.
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 9), (2, 9)]
    assert sorted(r.doc_id or 0 for r in decontaminate.clean(docs, bench).collect()) == [0, 3, 4, 5, 6, 7]
    assert decontaminate.contaminated(docs, bench.where("false")).count() == 0


def test_html(spark):
    made = {r.page_id: r for r in QUERIES["op8_html_extraction"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(made) == len(pages)
    for p in pages:
        inner = re.search(r"<article>(.*?)(</article>|$)", p.html, re.S)[1]
        lines = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in re.split(r"</?(?:p|h1|br)>", inner)]
        text = "\n".join(x for x in lines if x)
        assert (made[p.page_id].text, made[p.page_id].n_chars) == (text, len(text))


def test_html_unclosed_elements():
    page = "<article><p>one<p class='ad'>buy<p>two<ul><li class=promo>now<li>three</ul><div><p>four</div>five</article>"
    assert html_text.main_text(page, []) == "one\ntwo\nthree\nfour\nfive"


def test_html_differencing(spark):
    def page(k: int) -> str:
        return f"<body><div>Welcome to the site</div><p>Own text {k} &lt;here&gt;</p><div>All rights reserved</div><aside>menu {k}</aside>"

    rows = [(k, f"http://h.net/a/{k}", page(k)) for k in range(9)]
    rows += [(20, None, None), (21, "http://x.net/", ""), (22, "http://y.net/", "<p>a<script>var t='</p>'</script>b <i>c</i>\n d<"), (0, "http://h.net/a/0", page(0))]
    got = html_text.extract(spark.createDataFrame([(*r, "t") for r in rows], "page_id bigint, url string, html string, text string")).collect()
    assert sorted((r.page_id, r.text) for r in got) == sorted([*((k, f"Own text {k} <here>") for k in (0, *range(9))), (20, ""), (21, ""), (22, "a\nb c d<")])
    assert html_text.common([1, 2, 3, 4, 5], [2, 9, 4, 3, 5]) in ([1, 2, 4], [1, 3, 4])
    assert html_text.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_packing(spark, awkward, nothing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(-1, None), (-2, ""), (-3, LONG), (-4, "It's <|endoftext|>. E\u0301É!! »x«, don't\u3000go")], "doc_id bigint, text string")
    )
    made = packing.pack(docs, tokenizer_path()).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in made:
        assert r.ids_crc32 == zlib.crc32(np.array(r.input_ids, "<u4").tobytes()) and len(r.input_ids) == r.length
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for d in docs.collect():
        own = sorted(pieces[d.doc_id], key=lambda r: r.start)
        ids = [i for r in own for i in r.input_ids]
        assert ids == [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 1] and all(r.doc_tokens == len(ids) for r in own)
        assert [r.start for r in own] == list(np.cumsum([0, *(r.length for r in own)])[:-1])
    padded = 0
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        size = sum(r.length for r in own)
        assert size <= 2048 and [r.offset for r in own] == list(np.cumsum([0, *(r.length for r in own)])[:-1])
        padded += 0 if size & (size - 1) == 0 else 2048 - size
    assert padded == 0
    assert packing.pack(awkward, tokenizer_path(), ids=False).count() > 9 and packing.pack(nothing, tokenizer_path()).count() == 0


def test_packing_limits():
    packer = packing.Packer(packing.Limits(tokens=64, segments=3, loss=40, waiting=8), 0)
    rng = np.random.default_rng(3)
    items = [packing.Item(k, np.arange(n), int(n // 3)) for k, n in enumerate(rng.integers(1, 150, 200))]
    for item in items:
        packer.add(item)
    packer.end()
    held, loss, count = Counter(), Counter(), Counter()
    for item, start, n, sequence, _ in packer.pieces:
        held[sequence] += n
        count[sequence] += 1
        loss[sequence] += n - min(n, max(0, item.silent - start))
    assert max(held.values()) <= 64 and max(count.values()) <= 3 and max(loss.values()) <= 40
    assert sum(held.values()) == sum(len(i.ids) for i in items)
