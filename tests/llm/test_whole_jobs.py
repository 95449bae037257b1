"""Cases in which an operator once did less than its whole job."""

from __future__ import annotations

import re

from fleetlens.llm import decontaminate, html_text, licenses, minhash


def test_decontamination_finds_copies_whose_case_was_changed(spark):
    item = "How many meters does Anna's train from Straßburg travel in 12 hours if it stops for the red signal twice a day?"
    near = "How many meters does Berta's train from Metz travel in 15 hours if it stops for the red signal twice a day?"
    other = "HOW MANY PEOPLE DOES THE LAST TRAIN FROM HERE TAKE IF NOBODY STOPS IT AT ALL?"
    texts = [item.upper(), "So: " + item.lower() + " Well.", item.title(), near, near.upper(), other, other.lower()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame([(9, item)], "item_id bigint, text string")
    got = {r.doc_id: r.share for r in decontaminate.contaminated(docs, bench).collect()}
    # 4 is no copy, and its words are all names of the item's template.
    assert got == {0: 1.0, 1: 1.0, 2: 1.0, 3: 1.0}
    assert sorted(r.doc_id for r in decontaminate.clean(docs, bench).collect()) == [4, 5, 6]


def test_one_of_each_keeps_rows_without_id_and_other_texts(spark):
    one, two = "the first text is about a boat", "the second text tells of nets and fish"
    rows = [(None, one), (None, one), (None, two), (1, one), (1, one), (2, two), (2, "another text that shares the id"), (3, None), (3, None), (4, two)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted(((r.doc_id or 0, r.text or "") for r in minhash.one_of_each(docs, minhash.Rule()).collect()))
    assert kept == sorted([(0, one), (0, one), (0, two), (1, one), (2, two), (2, "another text that shares the id"), (3, "")])


def test_licenses_without_word_limits(spark):
    long = " ".join(f"holder{k}" for k in range(30))
    fill = dict(zip(("[a-z]+", ".+", "[0-9a-z]", "(non)?infringement", "[0-9]{4}"), ("Software", long, "1", "noninfringement", "2010"), strict=True))

    def filled(label: str) -> str:
        text = re.sub(r'<<var;match="(.*?)">>', lambda m: fill[m[1]], licenses.TEMPLATES[label])
        return re.sub("<<(begin|end)Optional>>", "", text)

    nine = "Copyright 2010 The Regents of the University of California and others. All rights reserved"
    texts = [nine, f"Copyright (c) 2010 2011 {long} All rights reserved.", f"Copyright 2010 {long}", filled("mit-text"), filled("bsd")]
    texts += [t.replace("WARRANT", "PROMISE") for t in texts[3:]] + [t[:300] for t in texts[3:5]] + ["copyright 2010 " * 20_000 + "all rights reserved"]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert [r.labels for r in got] == ["copyright", "copyright", "", "mit-text", "bsd", "", "", "", "", "copyright"]
    assert len(got[-1].template_words) == 20_000 - 1


def test_html_differencing_decides_without_articles(spark):
    lines = "<div>Welcome to the site</div><p>Own text {}</p><div>All rights reserved</div>"
    rows = [(k, f"http://h.net/a/{k}", lines.format(k)) for k in range(4)]
    rows += [(k, f"http://m.net/a/{k}", f"<article>{lines.format(k)}</article>") for k in range(10, 14)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.page_id: r.text for r in got if r.page_id < 10} == {k: f"Own text {k}" for k in range(4)}
    assert all("Welcome to the site" in r.text for r in got if r.page_id >= 10)
    assert all(r.n_shared == 2 for r in got)
