"""What the markup says of a block, beside the cases of the given pages."""

from __future__ import annotations

import pytest

from fleetlens.llm import html_text

PAGES = [
    ("<main><p>Body</p><article class='comment'><p>Reader says hi</p></article><p>End</p></main>", "Body\nEnd"),
    ("<article class='comment'><p>The page's own article</p></article>", "The page's own article"),
    ("<article><header><h1>The <i>title</i></h1><p>Share this</p><nav><h2>Menu</h2></nav></header><p>Text</p></article>", "The title\nText"),
    ("<header><h1>Site</h1></header><article><p>Text</p><aside><h2>Related</h2></aside></article>", "Text"),
    ("<article><p class='notice-board'>On the board</p><p class='notice'>Closed</p><div class='share-bar'>Share</div><p class='ad_slot-12'>Buy</p></article>", "On the board"),
    ("<article><p class='ad-free loadable'>No adverts</p><div id='comment-list'><p>First!</p></div><p class='badge'>Won</p></article>", "No adverts\nWon"),
    ("<article><p>see <a class='share'>this <a>x</a> and</a> the link</p></article>", "see the link"),
    ("<article><p>one <span class=ad>buy <b>now</b></span>two <i>three</i></p></article>", "one two three"),
    ("<article><span class='ad'>a<div>buy</div>b</span><p>kept</p></article>", "kept"),
    ("<article><p>start <span class='promo'>never closed</p><p>in the frame", "start"),
    ("<article><p>start <em class='lead'>kept</em> <img class='ad'> end", "start kept end"),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_zones(page, text):
    assert html_text.main_text(page, []) == text


def test_very_long_page(spark):
    lines = [f"line {k} of the log" for k in range(100_000)]
    page = "<nav>menu</nav><article>" + "".join(f"<p>{line}</p>" for line in lines) + "</article>"
    rows = [(1, "http://h.net/" + "a/" * 10_000, page, "clash"), (2, "http://h.net/b", "<div class='ad'>x</div>", "clash")]
    got = {r.page_id: r for r in html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, shared string")).collect()}
    assert got[1].text == "\n".join(lines) and got[1].n_chars == len(got[1].text)
    assert got[2].text == ""
