"""HTML extraction: each page is compared with the page of the nearest URL on its host; lines that both have are template.

Method. The markup gives text blocks in page order, each in a zone: article (inside `article` or `main`), frame (inside `nav`,
`header`, `footer`, `aside`, forms and the like, or an element whose class or id says so; the headings of an
article's own header are article), or open (neither). Pages are sorted by
host and path; of the page before and the page after, the one with the longer common beginning of the path is the pair. The blocks
of both are aligned by a longest common subsequence, and the common ones are shared lines.

Shared lines are deleted outside the article. Inside it they stay: copies of an article lie side by side on a host, and lines that
articles share are still their text. If a page has an article, that is its text; otherwise it is the open blocks that its pair
does not share (all of them if the pair shares every one: then the pages are copies and tell nothing). Lines of the frame zone are
deleted whether shared or not, since navigation and adverts often differ between neighbours.

Only ids, URLs and one hash per block are sorted and compared; the pages themselves are joined once with the numbers of their
shared lines. A host of any size is spread over the tasks by its paths; the pairs that fall on the edges of tasks are made from one
row at each side.

Defined cases. NULL or empty html gives an empty text. NULL URLs have an empty host and path and are paired among themselves.
Equal rows are compared once and get equal results; a page without a neighbour on its host has no shared lines. Broken markup:
paragraphs and items end with the next one, other unclosed elements with the page; a tag cut off at the end is dropped.
Pages of any length are used whole.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import in_rows, stored
from fleetlens.llm.url_trie import split

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)", re.S
)
SPACE = re.compile(r"[\s\x00]+")
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# Elements whose content is not text.
RAW = frozenset("script style noscript template textarea iframe svg canvas object select".split())
FRAME = frozenset("head nav header footer aside form menu dialog button fieldset".split())
FRAME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disclaimer footer "
    "header login masthead menu modal nav navbar navigation newsletter notice popup promo promotion related replies reply share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget alert complementary contentinfo search".split()
)
# What a class name may end with, without changing what it names: the share bar and the comment list are frames, the notice board is not.
TAILS = frozenset(
    "area bar bars block blocks body bottom box boxes button buttons container content group icons inner item items left link links list message "
    "outer panel posts right row section slot small large stories text thread title top unit widgets wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE = frozenset("article main".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub "
    "sup time tt u var wbr".split()
)
# Elements that the next one of the same line ends, if their own end is missing.
SIBLINGS = ({"li"}, {"dd", "dt"}, {"td", "th"}, {"tr"}, {"option"})
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OPEN, ARTICLE_ZONE, FRAME_ZONE = 0, 1, 2


def says_frame(name: str) -> bool:
    """Whether a class, id or role names a frame: by its last part that is no number and no general ending."""
    parts = [part for part in re.split(r"[_-]+", name) if part]
    while len(parts) > 1 and (parts[-1] in TAILS or parts[-1].isdigit()):
        parts.pop()
    return bool(parts) and parts[-1] in FRAME_WORDS


def is_frame(tag: str, attributes: str, inside: int = OPEN) -> bool:
    """Whether an element in zone `inside` is a frame. The page's own article is none whatever its class; one inside it may be a comment."""
    if tag in FRAME:
        return True
    if tag in ("html", "body") or tag in ARTICLE and inside == OPEN or "=" not in attributes:
        return False
    return any(says_frame(name) for values in NAMES.findall(attributes) for name in "".join(values).lower().split())


def heads_article(opened: list[tuple[str, int]]) -> bool:
    """Whether the frame that is open is the `header` of an article, and no other frame inside it."""
    frames = [(tag, outside) for tag, outside in opened if tag in FRAME or outside == FRAME_ZONE]
    return bool(frames) and frames[0] == ("header", ARTICLE_ZONE) and not any(tag in FRAME for tag, _ in frames[1:])


def blocks(page: str | None) -> list[tuple[str, int]]:
    """(text, zone) of the blocks of a page, in order."""
    page = page or ""
    out: list[tuple[str, int]] = []
    text: list[str] = []
    opened: list[tuple[str, int]] = []  # element, zone outside it
    zone, at = OPEN, 0
    hidden: tuple[str, int] | None = None  # an open inline frame, and how much of the block comes before it
    depth = 0

    def flush() -> None:
        line = SPACE.sub(" ", html.unescape("".join(text))).strip()
        text.clear()
        if line:
            out.append((line, zone))

    while True:
        token = TOKEN.search(page, at)
        text.append(page[at : token.start() if token else len(page)])
        if token is None:
            break
        at = token.end()
        closing, tag, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE and not (closing and any(t == tag for t, _ in opened)):
            # An inline frame goes, and the text around it stays one block.
            if hidden and tag == hidden[0]:
                depth += -1 if closing else 1
                if not depth:
                    del text[hidden[1] :]
                    hidden = None
            elif not hidden and not closing and tag not in VOID and zone != FRAME_ZONE and not attributes.endswith("/") and is_frame(tag, attributes, zone):
                hidden, depth = (tag, len(text)), 1
            continue
        if hidden:
            del text[hidden[1] :]
        flush()
        if hidden:
            # Blocks inside an inline frame are of the frame, up to its end.
            opened.append((hidden[0], zone))
            zone, hidden = FRAME_ZONE, None
        if closing:
            if any(t == tag for t, _ in opened):
                while True:
                    name, zone = opened.pop()
                    if name == tag:
                        break
            continue
        # A paragraph is ended by the next block, an item by the next item.
        if opened and (opened[-1][0] == "p" or any(opened[-1][0] in s and tag in s for s in SIBLINGS)):
            zone = opened.pop()[1]
        if tag in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID or attributes.endswith("/") or tag in ("p", "li", "tr", "td", "th", "dd", "dt", "option") and not is_frame(tag, attributes, zone):
            continue
        opened.append((tag, zone))
        if zone == FRAME_ZONE:
            zone = ARTICLE_ZONE if tag in HEADINGS and heads_article(opened[:-1]) else FRAME_ZONE
        else:
            zone = FRAME_ZONE if is_frame(tag, attributes, zone) else ARTICLE_ZONE if tag in ARTICLE else zone
    if hidden:
        del text[hidden[1] :]
    flush()
    return out


def common(a: list[int], b: list[int]) -> list[int]:
    """Positions in `a` of a longest common subsequence with `b`: the longest increasing run of matching positions."""
    places: dict[int, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []
    links: list[tuple[int, object]] = []
    for i, x in enumerate(a):
        for j in places.get(x, ()):
            k = bisect_left(ends, j)
            before = links[k - 1] if k else None
            if k == len(ends):
                ends.append(j)
                links.append((i, before))
            elif ends[k] != j:
                ends[k], links[k] = j, (i, before)
    out, link = [], links[-1] if links else None
    while link:
        out.append(link[0])
        link = link[1]
    return out[::-1]


def prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)


ROW = "key bigint, host string, path string, lines array<int>"
PAIRED = ROW + ", before struct<host: string, path: string, lines: array<int>>, after struct<host: string, path: string, lines: array<int>>, edge boolean"


def neighbours(rows: DataFrame) -> DataFrame:
    """Each row with the rows before and after it in the order of host, path and key."""
    spread = rows.repartitionByRange("host", "path", "key").sortWithinPartitions("host", "path", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("lines", pa.list_(pa.int32()))])
        side = pa.struct([("host", pa.string()), ("path", pa.string()), ("lines", pa.list_(pa.int32()))])
        full = schema.append(pa.field("before", side)).append(pa.field("after", side)).append(pa.field("edge", pa.bool_()))
        last = None

        def emit(made: list[dict[str, object]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(made, schema=full)

        def beside(row: dict[str, object]) -> dict[str, object]:
            return {c: row[c] for c in ("host", "path", "lines")}

        for batch in batches:
            made = []
            for row in batch.to_pylist():
                row |= {"before": last and beside(last), "after": None, "edge": last is None}
                if last is not None:
                    last["after"] = beside(row)
                    made.append(last)
                last = row
            yield emit(made)
        if last is not None:
            yield emit([last | {"edge": True}])

    made = stored(spread.mapInArrow(run, PAIRED), "neighbours")
    order = Window.orderBy("host", "path", "key")
    own = F.struct("host", "path", "lines")
    # Two rows of each task, whatever the number of pages.
    edges = made.where("edge").select(
        "key", "host", "path", "lines", F.coalesce("before", F.lag(own).over(order)).alias("before"), F.coalesce("after", F.lead(own).over(order)).alias("after"), "edge"
    )
    return made.where("NOT edge").unionByName(edges)


def shared_lines(pages: DataFrame) -> DataFrame:
    """(key, shared): the numbers of the blocks that a page shares with its pair; `key` is the hash of url and html."""

    def parse(columns: dict[str, pa.Array]) -> dict[str, object]:
        hosts = [split(u) for u in columns["url"].to_pylist()]
        lines = [[xxhash.xxh32_intdigest(t.encode()) - 2**31 for t, _ in blocks(p)] for p in columns["html"].to_pylist()]
        return {"key": columns["key"], "host": [h for h, _ in hosts], "path": [p for _, p in hosts], "lines": lines}

    def align(columns: dict[str, pa.Array]) -> dict[str, object]:
        shared = []
        for host, path, lines, *sides in zip(*(columns[c].to_pylist() for c in ("host", "path", "lines", "before", "after")), strict=True):
            near = [(prefix(path, s["path"]), -k, s["lines"]) for k, s in enumerate(sides) if s and s["host"] == host]
            shared.append(common(lines, max(near, key=lambda x: x[:2])[2]) if near else [])
        return {"key": columns["key"], "shared": shared}

    rows = in_rows(pages, ["key", "url", "html"], ROW, parse).dropDuplicates(["key"])
    return in_rows(neighbours(rows), ["key", "host", "path", "lines", "before", "after"], "key bigint, shared array<int>", align)


def main_text(page: str | None, shared: list[int]) -> str:
    lines = blocks(page)
    article = [t for t, zone in lines if zone == ARTICLE_ZONE]
    if article:
        return "\n".join(article)
    common_lines = set(shared)
    left = [t for k, (t, zone) in enumerate(lines) if zone == OPEN and k not in common_lines]
    return "\n".join(left or [t for t, zone in lines if zone == OPEN])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_shared (blocks that the page shares with its pair)."""
    keyed = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).withColumn("key", F.xxhash64(F.col("url").isNull(), "url", "html"))
    joined = keyed.join(shared_lines(keyed), "key", "left")

    def work(columns: dict[str, pa.Array]) -> dict[str, object]:
        shared = [s or [] for s in columns["shared"].to_pylist()]
        texts = [main_text(p, s) for p, s in zip(columns["html"].to_pylist(), shared, strict=True)]
        return {"page_id": columns["page_id"], "url": columns["url"], "text": texts, "n_chars": [len(t) for t in texts], "n_shared": [len(s) for s in shared]}

    return in_rows(joined, ["page_id", "url", "html", "shared"], "page_id bigint, url string, text string, n_chars bigint, n_shared bigint", work)
