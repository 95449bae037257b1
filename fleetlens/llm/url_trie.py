"""URL filters: a trie over reversed host labels and path segments, with the longest entry winning.

Method. Entries (action, host, path) form a trie: first the labels of the host from the right, then the segments of the path. The
last segment of an entry is a prefix: `/en/1` fits `/en/17`, `/es/` fits all below. A url takes the entry with the most host labels
and, among those, the longest path; a block entry wins over an equal allow entry. A url that no entry fits is judged by the words
of its host (split at dots and hyphens): blocked if one of them is a blocked word, else allowed. The trie goes to the tasks with
the function; its size is that of the list of entries, which the caller states.

Defined cases. A NULL url or one without `://` has an empty host and path, no rule, and is allowed. Only the id and url are read.
Repeated rows get their own, equal result; NULL ids pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from fleetlens.llm.common import in_rows

URL = re.compile(r"://([^/?#]*)([^?#]*)")
LOWER = {c: c + 32 for c in range(65, 91)}

RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
BLOCKED_WORDS = frozenset({"casino", "pills", "spam"})


@dataclass
class Paths:
    """Path segments below a host; `ends` maps a prefix of the next segment to its entry."""

    below: dict[str, Paths] = field(default_factory=dict)
    ends: dict[str, tuple[str, str]] = field(default_factory=dict)


@dataclass
class Hosts:
    below: dict[str, Hosts] = field(default_factory=dict)
    paths: Paths | None = None


def build(rules: Iterable[tuple[str, str, str]]) -> Hosts:
    root = Hosts()
    for action, host, path in rules:
        node = root
        for label in reversed(host.translate(LOWER).split(".")):
            node = node.below.setdefault(label, Hosts())
        node.paths = at = node.paths or Paths()
        *segments, last = path.split("/")
        for segment in segments:
            at = at.below.setdefault(segment, Paths())
        if at.ends.get(last, ("allow", ""))[0] == "allow":
            at.ends[last] = (action, host + path)
    return root


def split(url: str | None) -> tuple[str, str]:
    found = URL.search(url or "")
    return (found[1].translate(LOWER), found[2]) if found else ("", "")


def longest(paths: Paths, path: str) -> tuple[str, str] | None:
    """The entry with the longest path that `path` starts with."""
    best = None
    for segment in path.split("/"):
        fits = [p for p in paths.ends if segment.startswith(p)]
        if fits:
            best = paths.ends[max(fits, key=len)]
        if segment not in paths.below:
            return best
        paths = paths.below[segment]
    return best


def match(root: Hosts, host: str, path: str) -> tuple[str, str] | None:
    best, node = None, root
    for label in reversed(host.split(".")):
        node = node.below.get(label)
        if node is None:
            break
        best = (node.paths and longest(node.paths, path)) or best
    return best


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, blocked: frozenset[str] = BLOCKED_WORDS) -> DataFrame:
    """page_id, host, path, rule, verdict."""
    root = build(rules)

    def work(columns: dict[str, pa.Array]) -> dict[str, object]:
        hosts, paths, names, verdicts = [], [], [], []
        for url in columns["url"].to_pylist():
            host, path = split(url)
            entry = match(root, host, path)
            hosts.append(host)
            paths.append(path)
            names.append(entry and entry[1])
            verdicts.append(entry[0] if entry else "allow" if blocked.isdisjoint(re.split(r"[.-]", host)) else "block")
        return {"page_id": columns["page_id"], "host": hosts, "path": paths, "rule": names, "verdict": verdicts}

    return in_rows(pages, ["page_id", "url"], "page_id bigint, host string, path string, rule string, verdict string", work)
