"""License scans: licence templates with optional and replaceable regions, compiled into token automata.

Method. A template is text with the marks <<beginOptional>>, <<endOptional>> and <<var;match="...">>. It is compiled into an
automaton over words: a mandatory word has one edge, an optional region may be passed by, and a replaceable region is a state
that loops on its pattern: it takes one word or more, however many, each of which fits as a whole. The automaton accepts at a place
if the mandatory wording is there exactly, in order. It runs once from the end of a text to its beginning, over the states from
which it can accept, so a text costs its length, whatever the number of places. Beside that, short phrases give base labels.

Words are runs of a-z, 0-9 and characters beyond ASCII, after A-Z are lower-cased. The score is 1 with an accepted template, 0.5
with base labels alone, else 0.

Defined cases. A NULL or empty text has no words and no labels (empty strings, NULL positions, score 0). Repeated rows get equal
results; NULL ids pass through. Only the id and text are read; texts are scanned whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fleetlens.llm.common import Words, byte_texts, in_slices

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Wording of licences and licence notices: fixed values.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "cc-by-4.0": "Licensed under <<beginOptional>>a <<beginOptional>>Creative Commons<<endOptional>> <<endOptional>>CC BY 4.0",
    "cc-by-nc-4.0": "Licensed under <<beginOptional>>a <<endOptional>>CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under <<beginOptional>>a <<endOptional>>CC BY-SA 4.0",
    "gpl-2.0": "licensed under the <<beginOptional>>terms of the <<endOptional>>GNU General Public License, <<beginOptional>>either <<endOptional>>version 2",
    "gpl-3.0": "licensed under the <<beginOptional>>terms of the <<endOptional>>GNU General Public License, <<beginOptional>>either <<endOptional>>version 3",
    "mit-notice": "Released under the <<beginOptional>>terms of the <<endOptional>>MIT License",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and <<beginOptional>>to any "
        "<<endOptional>>associated documentation files (the <<var;match=\"[a-z]+\">>), to deal in the <<var;match=\"[a-z]+\">> without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "<<var;match=\"[a-z]+\">>, and to permit persons to whom the <<var;match=\"[a-z]+\">> is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph) <<endOptional>>shall be "
        "included in all copies or substantial portions of the <<var;match=\"[a-z]+\">>. THE <<var;match=\"[a-z]+\">> IS PROVIDED \"AS IS\", WITHOUT "
        "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND <<beginOptional>>NON-<<endOptional>><<var;match=\"(non)?infringement\">>. IN NO EVENT SHALL <<var;match=\".+\">> BE LIABLE FOR ANY "
        "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "<<var;match=\"[a-z]+\">> OR THE USE OR OTHER DEALINGS IN THE <<var;match=\"[a-z]+\">>"
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: <<beginOptional>><<var;match=\"[0-9a-z]\">> <<endOptional>>Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. <<beginOptional>><<var;match=\"[0-9a-z]\">> <<endOptional>>Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. <<beginOptional>><<beginOptional>><<var;match=\"[0-9a-z]\">> <<endOptional>>All advertising "
        "materials mentioning features or use of this software must display the following acknowledgement: This product includes software "
        "developed by <<var;match=\".+\">>. <<endOptional>><<beginOptional>><<beginOptional>><<var;match=\"[0-9a-z]\">> <<endOptional>>Neither the name of "
        "<<var;match=\".+\">> may be used to endorse or promote products derived from this software without specific prior written permission. "
        "<<endOptional>>THIS SOFTWARE IS PROVIDED BY <<var;match=\".+\">> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED "
        "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;match=\".+\">> BE "
        "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
        "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
        "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"
    ),
    "copyright": "Copyright <<beginOptional>>(c) <<endOptional>><<var;match=\"[0-9]{4}\">> <<var;match=\".+\">> All rights reserved",
}

TABLE = bytes(b + 32 if 65 <= b < 91 else b if 48 <= b < 58 or 97 <= b < 123 or b > 127 else 32 for b in range(256))
MARK = re.compile(r"<<(beginOptional|endOptional|var;match=\"[^\"]*\")>>")


def words_of(text: str) -> list[str]:
    return text.encode().translate(TABLE).decode().split(" ")


@dataclass
class Automaton:
    """States are numbers from 0; `final` accepts. A free edge takes no word, a pattern edge one word that it matches fully."""

    word: list[tuple[int, str, int]] = field(default_factory=list)
    pattern: list[tuple[int, re.Pattern[str], int]] = field(default_factory=list)
    free: list[tuple[int, int]] = field(default_factory=list)
    final: int = 0

    @cached_property
    def before(self) -> dict[int, set[int]]:
        """For a state, itself and the states from which free edges lead to it."""
        out = {s: {s} for s in range(self.final + 1)}
        for s, found in out.items():
            todo = [s]
            while todo:
                b = todo.pop()
                for a in {a for a, x in self.free if x == b} - found:
                    found.add(a)
                    todo.append(a)
        return out

    @cached_property
    def by_word(self) -> dict[str, list[tuple[int, int]]]:
        out: dict[str, list[tuple[int, int]]] = {}
        for a, x, b in self.word:
            out.setdefault(x, []).append((a, b))
        return out

    @cached_property
    def by_target(self) -> dict[int, list[tuple[int, re.Pattern[str]]]]:
        out: dict[int, list[tuple[int, re.Pattern[str]]]] = {}
        for a, p, b in self.pattern:
            out.setdefault(b, []).append((a, p))
        return out

    def accepted(self, words: list[str]) -> list[int]:
        """The places from which a run reaches the final state, in order."""
        out: list[int] = []
        done = self.before[self.final]
        live = set(done)
        for k in range(len(words) - 1, -1, -1):
            w = words[k]
            step = {a for a, b in self.by_word.get(w, ()) if b in live}
            for b in live & self.by_target.keys():
                step.update(a for a, p in self.by_target[b] if p.fullmatch(w))
            live = set(done).union(*(self.before[a] for a in step))
            if 0 in live:
                out.append(k)
        return out[::-1]

    def firsts(self) -> set[str]:
        """Words that a run can begin with."""
        return {x for a, x, _ in self.word if 0 in self.before[a]}


def compile_template(template: str) -> Automaton:
    made, state, opened = Automaton(), 0, []
    for k, part in enumerate(MARK.split(template)):
        if k % 2 == 0:
            for w in filter(None, words_of(part)):
                made.word.append((state, w, state + 1))
                state += 1
        elif part == "beginOptional":
            opened.append(state)
            made.free.append((state, state + 1))
            state += 1
        elif part == "endOptional":
            made.free += [(state, state + 1), (opened.pop(), state + 1)]
            state += 1
        else:
            pattern = re.compile(part[len('var;match="') : -1])
            made.pattern += [(state, pattern, state + 1), (state + 1, pattern, state + 1)]
            state += 1
    if opened:
        raise ValueError("an optional region is not closed")
    made.final = state
    return made


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and where templates begin."""
    automata = {label: compile_template(t) for label, t in templates.items()}
    begins = {label: a.firsts() for label, a in automata.items()}
    sought = [(p.split(" "), label) for p, label in phrases.items()]
    # A text can only match if it holds one of these words.
    keys = {p[0] for p, _ in sought} | {w for first in begins.values() for w in first}
    key_bytes = {k.encode() for k in keys}

    def base_places(words: list[str]) -> list[tuple[int, str]]:
        return [(i, label) for i in range(len(words)) for p, label in sought if words[i : i + len(p)] == p]

    def work(texts: pa.Array, others: dict[str, pa.Array]) -> dict[str, object]:
        plain = pa.array([t.translate(TABLE) for t in byte_texts(texts)], pa.binary()).cast(pa.string())
        found = Words(plain)
        marked = np.fromiter((w in key_bytes for w in found.words), bool, len(found.dictionary))
        rows = len(texts)
        out = {"doc_id": others["doc_id"], "n_words": found.counts, "n_base": np.zeros(rows, np.int64), "first_word": [None] * rows, "last_word": [None] * rows}
        base, every, score, starts = [""] * rows, [""] * rows, np.zeros(rows), [[] for _ in range(rows)]
        hit = np.unique(found.doc[marked[found.codes]]) if len(found.codes) else []
        for i in hit:
            words = [w for w in plain[int(i)].as_py().split(" ") if w]
            places = base_places(words)
            held = keys.intersection(words)
            own = sorted((k, n, label) for n, (label, a) in enumerate(automata.items()) if held & begins[label] for k in a.accepted(words))
            if places:
                out["n_base"][i] = len(places)
                out["first_word"][i], out["last_word"][i] = places[0][0], places[-1][0]
            base[i] = ",".join(sorted({label for _, label in places}))
            every[i] = ",".join(sorted({label for *_, label in [*places, *own]}))
            score[i] = 1.0 if own else 0.5 if places else 0.0
            starts[i] = [k for k, *_ in own]
        return {**out, "base_labels": base, "labels": every, "score": score, "template_words": starts}

    schema = (
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
        "template_words array<bigint>"
    )
    return in_slices(docs, ["doc_id", "text"], schema, work)
