"""The SQL twin of the license scan states the whole rule: regions without word limits, wording to the end."""

from __future__ import annotations

import re

import duckdb
import pyarrow as pa

from fleetlens.llm import licenses
from fleetlens.llm.oracles import OP5

LONG = " ".join(f"holder{k}" for k in range(30))
FILL = {"[a-z]+": "Software", ".+": LONG, "[0-9a-z]": "1", "(non)?infringement": "noninfringement", "[0-9]{4}": "2010"}


def filled(label: str, optional: bool) -> str:
    text = re.sub(r'<<var;match="(.*?)">>', lambda m: FILL[m[1]], licenses.TEMPLATES[label])
    while not optional and "<<begin" in text:
        text = re.sub("<<beginOptional>>(?:(?!<<(?:begin|end)Optional).)*<<endOptional>>", "", text)
    return re.sub("<<(begin|end)Optional>>", "", text)


def test_twin_and_query_agree_on_planted_licences(spark):
    texts = [filled(label, optional) for label in licenses.TEMPLATES for optional in (True, False)]
    texts += [t.rsplit(" ", 1)[0] for t in texts] + [f"Before it. {t} And after." for t in texts]
    texts += [filled("mit-text", True).replace("WARRANTY", "PROMISE"), f"Copyright 2010 {LONG} all rights", "CC BY and the MIT License; Apache License", "", None]
    texts += [" ".join(texts[:4]), filled("bsd", True).replace("holder3", "(c)"), "copyright 2010 2011 x all rights reserved all rights reserved"]
    rows = [(k, t) for k, t in enumerate(texts)]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([k for k, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows], pa.string())}))
    made = con.sql(OP5)
    theirs = sorted(made.fetchall())
    got = sorted(tuple(r) for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).select(*made.columns).collect())
    assert got == theirs
    found = {label for r in got for label in r[made.columns.index("labels")].split(",")}
    assert licenses.TEMPLATES.keys() <= found
