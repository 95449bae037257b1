"""Decontamination: scripts without spaces, short items, changed slots, awkward tables; and the twin over planted rows."""

from __future__ import annotations

import duckdb
import pytest

from fleetlens.llm import decontaminate
from fleetlens.llm.oracles import ORACLES

CHINESE = "一艘渔船以每小时十二海里的速度航行三小时后又以每小时八海里的速度航行两小时它一共航行了多少海里"
THAI = "เรือประมงแล่นด้วยความเร็วสิบสองไมล์ต่อชั่วโมงเป็นเวลาสามชั่วโมง"
LONG_ITEM = "a net holds 40 kg of cod and the crew of Anna hauls it 12 times before the storm drives them home"
ITEMS = {1: CHINESE, 2: THAI, 3: "why do whales sing", 4: "anchor", 5: "Bergen 12 km", 6: LONG_ITEM, 7: "", 8: None, 9: "grüße ΟΔΟΣ an alle"}
WORDS = " ".join(f"filler{k}" for k in range(500))
TEXTS = {
    1: CHINESE,
    2: f"Es steht geschrieben: {CHINESE}。Ende",
    3: CHINESE[:12],
    4: THAI,
    5: "and WHY do whales\n sing? nobody knows, why do whales sing",
    6: "why do some whales sing",
    7: "Anchor!",
    8: "the anchor holds",
    9: "Bergen 12 km",
    10: f"{WORDS} {LONG_ITEM.replace('40', '75').replace('Anna', 'Berta').replace('12', '9')} {WORDS}",
    11: LONG_ITEM.upper(),
    12: "",
    13: None,
    14: "GRÜSSE οδος an ALLE",
    15: "海里",
}
FOUND = {(1, 1), (2, 1), (4, 2), (5, 3), (7, 4), (10, 6), (11, 6), (14, 9)}


@pytest.fixture(scope="module")
def tables(spark):
    """Repeated rows, NULL ids and columns named like results."""
    docs = [(k, t, k, "x", 0.5) for k, t in TEXTS.items()] * 2 + [(None, CHINESE, 1, "x", 0.5)]
    items = [(k, t, 3, "y") for k, t in ITEMS.items()] * 2 + [(None, CHINESE, 3, "y")]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, item_id bigint, said string, share double"),
        spark.createDataFrame(items, "item_id bigint, text string, n_windows int, doc_id string"),
    )


def test_whole_items_of_any_script_and_length(tables):
    docs, items = tables
    got = decontaminate.contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == FOUND and len(got) == len(FOUND)
    assert all(0.8 <= r.share <= 1 for r in got)
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == sorted([0, *[k for k in TEXTS if k not in {d for d, _ in FOUND}] * 2])


def test_twin_states_the_same_rule(tables):
    docs, items = tables
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    con.register("benchmark", items.select("item_id", "text").toPandas().astype({"item_id": "Int64"}))
    wanted = sorted(con.execute(ORACLES["op7_decontamination"]).fetchall())
    got = sorted(tuple(r) for r in decontaminate.contaminated(docs, items).collect())
    assert [r[:4] for r in got] == [r[:4] for r in wanted]
    assert [r[4] for r in got] == pytest.approx([r[4] for r in wanted])


def test_very_long_texts(spark):
    many = " ".join(f"filler{k}" for k in range(50_000))
    docs = spark.createDataFrame([(1, f"{many} {LONG_ITEM} {many}"), (2, many)], "doc_id bigint, text string")
    items = spark.createDataFrame([(6, LONG_ITEM), (3, ITEMS[3])], "item_id bigint, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()] == [(1, 6)]


def test_empty_tables(tables):
    docs, items = tables
    for some, of in ((docs.where("false"), items), (docs, items.where("false"))):
        assert decontaminate.contaminated(some, of).count() == 0
        assert decontaminate.clean(some, of).count() == some.count()


def test_recall_of_changed_questions(spark):
    """Numbers and names of every item are replaced one for one: all are found, by no other document."""
    names, places = ("Anna", "Berta", "Clara", "Doris"), ("Bergen", "Oslo", "Malmö")
    verbs, goods = ("sells", "buys", "packs", "moves", "cleans"), ("crates", "nets", "ropes", "lamps", "barrels", "buoys")

    def asked(k: int, name: str, place: str, first: int, second: int) -> str:
        verb, good, other = verbs[k % 5], goods[k % 6], goods[(k // 6 + 1 + k) % 6]
        return f"in {place} the fisher {name} {verb} {first} {good} every day and then {name} gives {second} {other} to the harbour before noon, so how many {good} remain with {name} at the end of week {k}"

    items = [(k, asked(k, names[k % 4], places[k % 3], k + 3, k + 5)) for k in range(30)]
    docs = [(k, "Question. " + asked(k, names[(k + 1) % 4], places[(k + 1) % 3], 900 - k, 700 - k) + ". Well?") for k in range(30)]
    docs += [(100 + k, f"in Oslo the crew rests all day and {name} reads a long letter from home") for k, name in enumerate(names)]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    pairs = {(r.doc_id, r.item_id) for r in got.collect()}
    assert {(k, k) for k in range(30)} <= pairs and all(d < 100 for d, _ in pairs)
