"""Formatted conversations say what went in, read from their text alone."""

from __future__ import annotations

import hashlib
import random

from fleetlens.llm.chat import Template, digests, segments

PARTS = ["\\", "###", "</turn>", " </turn>\n", ":", ": ", "### Assistant: ", "### Role ", "a", " ", "\n", "é", "", "#", "\\</turn>"]
ROLES = ["user", "assistant", "system", "tool", "", "x: y", "Role user", "a\\", "</turn>\n", "###", "\\:"]


def test_turns_are_found_in_the_joined_text(spark):
    draw = random.Random(7)
    rows = [(c, t, draw.choice(ROLES), "".join(draw.choices(PARTS, k=draw.randrange(9)))) for c in range(60) for t in range(draw.randrange(1, 9))]
    made = segments(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert set(digests(made.drop("kind", "turn_number")).columns) >= {"n_turns", "turns_sha256"}
    got = {r.conv_id: r for r in digests(made.drop("kind", "turn_number")).collect()}
    for conv in range(60):
        turns = [(role, text) for c, _, role, text in rows if c == conv]
        said, loss = "".join(f"{role}\n{text}\n" for role, text in turns), "".join(text for role, text in turns if role == "assistant")
        assert got[conv].n_turns == len(turns) and got[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert got[conv].loss_chars == len(loss) and got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_every_turn_reads_back():
    template, draw = Template(), random.Random(3)
    for _ in range(3000):
        role, text = draw.choice(ROLES), "".join(draw.choices(PARTS, k=draw.randrange(7)))
        formatted = template.header(role) + template.escape(text) + template.end + "### User: next"
        end = template.bare(formatted, template.end)
        assert template.read_turn(formatted[:end]) == (role, text)
