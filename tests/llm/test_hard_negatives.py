"""Hard negatives against a version in plain Python, and on awkward rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm.hard_negatives import Rule, mine

SCHEMA = "vec_id bigint, label int, vec array<float>, rank int, score string, block int"


def brute(rows: list[tuple], every: int, positives: int = 5, negatives: int = 5) -> list[tuple]:
    sound = [r for r in rows if None not in r[:3] and all(x is not None and math.isfinite(x) for x in r[2])]
    made = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v, *_ in sound]
    anchors = {(i, lab, tuple(v)) for i, lab, v in made if i % every == 0}
    out = []
    for i, lab, v in anchors:
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), j, other) for j, other, w in made)
        own = [(j, -s) for s, j, other in scored if other == lab and j != i][:positives]
        for j, p in own:
            inside = [(k, -s) for s, k, other in scored if other != lab and 80 * p <= -100 * s <= 100 * p][:negatives]
            out += [(i, j, n, k, p, s) for n, (k, s) in enumerate(inside, 1)]
    return sorted(out)


def mined(spark, rows: list[tuple], every: int, rule: Rule = Rule()) -> list[tuple]:
    df = spark.createDataFrame([(*r, 1, "x", 3) for r in rows], SCHEMA)
    return sorted(map(tuple, mine(df, F.col("vec_id") % every == 0, rule).collect()))


@pytest.mark.parametrize("rule", [Rule(), Rule(least=16, most=64, chunk=4)])
def test_as_in_plain_python(spark, rule):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 20))
    rows = []
    for k in range(400):
        v = centres[k % 6] * 0.4 + rng.normal(size=20) * 0.3
        # Every third row is a copy of one vector, under several labels.
        v = centres[0] if k % 3 == 0 else v
        rows.append((k, int(rng.integers(4)), [float(np.float32(x)) for x in v]))
    got = mined(spark, rows, 10, rule)
    assert got == brute(rows, 10) and len(got) > 500


def test_awkward_rows(spark):
    v = [0.5, -0.25, 0.125]
    rows = [
        (0, 1, v), (0, 1, v), (1, 1, v), (2, 1, [0.5, -0.25]), (3, 2, v), (3, 2, v), (4, 2, [0.45, -0.2, 0.125]), (5, None, v), (6, 2, None), (7, 2, [None, 1.0, 1.0]),
        (8, 2, [float("nan"), 1.0, 1.0]), (9, 2, [float("inf"), 1.0, 1.0]), (None, 2, v), (10, 3, []), (11, 3, [-0.5, 0.25, -0.125]), (20, 3, [0.0, 0.0, 0.0]), (30, 2, [0.5] * 50), (31, 2, [0.5] * 50),
    ]
    random.Random(1).shuffle(rows)
    got = mined(spark, rows, 10)
    assert got == brute(rows, 10) and got
    assert mined(spark, [], 10) == [] and mined(spark, [(1, 1, v)], 10) == [] and mined(spark, [(10, 1, v)], 10) == []


def test_scores_beyond_a_long_do_not_fail(spark):
    big = [1e30, 1.0]
    assert len(mined(spark, [(10, 1, big), (1, 1, big), (2, 2, big), (3, 2, [-1e30, 0.0])], 10)) == 1
