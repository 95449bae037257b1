"""Range from the first fix: origin rules, ties, and the join paths."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest
from conftest import plan_of, rows

from fleetlens.operators import reach

T0 = "2025-06-01 20:00:00"


def test_ties_take_the_smaller_id(fixes):
    df = fixes(
        {"point_id": 7, "record_time": T0, "x": 10.0, "y": 10.0},
        {"point_id": 3, "record_time": T0, "x": 13.0, "y": 14.0},
        {"point_id": 9, "record_time": T0, "x": 13.0, "y": 20.0},
    )
    assert rows(reach.max_range(df)) == [("a", 6.0)]


def test_origin_rules_of_the_variants(fixes):
    df = fixes(
        {"record_time": "2025-06-01 01:00:00", "x": None, "y": None},
        {"record_time": "2025-06-01 02:00:00", "x": 0.0, "y": 0.0},
        {"record_time": "2025-06-01 03:00:00", "x": 3.0, "y": 4.0},
        {"record_time": "2025-06-02 03:00:00", "x": 6.0, "y": 8.0},
        {"record_time": "2025-06-02 04:00:00", "x": 6.0, "y": 9.0},
    )
    # Over all time, zeros dropped: from (3, 4).
    assert rows(reach.max_range(df)) == [("a", 5.83)]
    # Per day, zeros kept, NULL skipped: from (0, 0) and from (6, 8).
    assert rows(reach.range_vessel_day(df)) == [("a(2025-06-01)", 5.0), ("a(2025-06-02)", 1.0)]
    assert rows(reach.max_range_daily(df)) == [("a", 5.0)]
    assert rows(reach.top_range(df)) == [("a", 5.0)]


@pytest.fixture(scope="module")
def skewed(fixes):
    """One vessel holds half of all fixes; one vessel id is NULL."""
    draw = random.Random(5)
    made = []
    for i in range(600):
        vessel = "hot" if i % 2 else draw.choice(["a", "b", "c", "d", None])
        made.append({
            "point_id": i * 31 % 600, "vessel_id": vessel, "x": draw.uniform(1, 100), "y": draw.uniform(1, 100),
            "record_time": f"2025-06-0{draw.randint(1, 2)} {draw.randint(0, 3):02d}:00:00",
        })
    return fixes(*made).repartition(6).cache(), made


def brute_force(made, key):
    groups = defaultdict(list)
    for r in made:
        groups[key(r)].append((r["record_time"], r["point_id"], r["x"], r["y"]))
    result = {}
    for k, points in groups.items():
        _, _, x0, y0 = min(points)
        result[k] = max(math.hypot(x - x0, y - y0) for _, _, x, y in points)
    return result


@pytest.mark.parametrize("options", [{}, {"rows_per_split": 20}])
def test_join_paths_agree_with_brute_force(skewed, options):
    df, made = skewed
    per_vessel = {r.vessel_id: r.dist for r in reach.farthest(df, ("vessel_id",), **options).collect()}
    assert per_vessel == pytest.approx(brute_force(made, lambda r: r["vessel_id"]))
    per_day = {(r.vessel_id, r.dt): r.dist for r in reach.farthest(df, ("vessel_id", "dt"), **options).collect()}
    assert per_day == pytest.approx(brute_force(made, lambda r: (r["vessel_id"], r["record_time"][:10])))


def test_large_groups_are_spread(skewed, spark):
    df, _ = skewed
    points = df.select("vessel_id", "record_time", "point_id", "x", "y")
    firsts = reach.first_fixes(points, ("vessel_id",))
    joined = reach.join_origins(points, firsts, ("vessel_id",), rows_per_split=20)
    assert joined.count() == df.count()
    per_task = joined.groupBy("vessel_id", "split").count()
    assert per_task.where("vessel_id = 'hot'").count() == 15
    assert per_task.agg({"count": "max"}).first()[0] < 60


def test_no_window_and_no_cross_join(skewed):
    df, _ = skewed
    for options in ({}, {"rows_per_split": 20}):
        plan = plan_of(reach.max_range(df, **options))
        assert "Window" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_first_fixes_aggregate_by_hash(fixes):
    df = fixes({}, {"record_time": None, "vessel_id": "b"}, {"vessel_id": "b"})
    firsts = reach.first_fixes(df, ("vessel_id",))
    plan = plan_of(firsts)
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort (" not in plan
    assert firsts.where("vessel_id = 'b' AND origin.x = 110").count() == 1
