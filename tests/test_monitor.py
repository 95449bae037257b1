"""Key figures, latest fixes, map layout, payloads."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from conftest import plan_of, rows

from fleetlens.operators import monitor
from fleetlens.plans import payloads
from fleetlens.session import scratch_path


def test_kpi_day_and_month(fixes):
    df = fixes(
        {"record_time": "2025-06-30 01:00:00", "vessel_id": "old"},
        {"record_time": "2025-07-01 01:00:00", "vessel_id": "b", "x": 215.0, "speed": 4.04},
        {"record_time": "2025-07-02 01:00:00", "speed": 2.0},
        {"record_time": "2025-07-02 02:00:00", "speed": 2.5, "x": None, "y": None},
        {"record_time": "2025-07-02 03:00:00", "speed": 9.0, "x": 0.0},
    )
    assert rows(monitor.kpi_day(df)) == [(3, 1, 4.5, 1, 1)]
    assert rows(monitor.kpi_month(df)) == [(4, 2, 4.4, 2)]
    summary = payloads.summary(df, df)
    assert rows(summary) == [(3, 1, 4.5, 1, 1, 4, 2, 4.4, 2)]


def test_kpis_of_nothing_are_zero(fixes):
    df = fixes().where("false")
    assert rows(monitor.kpi_day(df)) == [(0, 0, 0.0, 0, 0)]
    assert rows(monitor.kpi_month(df)) == [(0, 0, 0.0, 0)]


def test_latest_fix_ties_status_and_defaults(fixes):
    late = "2025-06-01 20:00:00"
    df = fixes(
        {"record_time": late, "speed": 5.0, "x": 1.0},
        {"record_time": late, "speed": 5.01, "x": 2.0, "operation_type": "", "sea_area": None},
        {"record_time": "2025-06-01 21:00:00", "vessel_id": "b", "speed": 12.5, "x": None, "y": None},
        {"record_time": "2025-05-31 21:00:00", "vessel_id": "gone"},
    )
    assert rows(monitor.latest_position(df)) == [("a", 2.0, 330.0, "未知", "未知"), ("b", 0.0, 0.0, "拖网", "渤海湾")]
    status = monitor.latest_status(df)
    assert [tuple(r) for r in status.collect()] == [
        ("b", "渤海湾", 12.5, "作业中", "2025-06-01 21:00:00"),
        ("a", "未知", 5.0, "作业中", late),
    ]
    assert rows(monitor.speed_bands(status)) == [("a", 5.0, "low"), ("b", 12.5, "high")]


def test_latest_fix_of_repeated_ids_times_and_texts(fixes):
    """Against a plain loop: several texts per vessel, NULL times, ids and texts, and a fix that is given twice."""
    given = [
        {"vessel_id": v, "record_time": t, "point_id": p, "x": float(k), "y": None if k % 5 == 0 else float(-k), "speed": k / 7, "operation_type": g, "sea_area": a}
        for k, (v, t, p, g, a) in enumerate(
            (v, t, p, g, a)
            for v in ("a", "b", None)
            for t in (None, "2025-06-01 03:00:00", "2025-06-01 03:00:01")
            for p, g, a in ((1, "拖网", None), (None, "刺网", "渤海湾"), (3, None, ""), (2, "拖网", "渤海湾"))
            if (v, t) != ("b", "2025-06-01 03:00:01")
        )
    ]
    df = fixes(*given, given[0])
    wanted = {}
    for r in df.collect():
        rank = (r.record_time is not None, r.record_time, r.point_id is not None, r.point_id)
        if r.vessel_id not in wanted or rank > wanted[r.vessel_id][0]:
            wanted[r.vessel_id] = (rank, (r.vessel_id, r.record_time, r.x, r.y, r.speed, r.operation_type, r.sea_area))
    got = monitor.latest_fix(df)
    assert {tuple(r) for r in got.collect()} == {fix for _, fix in wanted.values()}
    assert len(wanted) == got.count() == 3


def test_latest_fix_sorts_no_fixes(fixes):
    plan = plan_of(monitor.latest_fix(fixes({}, {"vessel_id": "b"})))
    tree = plan.split("\n\n")[0]
    # From the scan up, the first two aggregations and the shuffle between them are by hash.
    steps = [line for line in reversed(tree.splitlines()) if "Aggregate" in line or "Exchange" in line]
    assert ["HashAggregate" in steps[0], "Exchange" in steps[1], "HashAggregate" in steps[2]] == [True] * 3


def positions(spark, *points):
    data = [(f"s{i}", float(x), float(y), "拖网") for i, (x, y) in enumerate(points)]
    return spark.createDataFrame(data, "ship_id string, x double, y double, work_type string")


def test_map_positions(spark):
    placed = rows(monitor.map_positions(positions(spark, (100, 10), (200, 20), (0, 0))), "left_pct", "top_pct")
    assert placed[0] == (0.0, 0.0)
    assert placed[1] == pytest.approx((100 / 12, 100 / 12))
    assert placed[2] == pytest.approx((1100 / 12, 1100 / 12))
    for points in ([(5, 5), (5, 5)], [(0, 0)]):
        for left, top in rows(monitor.map_positions(positions(spark, *points)), "left_pct", "top_pct"):
            assert (left, top) == pytest.approx((50.0, 50.0))


def test_payload_shapes(fixes):
    df = fixes({}, {"record_time": "2025-06-01 10:00:00", "vessel_id": "b"}, {"record_time": "2025-06-01 09:00:00"})
    arrays = {r.name: json.loads(r.payload) for r in payloads.tagged(payloads.array_payloads(df)).collect()}
    assert arrays["peak-hour"] == {"hours": ["4", "9", "10"], "values": [1, 1, 1]}
    assert arrays["ship-top20"] == {"ships": ["a", "b"], "values": [2, 1]}
    assert arrays["work-duration-dist"]["values"] == [1, 0, 1, 0, 0, 0]
    objects = payloads.row_payloads(df)
    assert json.loads(objects["worktype-ratio"].first().payload) == {"name": "拖网", "value": 3}
    assert json.loads(objects["summary"].first().payload)["total_points"] == 3


def test_payloads_are_written_as_json_lines(fixes, spark):
    path = scratch_path(spark, "payloads")
    df = fixes({}, {"vessel_id": "b"})
    for _ in range(2):
        payloads.write_payloads({"latest-boats": payloads.row_payload(monitor.latest_status(df))}, path)
    assert rows(spark.read.json(f"{path}/latest-boats"), "ship", "status") == [("a", "返港中"), ("b", "返港中")]


def test_array_payload_never_cuts(spark):
    made = json.loads(payloads.array_payload(spark.range(10_005), ["id"], ids="id").first().payload)
    assert made["ids"] == list(range(10_005))


def test_payloads_keep_nulls(fixes):
    df = fixes({"record_time": None}).withColumn("dt", F.lit("2025-06-01"))
    made = json.loads(payloads.row_payload(monitor.latest_status(df)).first().payload)
    assert "time" in made and made["time"] is None
