"""Density, gear, activity, duration, stops and violations on small inputs with known answers."""

from __future__ import annotations

import pytest
from conftest import plan_of, rows

from fleetlens import schema as S
from fleetlens.operators import activity, alerts, density, duration, gear


def test_density_keys_of_the_variants(fixes):
    df = fixes(
        {"x": 119.99, "y": 330.0},
        {"x": 110.0, "y": 339.0, "vessel_id": "b"},
        {"x": 110.0, "y": 339.0, "vessel_id": "b", "sea_area": None},
        {"x": 0.0, "y": 330.0},
        {"x": 605.0, "y": -0.5},
    )
    assert rows(density.grid_density(df)) == [(None, 11, 33, 1), ("渤海湾", 11, 33, 2), ("渤海湾", 60, -1, 1)]
    assert rows(density.grid_density_today(df)) == [(110, 330, 2), (600, -10, 1)]
    matrix = density.grid_density_pivot(df)
    assert rows(matrix, "sea_area", "grid_y", "grid_x", "density") == [
        ("渤海湾", -10, 600, 1), ("渤海湾", 330, 0, 1), ("渤海湾", 330, 110, 2),
    ]
    assert rows(density.with_scale(density.grid_density_today(df), "ship_cnt"), "ship_cnt", "scale_max") == [
        (1, 2),
        (2, 2),
    ]


def test_gear_variants_and_collision(fixes):
    df = fixes(
        {}, {}, {"operation_type": "围网"}, {"operation_type": None, "vessel_id": "b"},
        {"operation_type": "", "vessel_id": "b"}, {"record_time": "2025-05-31 04:00:00"},
    )
    assert rows(gear.vessels_by_gear(df)) == [(None, 1), ("", 1), ("围网", 1), ("拖网", 1)]
    assert rows(gear.gear_share(df)) == [("", 1, 20.0), ("围网", 1, 20.0), ("拖网", 3, 60.0)]
    assert rows(gear.gear_share_today(df)) == [("围网", 1, 20.0), ("拖网", 2, 40.0), ("未知", 2, 40.0)]


def test_speed_statistics(fixes):
    df = fixes({"speed": 5.1}, {"speed": 4.0}, {"speed": 7.0, "operation_type": None})
    assert rows(gear.speed_by_gear(df)) == [(None, 7.0, 7.0, 7.0, 1), ("拖网", 4.55, 5.1, 4.0, 2)]
    [(name, mean, low, high, std)] = rows(gear.speed_stats_gear(df))
    assert (name, mean, low, high) == ("拖网", pytest.approx(4.55), 4.0, 5.1)
    assert std == pytest.approx(0.7778174593)
    assert [tuple(r) for r in gear.speed_by_gear_today(df).collect()] == [("未知", 7.0), ("拖网", 4.55)]


def test_activity_by_hour_day_and_month(fixes):
    df = fixes(
        {"record_time": "2024-06-30 09:59:59"},
        {"record_time": "2025-06-30 10:00:00", "vessel_id": "b"},
        {"record_time": "2025-07-01 09:00:00"},
        {"record_time": "2025-07-01 09:30:00"},
    )
    assert rows(activity.hour_hist(df)) == [(9, 3), (10, 1)]
    assert rows(activity.hour_hist_peak(df)) == [(9, 3, True), (10, 1, False)]
    assert rows(activity.hour_hist_today(df)) == [("9", 2)]
    assert rows(activity.daily_points(df)) == [("2024-06-30", 1), ("2025-06-30", 1), ("2025-07-01", 2)]
    assert rows(activity.monthly_points(df)) == [(6, 2, 2), (7, 2, 1)]
    assert rows(activity.days_at_sea(df)) == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in activity.top_days_at_sea(df, 1).collect()] == [("a", 2)]
    assert [tuple(r) for r in activity.last_days(df, 2).collect()] == [("2025-06-30", 1), ("2025-07-01", 2)]
    assert [tuple(r) for r in activity.top_vessels(df).collect()] == [("a", 3), ("b", 1)]


def spans(fixes, *hours):
    made = []
    for i, length in enumerate(hours):
        end = round(length * 3600)
        clock = f"{end // 3600:02d}:{end % 3600 // 60:02d}:{end % 60:02d}"
        made += [{"vessel_id": f"v{i}", "record_time": f"2025-06-01 {t}"} for t in ("00:00:00", clock)]
    return fixes(*made)


def test_duration_buckets_are_right_closed_and_zero_filled(fixes):
    df = spans(fixes, 0, 2, 2.0003, 4, 6, 8, 10, 10.0003)
    assert [tuple(r) for r in duration.work_hours_buckets(df).collect()] == [
        (i, label, n) for i, (label, n) in enumerate(zip(S.DURATION_LABELS, (2, 2, 1, 1, 1, 1), strict=True))
    ]
    assert [r.value for r in duration.work_hours_buckets(df.where("false")).collect()] == [0] * 6
    assert rows(duration.work_hours(df.where("vessel_id = 'v3'"))) == [("v3", "2025-06-01", 4.0)]
    assert rows(duration.work_minutes(df.where("vessel_id = 'v3'"))) == [("v3", "2025-06-01", 240.0)]


def test_box_statistics(fixes):
    df = spans(fixes, 1, 2, 3, 4, 20)
    assert rows(duration.work_minutes_box(df)) == [(120.0, 180.0, 240.0, 60.0, 240.0, 1)]
    assert rows(duration.work_minutes_outliers(df)) == [(1200.0, 1)]


def test_histogram_edges(fixes):
    df = spans(fixes, 0, 10, 20)
    bins = duration.work_minutes_hist(df).collect()
    assert [r.cnt for r in bins] == [1] + [0] * 9 + [1] + [0] * 8 + [1]
    assert (bins[0].bin_low, bins[19].bin_high) == (0.0, 1200.0)
    flat = duration.work_minutes_hist(spans(fixes, 5, 5)).collect()
    assert sum(r.cnt for r in flat) == 2 and len(flat) == 20
    assert (flat[0].bin_low, flat[19].bin_high) == (299.5, 300.5)
    assert duration.work_minutes_hist(df.where("false")).count() == 0


def test_stop_variants_differ_on_null_points_and_labels(fixes):
    slow = {"speed": 2.9}
    df = fixes(
        {**slow, "vessel_id": "one"},
        {**slow, "vessel_id": "two", "x": 100.0}, {**slow, "vessel_id": "two", "x": 101.0},
        {**slow, "vessel_id": "gap"}, {**slow, "vessel_id": "gap", "x": None, "y": None},
        {**slow, "vessel_id": "lab", "sea_area": None}, {**slow, "vessel_id": "lab", "sea_area": ""},
        {**slow, "vessel_id": "non", "x": None, "y": None}, {**slow, "vessel_id": "non", "x": None, "y": None},
        *[{**slow, "vessel_id": "big"}] * 4,
        {"speed": 3.0, "vessel_id": "one", "record_time": "2025-06-01 20:00:00"},
    )
    assert rows(alerts.abnormal_stop(df)) == [("big", "渤海湾", 4, 110.0, 330.0), ("two", "渤海湾", 2, 100.5, 330.0)]
    today = alerts.abnormal_stop_today(df)
    time = "2025-06-01 20:00:00"
    assert [tuple(r) for r in today.collect()] == [
        ("big", "渤海湾", 110.0, 330.0, 4, time),
        ("gap", "渤海湾", 110.0, 330.0, 2, time),
        ("lab", "未知", 110.0, 330.0, 2, time),
        ("non", "渤海湾", 0.0, 0.0, 2, time),
        ("two", "渤海湾", 100.5, 330.0, 2, time),
    ]
    assert rows(alerts.stop_alerts(today).where("ship_id IN ('big', 'two')"), "level", "message") == [
        (1, "渔船 big 在 渤海湾 出现 4 个低速点"),
        (2, "渔船 two 在 渤海湾 出现 2 个低速点"),
    ]
    assert rows(alerts.stop_record(alerts.abnormal_stop(df)))[0] == ("big", "", "", 4.0, 110.0, 330.0)


def test_rectangle_edges(fixes):
    inside, outside = [], []
    for a in S.AREAS:
        middle = ((a.x_min + a.x_max) / 2, (a.y_min + a.y_max) / 2 + 0.5)
        for x, y, kept in (
            (a.x_min, middle[1], True), (a.x_max, middle[1], True), (middle[0], a.y_max, True),
            (a.x_min - 0.01, middle[1], False), (a.x_max + 0.01, middle[1], False),
            (middle[0], a.y_min - 0.01, False), (middle[0], a.y_max + 0.01, False),
        ):
            (inside if kept else outside).append({"x": x, "y": y, "sea_area": a.name, "vessel_id": "in" if kept else "out"})
    df = fixes(*inside, *outside, {"sea_area": "未知", "x": 9999.0}, {"sea_area": None, "x": 9999.0}, {"x": None}, {"x": 0.0})
    flagged = alerts.area_violations(df)
    assert {r.vessel_id for r in flagged.collect()} == {"out"}
    assert flagged.count() == len(outside)
    assert [r.x for r in alerts.area_violations_today(df, k=3).collect()] == [r["x"] for r in outside[:3]]
    plan = plan_of(flagged)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
