"""Merged generations: few files, the same results, nothing half seen; hull corners; progress; windows with a watermark."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import rows

from fleetlens.operators import activity, filters, hull, monitor, reach
from fleetlens.plans import rollup as R
from fleetlens.session import scratch_path
from fleetlens.sources import events
from fleetlens.streaming import generations, views, windows

SF_DIR = "/root/testdata/sf0.001"
DAYS = ("2024-01-28", "2024-01-29", "2024-01-30")


@pytest.fixture(scope="module")
def df(spark):
    return events.trajectories(spark, SF_DIR).where(f"dt >= '{DAYS[0]}'").cache()


def test_corners_hold_the_farthest_point_from_anywhere():
    rng = np.random.default_rng(4)
    for kind in range(8):
        n = int(rng.integers(1, 300))
        x, y = rng.normal(size=n) * 50, rng.normal(size=n) * 50
        if kind % 2:
            x, y = np.round(x / 20), np.round(y / 20)
        if kind == 6:
            y = x * 2
        if kind == 7:
            x, y = np.cos(np.arange(n)), np.sin(np.arange(n))
        group = rng.integers(0, 3, n)
        kept = hull.corners(group, x, y)
        for g in range(3):
            for px, py in rng.normal(size=(20, 2)) * 100:
                d = np.hypot(x - px, y - py)
                every, few = d[group == g], d[kept[group[kept] == g]]
                assert (len(every) > 0) == (len(few) > 0)
                assert not len(every) or abs(every.max() - few.max()) < 1e-9
    assert len(hull.corners(np.zeros(2000, int), rng.random(2000), rng.random(2000))) < 80
    assert sorted(hull.corners(np.zeros(3, int), np.array([np.nan, 1.0, 1.0]), np.zeros(3))) in ([0, 1], [0, 2])


def test_corner_points_keep_null_groups_apart(spark):
    data = [("a", None, float(k % 7), float(k % 5)) for k in range(100)] + [(None, "d", 3.0, 3.0), ("a", "d", 1.0, 1.0), ("a", "d", 1.0, 1.0)]
    points = spark.createDataFrame(data, "vessel_id string, dt string, x double, y double").repartition(5)
    made = rows(hull.corner_points(points, ("vessel_id", "dt")))
    assert [r for r in made if r[1] == "d"] == [(None, "d", 3.0, 3.0), ("a", "d", 1.0, 1.0)]
    assert {r[2:] for r in made if r[1] is None} >= {(0.0, 0.0), (6.0, 0.0), (0.0, 4.0), (6.0, 4.0)} and len(made) <= 2 + 8


def files_of(spark, path, name):
    read = views.read_part(spark, path, name)
    return read.selectExpr("dt", "input_file_name() AS file").distinct().groupBy("dt").count()


def test_files_per_day_stay_constant(spark, fixes):
    """Every batch brings fixes of the same day, some before its first fix so far."""
    path, every = scratch_path(spark, "views"), None
    sizes = []
    for number in range(24):
        batch = fixes(*[
            {"point_id": 10 * number + k, "record_time": f"2025-06-01 {(37 * number + 11 * k) % 24:02d}:{number:02d}:0{k}", "x": float((7 * number + k) % 13), "y": float((5 * number + 3 * k) % 11), "vessel_id": "ab"[k % 2], "speed": 1.0 + k}
            for k in range(4)
        ])
        every = batch if every is None else every.unionAll(batch)
        for name in ("activity", "reach"):
            views.PARTS[name](batch.coalesce(1), path, number)
            if number % 3 == 2:
                views.merge_part(spark, path, name, number)
        if number % 6 == 5:
            sizes.append(max(r["count"] for r in files_of(spark, path, "reach").collect()))
    assert len(sizes) == 4 and len(set(sizes)) == 1
    act, ranges = (views.read_part(spark, path, name) for name in ("activity", "reach"))
    assert rows(views.range_vessel_day(ranges)) == rows(reach.range_vessel_day(every))
    assert rows(R.daily_points(act)) == rows(activity.daily_points(every))
    assert rows(R.top_vessels(act)) == rows(activity.top_vessels(every))
    # Folders of batches long merged are gone.
    kept = {r.file.split("batch_id=")[1][:8] for r in spark.read.parquet(f"{path}/reach").selectExpr("input_file_name() AS file").distinct().collect()}
    assert kept == {"00000021", "00000022", "00000023"}


def test_a_failed_merge_changes_nothing(spark, df):
    path = scratch_path(spark, "views")
    for number, day in enumerate(DAYS):
        views.write_activity(df.where(f"dt = '{day}'"), path, number)
        views.write_latest(df.where(f"dt = '{day}'"), path, number)
    before = rows(R.daily_points(views.read_part(spark, path, "activity")))

    def broken(frame):
        views.merge_activity(frame).write.parquet(f"{path}/_base/activity/gen=00000002/dt=2024-01-28")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        generations.merge(spark, path, "activity", views.SCHEMAS["activity"], 2, broken)
    assert rows(R.daily_points(views.read_part(spark, path, "activity"))) == before
    assert views.merge_part(spark, path, "activity", 1) == 2
    assert rows(R.daily_points(views.read_part(spark, path, "activity"))) == before
    assert views.merge_part(spark, path, "activity", 2) == 1
    assert views.merge_part(spark, path, "activity", 2) == 0
    # A batch that is repeated after its merge counts once, and later batches of a merged day are added.
    views.write_activity(df.where(f"dt = '{DAYS[2]}'"), path, 2)
    assert rows(R.daily_points(views.read_part(spark, path, "activity"))) == before == rows(activity.daily_points(df))
    views.write_activity(df.where(f"dt = '{DAYS[0]}'"), path, 3)
    doubled = dict(rows(R.daily_points(views.read_part(spark, path, "activity"))))
    assert doubled[DAYS[0]] == 2 * dict(before)[DAYS[0]] and doubled[DAYS[1]] == dict(before)[DAYS[1]]
    assert views.merge_part(spark, path, "latest", 2) == 3
    assert rows(views.latest_status(views.read_part(spark, path, "latest"))) == rows(monitor.latest_status(df))


def test_progress_rises_to_the_total(spark, df):
    path = scratch_path(spark, "views")
    for number, day in enumerate(DAYS):
        views.write_progress(df.where(f"dt = '{day}'"), path, number)
    views.merge_part(spark, path, "progress", 1)
    made = views.progress(views.read_part(spark, path, "progress")).orderBy("batch").collect()
    assert [r.batch for r in made] == [0, 1, 2] and made[-1].current == df.count()
    assert [r.current for r in made] == [filters.replay_prefix(df, r.current).count() for r in made]


def test_late_fixes_are_listed(spark, fixes):
    path, source = scratch_path(spark, "windows"), scratch_path(spark, "source")
    batches = [
        [("2025-06-01 10:00:00", 1), ("2025-06-02 09:00:00", 2)],
        [("2025-06-05 01:00:00", 3), ("2025-06-01 11:00:00", 4), (None, 5)],
        [("2025-06-01 12:00:00", 6), ("2025-06-04 12:00:00", 7), ("2025-06-02 23:00:00", 8)],
    ]
    for number, batch in enumerate(batches):
        arrived = fixes(*[{"record_time": t, "point_id": p} for t, p in batch])
        arrived.write.parquet(f"{source}/step={number}")
        windows.run(lambda: spark.readStream.schema(arrived.schema).option("recursiveFileLookup", True).parquet(source), path)
    assert rows(windows.closed_days(spark, path)) == [("2025-06-01", 2), ("2025-06-02", 1)]
    late = windows.late_rows(spark, path, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in arrived.schema))
    assert rows(late, "point_id", "batch_id") == [(6, 2), (8, 2)]
