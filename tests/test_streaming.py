"""Streamed results equal batch results: after every step, at the end, after a repeat, and with late rows."""

from __future__ import annotations

import pytest
from conftest import rows
from replaying import replay_steps, write_replay_files

from fleetlens.operators import activity, alerts, duration, filters, monitor, reach
from fleetlens.plans import rollup as R
from fleetlens.session import scratch_path
from fleetlens.sources import events
from fleetlens.streaming import replay, views

SF_DIR = "/root/testdata/sf0.001"
STEPS = 4
FIRST_DAY = "2024-01-22"  # nine days, more than the seven that the daily trend shows


@pytest.fixture(scope="module")
def df(spark):
    return events.trajectories(spark, SF_DIR).where(f"dt >= '{FIRST_DAY}'").cache()


@pytest.fixture(scope="module")
def files(spark):
    path = scratch_path(spark, "replay")
    recent = events.read_events(spark, SF_DIR).where(f"ts >= '{FIRST_DAY}'")
    write_replay_files(recent, path, STEPS, time="ts")
    return path


@pytest.fixture(scope="module")
def kept(spark, files):
    path = scratch_path(spark, "views")
    query = views.maintain(replay.event_stream(spark, files, files_per_trigger=1), path)
    replay.run_to_end(query)
    return path, query


def parts(spark, path, upto=STEPS):
    """The summaries as they stood after `upto` batches."""
    read = {name: views.read_part(spark, path, name).where(f"CAST(batch_id AS INT) < {upto}") for name in views.PARTS}
    return read


def check_views(read, df):
    act, grid = read["activity"], read["grid"]
    assert rows(R.work_hours_buckets(act)) == rows(duration.work_hours_buckets(df))
    assert rows(R.top_vessels(act)) == rows(activity.top_vessels(df))
    assert rows(R.last_days(act)) == rows(activity.last_days(df))
    assert rows(views.range_vessel_day(read["reach"])) == rows(reach.range_vessel_day(df))
    assert rows(R.kpi_day(act, grid)) == rows(monitor.kpi_day(df))
    assert rows(R.kpi_month(act, grid)) == rows(monitor.kpi_month(df))
    assert rows(R.abnormal_stop_today(act)) == rows(alerts.abnormal_stop_today(df))
    assert rows(views.area_violations_today(read["violations"], act)) == rows(alerts.area_violations_today(df))
    assert rows(views.latest_status(read["latest"])) == rows(monitor.latest_status(df))
    assert rows(views.latest_position(read["latest"])) == rows(monitor.latest_position(df))


def test_stream_equals_batch_at_the_end(spark, kept, df):
    path, _ = kept
    assert views.read_part(spark, path, "activity").select("batch_id").distinct().count() == STEPS
    check_views(parts(spark, path), df)


@pytest.mark.parametrize("step", [1, 3])
def test_stream_equals_prefix_after_each_step(spark, kept, df, step):
    path, _ = kept
    read = parts(spark, path, step)
    seen = read["activity"].selectExpr("sum(fixes)").first()[0]
    assert 0 < seen < df.count()
    check_views(read, filters.replay_prefix(df, seen).cache())


def test_repeated_batch_is_counted_once(spark, df):
    path = scratch_path(spark, "views")
    halves = [df.where("dt < '2024-01-28'"), df.where("dt >= '2024-01-28'")]
    for number, batch in [(0, halves[0]), (1, halves[1]), (1, halves[1])]:
        for write in views.PARTS.values():
            write(batch, path, number)
    check_views(parts(spark, path), df)


def test_restart_goes_on_with_new_files_only(spark, df):
    source, path = scratch_path(spark, "source"), scratch_path(spark, "views")
    recent = events.read_events(spark, SF_DIR).where(f"ts >= '{FIRST_DAY}'")
    for step, half in enumerate(("ts < '2024-01-28'", "ts >= '2024-01-28'")):
        recent.where(half).write.parquet(f"{source}/step={step}")
        replay.run_to_end(views.maintain(replay.event_stream(spark, source), path, ["activity"]))
    kept = views.read_part(spark, path, "activity")
    assert rows(kept.select("batch_id").distinct()) == [("00000000",), ("00000001",)]
    assert rows(R.daily_points(kept)) == rows(activity.daily_points(df))


def test_parts_without_rows_can_be_read(spark, fixes):
    path = scratch_path(spark, "views")
    inside = fixes({"x": None, "y": None, "speed": 9.0})
    for number in range(2):
        for write in views.PARTS.values():
            write(inside, path, number)
    read = parts(spark, path)
    assert views.area_violations_today(read["violations"], read["activity"]).count() == 0
    assert views.range_vessel_day(read["reach"]).count() == 0
    assert rows(R.kpi_day(read["activity"], read["grid"])) == [(2, 1, 9.0, 0, 0)]


def test_late_rows_move_the_origin(spark, fixes):
    path = scratch_path(spark, "views")
    on_time = fixes(
        {"point_id": 1, "record_time": "2025-06-01 10:00:00", "x": 10.0, "y": 10.0},
        {"point_id": 2, "record_time": "2025-06-01 11:00:00", "x": 13.0, "y": 14.0},
        {"point_id": 3, "record_time": "2025-06-01 11:00:00", "x": 13.0, "y": 15.0, "vessel_id": "b"},
    )
    late = fixes({"point_id": 4, "record_time": "2025-06-01 09:00:00", "x": 13.0, "y": 2.0})
    later = fixes({"point_id": 5, "record_time": "2025-06-01 12:00:00", "x": 13.0, "y": 20.0})
    for number, batch in enumerate((on_time, late, later)):
        views.write_reach(batch, path, number)
    together = on_time.unionAll(late).unionAll(later)
    expected = rows(reach.range_vessel_day(together))
    assert expected == [("a(2025-06-01)", 18.0), ("b(2025-06-01)", 0.0)]
    assert rows(views.range_vessel_day(views.read_part(spark, path, "reach"))) == expected


def test_replay_appends_every_row_once(spark, files, df):
    path = scratch_path(spark, "replayed")
    query = replay.replay(replay.event_stream(spark, files, files_per_trigger=1), path)
    replay.run_to_end(query)
    assert len([p for p in query.recentProgress if p.numInputRows]) == STEPS
    replayed = spark.read.schema(df.schema).parquet(path)
    assert rows(replayed, "point_id") == rows(df, "point_id")
    assert rows(replay.replay_status(replayed, df)) == [(df.count(), df.count())]


def test_pace_of_the_replay():
    assert [replay_steps(n) for n in (0, 50, 51, 9896)] == [1, 1, 2, 198]


def test_latest_state_over_several_batches(spark, files, df):
    path = scratch_path(spark, "views")
    replay.run_to_end(views.keep_latest(replay.event_stream(spark, files, files_per_trigger=1), path))
    assert rows(views.latest_status(views.read_part(spark, path, "latest"))) == rows(monitor.latest_status(df))
