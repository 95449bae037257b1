"""Summaries against direct operators, ten results, reruns, invariants."""

from __future__ import annotations

import pytest
from conftest import rows

from fleetlens.operators import activity, alerts, density, duration, filters, gear, monitor
from fleetlens.plans import results
from fleetlens.plans import rollup as R
from fleetlens.session import scratch_path
from fleetlens.sources import events

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def df(spark):
    return events.trajectories(spark, SF_DIR).cache()


@pytest.fixture(scope="module")
def summaries(df, spark):
    return results.build_summaries(df, scratch_path(spark, "summary"))


def rounded(df):
    return rows(df.selectExpr(*[f"round({c}, 6) AS {c}" if t == "double" else c for c, t in df.dtypes]))


def test_summary_results_equal_direct_results(df, summaries):
    act, grid = summaries
    pairs = [
        (R.grid_density(grid), density.grid_density(df)),
        (R.vessels_by_gear(act), gear.vessels_by_gear(df)),
        (R.hour_hist(act), activity.hour_hist(df)),
        (R.work_hours(act), duration.work_hours(df)),
        (R.days_at_sea(act), activity.days_at_sea(df)),
        (R.speed_by_gear(act), gear.speed_by_gear(df)),
        (R.daily_points(act), activity.daily_points(df)),
        (R.abnormal_stop(act), alerts.abnormal_stop(df)),
        (R.work_hours_buckets(act), duration.work_hours_buckets(df)),
        (R.top_vessels(act), activity.top_vessels(df)),
        (R.last_days(act), activity.last_days(df)),
        (R.gear_counts_today(act), gear.gear_counts_today(df)),
        (R.speed_by_gear_today(act), gear.speed_by_gear_today(df)),
        (R.hour_hist_today(act), activity.hour_hist_today(df)),
        (R.grid_density_today(grid), density.grid_density_today(df)),
        (R.abnormal_stop_today(act), alerts.abnormal_stop_today(df)),
        (R.kpi_day(act, grid), monitor.kpi_day(df)),
        (R.kpi_month(act, grid), monitor.kpi_month(df)),
    ]
    for summary, direct in pairs:
        assert summary.columns == direct.columns
        assert rounded(summary) == rounded(direct)


def test_rerun_leaves_the_same_rows(df, spark):
    path = scratch_path(spark, "results")
    first = rows(results.sink_audit(results.run_offline(df, path)))
    second = rows(results.sink_audit(results.run_offline(df, path)))
    assert first == second
    assert [name for name, _ in first] == list(results.RESULT_NAMES)


def test_summaries_of_new_days_are_added(df, spark):
    path = scratch_path(spark, "summary")
    results.build_summaries(df.where("dt < '2024-01-15'"), path)
    act, grid = results.build_summaries(df.where("dt >= '2024-01-15'"), path)
    assert rows(R.daily_points(act)) == rows(activity.daily_points(df))
    assert rows(R.grid_density(grid)) == rows(density.grid_density(df))


def test_invariants(df):
    total = df.count()
    assert sum(r.cnt for r in activity.hour_hist(df).collect()) == total
    assert sum(r.cnt for r in activity.daily_points(df).collect()) == total
    assert sum(r.cnt for r in duration.work_minutes_hist(df).collect()) == duration.vessel_days(df).count()
    assert sum(r.share for r in gear.gear_share(df).collect()) == pytest.approx(100, abs=0.3)
    assert alerts.area_violations(df).count() <= filters.valid_points(df).count()
    fixes = {r.operation_type: r.n for r in df.groupBy("operation_type").count().withColumnRenamed("count", "n").collect()}
    assert all(r.cnt <= fixes[r.op_type] for r in gear.vessels_by_gear(df).collect())
