"""Fixes whose time does not parse."""

from __future__ import annotations

from fleetlens.operators import activity
from fleetlens.plans import etl, rollup
from fleetlens.session import scratch_path
from fleetlens.sources import cleaned


def test_hour_of_malformed_times(spark):
    columns = "vessel_id string, x string, y string, speed string, direction string, record_time string, operation_type string, sea_area string"
    times = ["2025-06-01 04:00:00", "2025-06-01 23", "2025-06-01 23:7", "2025-06-01 xx", "2025-06-01", "garbage", None]
    landed = spark.createDataFrame([("a", "1", "1", "4", "1", t, "g", "s") for t in times], columns)
    path = scratch_path(spark, "cleaned")
    etl.write_cleaned(etl.clean(landed), path)
    df = cleaned.read_cleaned(spark, path)
    summary = rollup.activity_rollup(df)
    for today in (activity.hour_hist_today(df), rollup.hour_hist_today(summary)):
        assert [tuple(r) for r in today.collect()] == [("4", 1), ("23", 2)]
    # The hourly activity of all days knows parsed times alone.
    for every in (activity.hour_hist(df), rollup.hour_hist(summary)):
        assert [tuple(r) for r in every.collect()] == [(None, 6), (4, 1)]
