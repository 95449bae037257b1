"""The day index follows every write, and current-day views scan one folder of the table, once."""

from __future__ import annotations

import re

import pytest
from conftest import plan_of, rows

from fleetlens.operators import alerts, monitor
from fleetlens.plans import etl, prefix
from fleetlens.plans.today import Today
from fleetlens.session import scratch_path
from fleetlens.sources import cleaned, days, events

SF_DIR = "/root/testdata/sf0.001"
RAW = "vessel_id string, x string, y string, speed string, direction string, record_time string, operation_type string, sea_area string"


def landed(spark, *times: str | None):
    return etl.clean(spark.createDataFrame([("a", "1", "1", "2", "1", t, "g", "s") for t in times], RAW))


@pytest.fixture(scope="module")
def table(spark):
    path = scratch_path(spark, "cleaned")
    etl.write_cleaned(etl.clean(events.raw_fixes(spark, SF_DIR)), path)
    return path


def test_index_follows_writes(spark):
    path = scratch_path(spark, "cleaned")
    etl.write_cleaned(landed(spark, "2025-06-01 01:00:00", "2025-06-01 03:00:00", "2025-06-02 04:00:00", "2025", None), path)
    index = days.day_index(spark, path).selectExpr("dt", "fixes", "CAST(last_time AS STRING) AS last_time")
    assert rows(index) == [(None, 1, None), ("2025", 1, None), ("2025-06-01", 2, "2025-06-01 03:00:00"), ("2025-06-02", 1, "2025-06-02 04:00:00")]
    assert days.latest_day(spark, path) == days.Day("2025-06-02", 1, "2025-06-02 04:00:00")
    etl.write_cleaned(landed(spark, "2025-06-02 09:00:00", "2025-06-03 x", "2025-06-02 08:00:00"), path)
    assert days.latest_day(spark, path) == days.Day("2025-06-03", 1, None)
    assert rows(days.day_index(spark, path).select("dt", "fixes")) == [(None, 1), ("2025", 1), ("2025-06-01", 2), ("2025-06-02", 2), ("2025-06-03", 1)]
    # The index is no part of the table.
    assert cleaned.read_cleaned(spark, path).count() == 7
    before = rows(days.day_index(spark, path))
    days.rebuild(spark, path)
    assert rows(days.day_index(spark, path)) == before


def test_speeds_of_the_day_round_as_their_text(spark):
    """As a FLOAT, 18.05 is 18.0499992, which rounds to 18.0."""
    texts = {f"v{k}": f"{k}.05" for k in (0, 3, 16, 17, 18, 19)} | {"w": "16.55", "u": "0.000123", "x": "17.005"}
    path = scratch_path(spark, "cleaned")
    data = [(v, "1", "1", speed, "1", "2025-06-01 01:00:00", v, "s") for v, speed in texts.items()]
    etl.write_cleaned(etl.clean(spark.createDataFrame(data, RAW)), path)
    today = Today(spark, path)
    want = [("u", 0.0), ("v0", 0.1), ("v16", 16.1), ("v17", 17.1), ("v18", 18.1), ("v19", 19.1), ("v3", 3.1), ("w", 16.6), ("x", 17.0)]
    assert rows(today.latest_status(), "ship", "speed") == want
    of_gear = {**{v: float(text) for v, text in texts.items()}, "u": 0.0, "x": 17.01}
    assert rows(today.speed_by_gear(), "type", "value") == sorted(of_gear.items())
    one = scratch_path(spark, "cleaned")
    etl.write_cleaned(etl.clean(spark.createDataFrame([r for r in data if r[0] == "v18"], RAW)), one)
    assert rows(Today(spark, one).kpi(), "avg_speed") == [(18.1,)]


def test_written_speeds_are_the_numbers_of_their_texts(spark):
    """All speeds of up to three decimals, and small ones of six digits."""
    texts = spark.range(1, 20_000).selectExpr("CAST(id / 1000 AS DECIMAL(20,3)) AS d").union(spark.range(1, 1_000_000, 7).selectExpr("CAST(id / 100000 AS DECIMAL(20,5))"))
    read = cleaned.speed_as_written(texts.selectExpr("CAST(d AS DOUBLE) AS want", "CAST(CAST(CAST(d AS STRING) AS FLOAT) AS DOUBLE) AS speed"))
    assert read.where("speed <> want OR speed IS NULL").count() == 0
    assert rows(cleaned.speed_as_written(spark.sql("SELECT CAST(NULL AS DOUBLE) AS speed"))) == [(None,)]


def test_tables_without_a_date(spark):
    path = scratch_path(spark, "cleaned")
    etl.write_cleaned(landed(spark, "garbage"), path)
    today = Today(spark, path)
    assert days.latest_day(spark, path) is None
    assert rows(today.kpi()) == [(0, 0, 0.0, 0, 0)] and rows(today.latest_status()) == []


@pytest.mark.parametrize("view", ["kpi", "latest_status", "latest_position", "abnormal_stops", "area_violations", "gear_counts", "hour_hist", "grid_density"])
def test_views_scan_one_day_once(spark, table, view):
    today = Today(spark, table)
    made = getattr(today, view)()
    plan = plan_of(made)
    scans = re.findall(r"^\(\d+\) Scan parquet.*?(?=^\(\d+\) )", plan, re.M | re.S)
    assert len(scans) == 1 and "(dt#" in scans[0] and f"= {today.dt})" in scans[0] and "PartitionFilters" in scans[0]


def test_views_equal_the_operators(spark, table):
    today, df = Today(spark, table), cleaned.read_cleaned(spark, table)
    assert rows(today.kpi()) == rows(monitor.kpi_day(df))
    assert rows(today.abnormal_stops()) == rows(alerts.abnormal_stop_today(df))
    assert rows(today.latest_status()) == rows(monitor.latest_status(df))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 20])
def test_prefix_of_the_table_equals_sorting(spark, crowded, n):
    every = cleaned.read_cleaned(spark, crowded)
    want = every.orderBy("record_time", "point_id").limit(n)
    assert rows(prefix.table_prefix(spark, crowded, n), "point_id") == rows(want, "point_id")


@pytest.fixture(scope="module")
def crowded(spark):
    """Equal seconds, fixes without a time on a later day, and on no day."""
    path = scratch_path(spark, "cleaned")
    times = ["2025-06-01 01:00:00"] * 3 + ["2025-06-02 04:00:00"] * 2 + ["2025-06-03 01", None, "2025-06-03 01:00:00", "garbage"]
    frame = spark.createDataFrame([("a", "1", "1", "2", "1", t, "g", str(k)) for k, t in enumerate(times)], RAW)
    etl.write_cleaned(etl.clean(frame), path)
    return path


def test_prefix_scans_the_days_up_to_its_last_fix(spark, table):
    made = prefix.table_prefix(spark, table, 300)
    last = max(r.dt for r in made.select("dt").distinct().collect())
    assert last < days.latest_day(spark, table).dt
    assert re.search(r"PartitionFilters: \[.*<= " + last, plan_of(made))
