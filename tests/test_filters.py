"""Current day and month, replay prefix, labels, time parsing."""

from __future__ import annotations

import random

import pytest
from conftest import plan_of, rows

from fleetlens.functions import expressions as X
from fleetlens.operators import filters


def test_current_day_and_month_turn(fixes):
    df = fixes(
        {"record_time": "2025-06-30 23:59:59"},
        {"record_time": "2025-07-01 00:00:00"},
        {"record_time": "2025-07-02 10:00:00"},
        {"record_time": "2025-07-02 09:00:00"},
    )
    assert rows(filters.current_day(df), "point_id") == [(2,), (3,)]
    assert rows(filters.current_month(df), "point_id") == [(1,), (2,), (3,)]
    assert rows(filters.current_day(df, as_of="2025-06-30"), "point_id") == [(0,)]
    assert rows(filters.current_month(df, as_of="2025-06-15"), "point_id") == [(0,)]
    assert rows(filters.latest_date(df)) == [("2025-07-02",)]


def test_empty_input(fixes, spark):
    df = fixes().where("false")
    assert filters.current_day(df).count() == 0
    assert filters.latest_date(df).first().today == str(spark.sql("SELECT current_date()").first()[0])
    assert filters.cut_prefix(df, 3).count() == 0


def test_valid_points_drop_null_and_zero(fixes):
    df = fixes({}, {"x": None, "y": None}, {"x": 0.0}, {"y": 0.0}, {"x": -5.0})
    assert rows(filters.valid_points(df), "point_id") == [(0,), (4,)]
    assert rows(df.where(X.HAS_POINT), "point_id") == [(0,), (2,), (3,), (4,)]


@pytest.fixture(scope="module")
def crowded(fixes):
    """Many equal times, a few rows without a time, scattered ids."""
    draw = random.Random(3)
    times = ["2025-06-01 04:00:00"] * 40 + ["2025-06-01 20:00:00"] * 60 + ["2025-06-02 04:00:00"] * 10 + ["bad"] * 5
    draw.shuffle(times)
    ids = draw.sample(range(10**12), len(times))
    return fixes(*[{"point_id": i, "record_time": t} for i, t in zip(ids, times, strict=True)]).repartition(4).cache()


@pytest.mark.parametrize("n", [0, 1, 3, 5, 6, 45, 46, 70, 104, 105, 106, 115, 200])
@pytest.mark.parametrize("ranges", [2, 7, 4096])
def test_cut_prefix_equals_sorting(crowded, n, ranges):
    expected = crowded.orderBy("record_time", "point_id").limit(n)
    assert rows(filters.cut_prefix(crowded, n, ranges), "point_id") == rows(expected, "point_id")


def test_cut_prefix_with_equal_ids(fixes):
    df = fixes(*[{"point_id": 9} for _ in range(8)])
    assert filters.cut_prefix(df, 3, ranges=2).count() == 3


def test_prefix_beyond_the_end_is_everything(fixes):
    assert filters.replay_prefix(fixes({}, {}), 50).count() == 2


def test_label_defaults(fixes):
    df = fixes({"sea_area": None}, {"sea_area": ""}, {"sea_area": "南海北部"})
    labels = df.selectExpr(X.label_if_null("sea_area"), X.label_if_blank("sea_area"))
    assert rows(labels) == [("", "未知"), ("南海北部", "南海北部"), ("未知", "未知")]


def test_time_parsing_falls_back_to_digits(spark):
    df = spark.createDataFrame([("2025-06-01 04:05:06",), ("2025-06-01 23",), ("2025-06-01",), ("x",)], "t string")
    parsed = df.selectExpr("t", X.time_text(X.parse_time("t")), X.hour_of_text("t"), X.day_of_text("t"))
    assert rows(parsed) == [
        ("2025-06-01", None, None, "2025-06-01"),
        ("2025-06-01 04:05:06", "2025-06-01 04:05:06", 4, "2025-06-01"),
        ("2025-06-01 23", None, 23, "2025-06-01"),
        ("x", None, None, "x"),
    ]


def test_rounding_reads_as_written(spark):
    df = spark.sql("SELECT * FROM VALUES (2.345D), (1.005D), (CAST('NaN' AS DOUBLE)), (-2.345D) AS v(v)")
    assert rows(df.selectExpr(X.half_up("v", 2))) == [(None,), (-2.35,), (1.01,), (2.35,)]


def test_latest_only(fixes):
    df = fixes({"record_time": "2025-06-01 04:00:00"}, {"record_time": "2025-06-02 04:00:00"})
    result = df.selectExpr("point_id", "CAST(record_time AS STRING) AS time")
    assert rows(filters.latest_only(result, "time"), "point_id") == [(1,)]
