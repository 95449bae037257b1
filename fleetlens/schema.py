"""Table schemas and the fixed values of the fishing-fleet domain."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

RAW_COLUMNS = ("vessel_id", "x", "y", "speed", "direction", "record_time", "operation_type", "sea_area")

# Landing layer: every column is text, so that a dirty value never fails a load.
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

# Cleaned layer on disk; `dt` is the partition column. The time is kept as text and, parsed once, as
# `event_time`; readers take the latter.
CLEANED_SCHEMA = T.StructType(
    [
        T.StructField("vessel_id", T.StringType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("speed", T.FloatType()),
        T.StructField("direction", T.IntegerType()),
        T.StructField("record_time", T.StringType()),
        T.StructField("operation_type", T.StringType()),
        T.StructField("sea_area", T.StringType()),
        T.StructField("point_id", T.LongType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("dt", T.StringType()),
    ]
)

# In-memory trajectory frame that every operator takes.
TRAJECTORY_COLUMNS = (
    "point_id",
    "vessel_id",
    "x",
    "y",
    "speed",
    "direction",
    "record_time",
    "operation_type",
    "sea_area",
    "dt",
)

# The ten result tables of the warehouse.
RESULT_TABLES = {
    "ads_result001": "sea_area STRING, grid_x INT, grid_y INT, density BIGINT",
    "ads_result002": "op_type STRING, cnt BIGINT",
    "ads_result003": "hour_val INT, cnt BIGINT",
    "ads_result004": "vessel_id STRING, work_date STRING, work_hours DOUBLE",
    "ads_result005": "vessel_id STRING, days_at_sea BIGINT",
    "ads_result006": "op_type STRING, avg_speed DOUBLE, max_speed DOUBLE, min_speed DOUBLE, cnt BIGINT",
    "ads_result007": "work_date STRING, cnt BIGINT",
    "ads_result008": "vessel_id STRING, max_dist DOUBLE",
    "ads_result009": "vessel_id STRING, start_time STRING, end_time STRING, duration_hrs DOUBLE, coord_x DOUBLE, coord_y DOUBLE",
    "ads_result010": "vessel_id STRING, sea_area STRING, coord_x DOUBLE, coord_y DOUBLE, ts STRING",
}

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


class Area(NamedTuple):
    """A sea area, and the rectangle (inclusive, km) its vessels are allowed to work in."""

    name: str
    x_min: float
    x_max: float
    y_min: float
    y_max: float


# Sea areas with their allowed rectangles.
AREAS = (
    Area("渤海湾", 100.0, 200.0, 320.0, 400.0),
    Area("黄海中部", 200.0, 300.0, 250.0, 380.0),
    Area("东海近海", 300.0, 450.0, 150.0, 320.0),
    Area("舟山群岛", 350.0, 450.0, 100.0, 250.0),
    Area("南海北部", 400.0, 600.0, 0.0, 200.0),
)

# Gears, labels, thresholds.
GEARS = ("拖网", "围网", "流刺网")
UNKNOWN = "未知"
WORKING = "作业中"
RETURNING = "返港中"
DURATION_LABELS = ("0-2小时", "2-4小时", "4-6小时", "6-8小时", "8-10小时", "10小时以上")
DURATION_UPPER_HOURS = (2.0, 4.0, 6.0, 8.0, 10.0)
PEAK_HOURS = (6, 7, 8, 9, 14, 15, 16, 17)
GRID_KM = 10.0
# Coordinates beyond this have no grid cell.
GRID_LIMIT = 1e9
MAX_SPEED = 20.0
SLOW_SPEED = 3.0
WORKING_SPEED = 5.0
MIN_STOP_FIXES = 2
STOP_MESSAGE = "渔船 %s 在 %s 出现 %d 个低速点"
