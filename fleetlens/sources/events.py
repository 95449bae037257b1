"""Trajectories projected from the `events` table, so that the operators can run on the given data.

Users become vessels, values become speeds, and positions are placed inside the home waters of the
vessel's area by the event number. Some coordinates are NULL or zero, and some gears and areas are NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlens import schema as S
from fleetlens.functions import expressions as X

# The stored time has no zone; read as a timestamp of the session zone, UTC, it needs no cast per row.
EVENT_COLUMNS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"

# Home waters per area, as x start, x width, y start, y width (km).
HOME_WATERS = (
    ("渤海湾", 100.0, 100.0, 300.0, 100.0),
    ("黄海中部", 250.0, 150.0, 200.0, 150.0),
    ("东海近海", 450.0, 150.0, 150.0, 150.0),
    ("舟山群岛", 500.0, 80.0, 280.0, 80.0),
    ("南海北部", 300.0, 200.0, 50.0, 130.0),
)


def _by_area(position: int) -> str:
    """Lookup in a constant array: compact code, however often Catalyst repeats the expression in a filter."""
    values = [water[position] for water in HOME_WATERS]
    literals = ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}D" for v in values)
    return f"get(array({literals}), CAST(user_id % 5 AS INT))"


def _coordinate(start: int, width: int, stride: int) -> str:
    thousandths = f"CAST(event_id * {stride} % 1000 AS DOUBLE)"
    inside = f"{_by_area(start)} + {_by_area(width)} * {thousandths} / 1000D"
    return f"CASE event_id % 100 WHEN 0 THEN NULL WHEN 1 THEN 0D ELSE {inside} END"


_GEAR = (
    f"CASE event_type WHEN 'click' THEN '{S.GEARS[0]}' WHEN 'view' THEN '{S.GEARS[1]}' "
    f"WHEN 'error' THEN NULL ELSE '{S.GEARS[2]}' END"
)

_PROJECTION = (
    "event_id AS point_id",
    "CAST(user_id AS STRING) AS vessel_id",
    f"{_coordinate(1, 2, 37)} AS x",
    f"{_coordinate(3, 4, 61)} AS y",
    "value / 10D AS speed",
    "CAST(event_id * 7 % 360 AS INT) AS direction",
    "date_trunc('SECOND', ts) AS record_time",
    f"{_GEAR} AS operation_type",
    f"IF(event_id % 50 = 3, NULL, {_by_area(0)}) AS sea_area",
    "CAST(to_date(ts) AS STRING) AS dt",
)


def project(events: DataFrame) -> DataFrame:
    """All events as fixes, before the cleaning rule."""
    return events.selectExpr(*_PROJECTION)


def clean_events(events: DataFrame) -> DataFrame:
    """The cleaning rule 0 < speed < 20, put on the stored column so that Parquet can skip row groups."""
    return events.where(f"value > 0D AND value < {10 * S.MAX_SPEED}D")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENT_COLUMNS).parquet(f"{sf_dir}/events.parquet")


def trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned trajectory frame."""
    return project(clean_events(read_events(spark, sf_dir)))


def raw_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uncleaned fixes as landing-layer text columns, with `point_id` beside them."""
    texts = {"record_time": f"{X.time_text('record_time')} AS record_time"}
    columns = [texts.get(name, f"CAST({name} AS STRING) AS {name}") for name in S.RAW_COLUMNS]
    return project(read_events(spark, sf_dir)).selectExpr("point_id", *columns)
