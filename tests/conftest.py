from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from check_oracle import local_session  # noqa: E402
from fleetlens.session import configure  # noqa: E402

SCHEMA = (
    "point_id bigint, vessel_id string, x double, y double, speed double, direction int, record_time string, "
    "operation_type string, sea_area string"
)


@pytest.fixture(scope="session")
def spark():
    session = configure(local_session("8"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def fixes(spark):
    """Trajectory frame from dicts; what a row leaves out gets a default, and ids count up."""

    def build(*rows: dict):
        defaults = {
            "vessel_id": "a", "x": 110.0, "y": 330.0, "speed": 4.0, "direction": 0,
            "record_time": "2025-06-01 04:00:00", "operation_type": "拖网", "sea_area": "渤海湾",
        }
        names = [field.split()[0] for field in SCHEMA.split(", ")]
        filled = [{"point_id": i, **defaults, **row} for i, row in enumerate(rows)]
        df = spark.createDataFrame([tuple(row[n] for n in names) for row in filled], SCHEMA)
        return df.selectExpr(
            *[n for n in names if n != "record_time"],
            "try_to_timestamp(record_time, 'yyyy-MM-dd HH:mm:ss') AS record_time",
            "substring(record_time, 1, 10) AS dt",
        )

    return build


def rows(df, *columns):
    """Result rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, v) for v in r])


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
