"""Cleaned layer: typed Parquet partitioned by the text column `dt`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import schema as S
from fleetlens.functions import expressions as X


def as_trajectory(cleaned: DataFrame) -> DataFrame:
    """Cleaned rows as the frame the operators take: double speed, parsed time; `text_hour` is the hour by the time's text."""
    computed = {"speed": "CAST(speed AS DOUBLE) AS speed", "record_time": "event_time AS record_time"}
    columns = [computed.get(name, name) for name in S.TRAJECTORY_COLUMNS]
    return cleaned.selectExpr(*columns, f"{X.hour_of_text('record_time')} AS text_hour")


def speed_as_written(df: DataFrame) -> DataFrame:
    """The speed as its text named it, for results that round it: 18.05, not 18.0499992, which is what the column's FLOAT becomes as a DOUBLE.

    The shortest text of a FLOAT gives back every number of up to six digits. A filter on this speed does not reach the files.
    """
    return df.withColumn("speed", F.expr("CAST(CAST(CAST(speed AS FLOAT) AS STRING) AS DOUBLE)"))


def read_cleaned(spark: SparkSession, path: str, dt: str | None = None) -> DataFrame:
    """Scan the cleaned table; `dt` prunes the scan to one day's folder."""
    df = spark.read.schema(S.CLEANED_SCHEMA).parquet(path)
    return as_trajectory(df if dt is None else df.where(F.col("dt") == dt))


def ordered_extract(trajectory: DataFrame) -> DataFrame:
    """All fixes in time order: a range-partitioned sort. `point_id` makes ties splittable and stable."""
    return trajectory.select(*S.TRAJECTORY_COLUMNS).orderBy("record_time", "point_id")


def load_audit(trajectory: DataFrame) -> DataFrame:
    return trajectory.selectExpr(
        "count(*) AS row_count",
        f"{X.time_text('min(record_time)')} AS first_time",
        f"{X.time_text('max(record_time)')} AS last_time",
    )
