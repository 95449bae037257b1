"""Landing layer to cleaned layer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetlens import schema as S
from fleetlens.functions import expressions as X
from fleetlens.sources import days


def clean(raw: DataFrame) -> DataFrame:
    """Type the text columns and keep 0 < speed < 20. Values that do not parse become NULL.

    Coordinates that are not finite become NULL as well. Without a `point_id` of its own a fix gets one from
    its content: equal rows have equal ids, and different rows share one only if a 63-bit hash collides.
    """
    own_id = "CAST(point_id AS BIGINT)" if "point_id" in raw.columns else None
    # NULL and the end of a value have characters of their own: a hash of the columns would pass over NULLs.
    content = ", ".join(f"coalesce({c}, char(2))" for c in S.RAW_COLUMNS)
    content_id = f"shiftrightunsigned(xxhash64(concat_ws(char(1), {content})), 1)"
    speed = "try_cast(speed AS DOUBLE)"
    return raw.where(f"{speed} > 0D AND {speed} < {S.MAX_SPEED}D").selectExpr(
        "vessel_id",
        f"{X.finite('try_cast(x AS DOUBLE)')} AS x",
        f"{X.finite('try_cast(y AS DOUBLE)')} AS y",
        "try_cast(speed AS FLOAT) AS speed",
        "try_cast(direction AS INT) AS direction",
        "record_time",
        "operation_type",
        "sea_area",
        f"{own_id or content_id} AS point_id",
        f"{X.parse_time('record_time')} AS event_time",
        f"{X.day_of_text('record_time')} AS dt",
    )


def _laid_out(cleaned: DataFrame) -> DataFrame:
    """One shuffle by day whose partitions are split or merged to a common size, so that a busy day is
    written by many tasks and a quiet one by a single task. Inside a file, a vessel's fixes are together:
    its id compresses well and later per-vessel aggregations combine most rows in the map task."""
    return cleaned.hint("rebalance", "dt").sortWithinPartitions("dt", "vessel_id", "event_time")


def write_cleaned(cleaned: DataFrame, path: str) -> None:
    """Replace the days present in `cleaned`; other days of the table stay as they are. The day index follows."""
    rows, seen = days.written_days(_laid_out(cleaned))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path)
    days.record(cleaned.sparkSession, path, seen)


def insert_cleaned(cleaned: DataFrame, table: str) -> None:
    """The same into a declared table, whose declaration says that an insert replaces the days it brings, and no others."""
    columns = [field.name for field in S.CLEANED_SCHEMA]
    _laid_out(cleaned.select(*columns)).write.insertInto(table, overwrite=True)
    cleaned.sparkSession.sql(f"REFRESH TABLE {table}")
