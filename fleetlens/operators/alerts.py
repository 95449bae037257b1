"""Abnormal stops and sea-area violations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import schema as S
from fleetlens.functions import expressions as X
from fleetlens.operators.filters import current_day, last, valid_points


def abnormal_stop(df: DataFrame) -> DataFrame:
    """Slow fixes with coordinates per vessel and area, where there are at least two."""
    area = F.expr(f"{X.label_if_null('sea_area')} AS sea_area")
    stops = df.where(f"{X.IS_SLOW} AND {X.HAS_POINT}").groupBy("vessel_id", area)
    means = stops.agg(*X.exprs("count(*) AS cnt", "avg(x) AS avg_x", "avg(y) AS avg_y"))
    return means.where(f"cnt >= {S.MIN_STOP_FIXES}")


def stop_record(stops: DataFrame) -> DataFrame:
    """Abnormal stops in the layout of the result table.

    Its time columns are empty and its duration column holds the number of slow fixes.
    """
    return stops.selectExpr(
        "vessel_id",
        "'' AS start_time",
        "'' AS end_time",
        "CAST(cnt AS DOUBLE) AS duration_hrs",
        "avg_x AS coord_x",
        "avg_y AS coord_y",
    )


def slow_groups(day: DataFrame) -> DataFrame:
    """Slow fixes per vessel and area, also those without coordinates; means are over the others."""
    keys = X.exprs("vessel_id AS ship_id", f"{X.label_if_blank('sea_area')} AS sea_area")
    means = [f"avg({axis}) FILTER (WHERE {X.HAS_POINT}) AS {axis}" for axis in ("x", "y")]
    groups = day.where(X.IS_SLOW).groupBy(*keys).agg(*X.exprs("count(*) AS cnt", *means))
    return groups.where(f"cnt >= {S.MIN_STOP_FIXES}")


def largest_stops(groups: DataFrame, k: int) -> DataFrame:
    top = groups.orderBy(F.desc("cnt"), "ship_id", "sea_area").limit(k)
    means = [f"coalesce({X.half_up(axis, 2)}, 0D) AS {axis}" for axis in ("x", "y")]
    return top.selectExpr("ship_id", "sea_area", *means, "cnt")


def abnormal_stop_today(df: DataFrame, k: int = 30, as_of: str | None = None) -> DataFrame:
    """The day's largest stops, stamped with the day's latest time."""
    day = current_day(df, as_of)
    return largest_stops(slow_groups(day), k).withColumn("time", last(day, X.time_text("max(record_time)")))


def stop_alerts(stops: DataFrame) -> DataFrame:
    """Severity and message text for today's stops."""
    message = f"format_string('{S.STOP_MESSAGE}', ship_id, sea_area, cnt) AS message"
    return stops.selectExpr("ship_id", "sea_area", "cnt", "IF(cnt > 3, 1, 2) AS level", message)


def area_rectangles(spark: SparkSession, areas: Sequence[S.Area] = S.AREAS) -> DataFrame:
    """The allowed rectangles as a constant table."""
    rows = ", ".join(f"('{a.name}', {a.x_min}D, {a.x_max}D, {a.y_min}D, {a.y_max}D)" for a in areas)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS areas(area, x_min, x_max, y_min, y_max)")


def violating_points(df: DataFrame, areas: Sequence[S.Area] = S.AREAS) -> DataFrame:
    """Valid fixes outside the rectangle of the area they report; fixes of other areas are never flagged.

    One probe of the constant table per fix, in the map task.
    """
    rectangles = F.broadcast(area_rectangles(df.sparkSession, areas))
    inside = "x BETWEEN x_min AND x_max AND y BETWEEN y_min AND y_max"
    matched = valid_points(df).join(rectangles, F.expr(f"sea_area = area AND NOT ({inside})"))
    return matched.select(*df.columns)


def area_violations(df: DataFrame) -> DataFrame:
    time = f"{X.time_text('record_time')} AS ts"
    return violating_points(df).selectExpr("vessel_id", "sea_area", "x AS coord_x", "y AS coord_y", time)


def first_violations(points: DataFrame, k: int) -> DataFrame:
    time = f"{X.time_text('record_time')} AS time"
    first = points.orderBy("record_time", "point_id").limit(k)
    return first.selectExpr("vessel_id AS ship_id", "sea_area", "x", "y", time)


def area_violations_today(df: DataFrame, k: int = 500, as_of: str | None = None) -> DataFrame:
    """The day's first `k` violations."""
    return first_violations(violating_points(current_day(df, as_of)), k)
