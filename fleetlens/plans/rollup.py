"""Mergeable summaries of the fixes, from which most indicators follow without another scan.

Every column is a count, sum, minimum or maximum. Summaries of two sets of fixes therefore add up to the
summary of both, in any order: a batch job builds them per day, a stream appends them per micro-batch, and
the same functions read either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens import schema as S
from fleetlens.functions import expressions as X
from fleetlens.operators import alerts, duration, gear
from fleetlens.operators.filters import current_day, current_month, last

MEAN_SPEED = "try_divide(sum(speed_sum), CAST(sum(speeds) AS DOUBLE))"
MEAN_SLOW_X = "try_divide(sum(slow_x_sum), CAST(sum(slow_points) AS DOUBLE))"
MEAN_SLOW_Y = "try_divide(sum(slow_y_sum), CAST(sum(slow_points) AS DOUBLE))"


# The day of a summary row, as the direct operators have it: NULL where the text names no date.
DATE = X.DATED


def activity_rollup(df: DataFrame) -> DataFrame:
    """Fixes per day, hour, vessel, gear and area; and per hour by the time's text if the frame carries it."""
    stopped = f"{X.IS_SLOW} AND {X.HAS_POINT}"
    hours = [F.expr(f"{X.HOUR} AS hour"), *[c for c in ("text_hour",) if c in df.columns]]
    return df.groupBy("dt", *hours, "vessel_id", "operation_type", "sea_area").agg(
        *X.exprs(
            "count(*) AS fixes",
            "count(speed) AS speeds",
            "sum(speed) AS speed_sum",
            "min(speed) AS speed_min",
            "max(speed) AS speed_max",
            "min(record_time) AS first_time",
            "max(record_time) AS last_time",
            f"count_if({X.IS_SLOW}) AS slow_fixes",
            f"count_if({stopped}) AS slow_points",
            f"sum(x) FILTER (WHERE {stopped}) AS slow_x_sum",
            f"sum(y) FILTER (WHERE {stopped}) AS slow_y_sum",
        )
    )


def vessel_day_rollup(df: DataFrame) -> DataFrame:
    """Fixes per day and vessel: the part of the activity summary that the cumulative views need."""
    days = df.groupBy(F.expr(f"{X.DAY} AS day"), "vessel_id").agg(
        *X.exprs("count(*) AS fixes", "min(record_time) AS first_time", "max(record_time) AS last_time")
    )
    return days.selectExpr("CAST(day AS STRING) AS dt", "vessel_id", "fixes", "first_time", "last_time")


def grid_rollup(df: DataFrame) -> DataFrame:
    """Which vessels were in which valid grid cell, per day and area."""
    cell = X.exprs(f"{X.grid_index('x')} AS grid_x", f"{X.grid_index('y')} AS grid_y")
    visits = df.where(X.HAS_CELL).groupBy("dt", "sea_area", *cell, "vessel_id")
    return visits.agg(F.expr("count(*) AS fixes"))


# --- offline indicators --------------------------------------------------------------------------


def grid_density(grid: DataFrame) -> DataFrame:
    return grid.groupBy("sea_area", "grid_x", "grid_y").agg(F.expr("count(DISTINCT vessel_id) AS density"))


def vessels_by_gear(rollup: DataFrame) -> DataFrame:
    return gear.vessels_by_gear(rollup)


def hour_hist(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy(F.expr("hour AS hour_val")).agg(F.expr("sum(fixes) AS cnt")).orderBy("hour_val")


def vessel_days(rollup: DataFrame) -> DataFrame:
    seconds = X.seconds_between("min(first_time)", "max(last_time)")
    return rollup.groupBy("vessel_id", F.expr(f"{DATE} AS dt")).agg(F.expr(f"{seconds} AS seconds"))


def work_hours(rollup: DataFrame) -> DataFrame:
    return vessel_days(rollup).selectExpr("vessel_id", "dt AS work_date", "seconds / 3600D AS work_hours")


def days_at_sea(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("vessel_id").agg(F.expr(f"count(DISTINCT {DATE}) AS days_at_sea"))


def speed_by_gear(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy(F.expr("operation_type AS op_type")).agg(
        *X.exprs(
            f"{X.half_up(MEAN_SPEED, 2)} AS avg_speed",
            f"{X.half_up('max(speed_max)', 2)} AS max_speed",
            f"{X.half_up('min(speed_min)', 2)} AS min_speed",
            "sum(fixes) AS cnt",
        )
    )


def daily_points(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy(F.expr(f"{DATE} AS work_date")).agg(F.expr("sum(fixes) AS cnt"))


def abnormal_stop(rollup: DataFrame) -> DataFrame:
    area = F.expr(f"{X.label_if_null('sea_area')} AS sea_area")
    stops = rollup.where("slow_points > 0").groupBy("vessel_id", area)
    means = stops.agg(*X.exprs("sum(slow_points) AS cnt", f"{MEAN_SLOW_X} AS avg_x", f"{MEAN_SLOW_Y} AS avg_y"))
    return means.where(f"cnt >= {S.MIN_STOP_FIXES}")


# --- cumulative views ----------------------------------------------------------------------------


def work_hours_buckets(rollup: DataFrame) -> DataFrame:
    return duration.duration_buckets(vessel_days(rollup).where("seconds IS NOT NULL"))


def top_vessels(rollup: DataFrame, k: int = 20) -> DataFrame:
    counts = rollup.groupBy(F.expr("vessel_id AS ship")).agg(F.expr("sum(fixes) AS value"))
    return counts.orderBy(F.desc("value"), "ship").limit(k)


def last_days(rollup: DataFrame, days: int = 7) -> DataFrame:
    daily = rollup.groupBy(F.expr(f"{DATE} AS date")).agg(F.expr("sum(fixes) AS value"))
    return daily.orderBy(F.desc("date")).limit(days).orderBy("date")


# --- current-day and current-month views ---------------------------------------------------------


def gear_counts_today(rollup: DataFrame) -> DataFrame:
    name = F.expr(f"{X.label_if_blank('operation_type')} AS name")
    return current_day(rollup).groupBy(name).agg(F.expr("sum(fixes) AS value"))


def speed_by_gear_today(rollup: DataFrame) -> DataFrame:
    name = F.expr(f"{X.label_if_blank('operation_type')} AS type")
    means = current_day(rollup).groupBy(name).agg(F.expr(f"{X.half_up(MEAN_SPEED, 2)} AS value"))
    return means.orderBy(F.desc("value"), "type")


def hour_hist_today(rollup: DataFrame) -> DataFrame:
    hour = "coalesce(hour, text_hour)" if "text_hour" in rollup.columns else "hour"
    hours = hour_hist(current_day(rollup).withColumn("hour", F.expr(hour)).where("hour IS NOT NULL"))
    return hours.selectExpr("CAST(hour_val AS STRING) AS hour", "cnt AS value")


def grid_density_today(grid: DataFrame) -> DataFrame:
    cell = X.exprs("grid_x * 10 AS x", "grid_y * 10 AS y")
    return current_day(grid).groupBy(*cell).agg(F.expr("count(DISTINCT vessel_id) AS ship_cnt"))


def _slow_groups(day: DataFrame) -> DataFrame:
    keys = X.exprs("vessel_id AS ship_id", f"{X.label_if_blank('sea_area')} AS sea_area")
    groups = day.where("slow_fixes > 0").groupBy(*keys)
    means = groups.agg(*X.exprs("sum(slow_fixes) AS cnt", f"{MEAN_SLOW_X} AS x", f"{MEAN_SLOW_Y} AS y"))
    return means.where(f"cnt >= {S.MIN_STOP_FIXES}")


def abnormal_stop_today(rollup: DataFrame, k: int = 30) -> DataFrame:
    day = current_day(rollup)
    return alerts.largest_stops(_slow_groups(day), k).withColumn("time", last(day, X.time_text("max(last_time)")))


def _figures(rows: DataFrame, cells: DataFrame, points: str, ships: str, speed: str, grids: str) -> DataFrame:
    return rows.selectExpr(
        f"coalesce(sum(fixes), 0L) AS {points}",
        f"count(DISTINCT vessel_id) AS {ships}",
        f"coalesce({X.half_up(MEAN_SPEED, 1)}, 0D) AS {speed}",
    ).withColumn(grids, last(cells, "count(DISTINCT grid_x, grid_y)"))


def kpi_day(rollup: DataFrame, grid: DataFrame) -> DataFrame:
    """Day figures. The day is the last one with fixes, which may be one without a single valid cell."""
    day, cells = current_day(rollup), grid.where(F.col("dt") == last(rollup))
    figures = _figures(day, cells, "total_points", "total_ships", "avg_speed", "hot_grid_count")
    return figures.withColumn("abnormal_count", last(_slow_groups(day), "count(*)"))


def kpi_month(rollup: DataFrame, grid: DataFrame) -> DataFrame:
    cells = grid.where(F.expr("substring(dt, 1, 7)") == last(rollup, f"substring(max({X.DATED}), 1, 7)"))
    names = ("monthly_points", "monthly_ships", "monthly_avg_speed", "monthly_hot_grid_count")
    return _figures(current_month(rollup), cells, *names)
