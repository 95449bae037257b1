"""Fixes per hour, day and month; days at sea and fixes per vessel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens import schema as S
from fleetlens.functions import expressions as X
from fleetlens.operators.filters import current_day


def hour_hist(df: DataFrame) -> DataFrame:
    """Fixes per hour of day; hours without fixes have no row."""
    hours = df.groupBy(F.expr("hour(record_time) AS hour_val")).agg(F.expr("count(*) AS cnt"))
    return hours.orderBy("hour_val")


def hour_hist_peak(df: DataFrame) -> DataFrame:
    peak = ", ".join(map(str, S.PEAK_HOURS))
    return hour_hist(df.where("record_time IS NOT NULL")).selectExpr("*", f"hour_val IN ({peak}) AS is_peak")


def hour_hist_today(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Hours as text, in numeric order. A fix whose time did not parse counts by the digits of its hour, if they are there."""
    hours = current_day(df, as_of).groupBy(F.expr(f"{X.hour_or_digits(df.columns)} AS hour_val")).agg(F.expr("count(*) AS value"))
    return hours.where("hour_val IS NOT NULL").orderBy("hour_val").selectExpr("CAST(hour_val AS STRING) AS hour", "value")


def daily_points(df: DataFrame) -> DataFrame:
    daily = df.groupBy(F.expr(f"{X.DAY} AS day")).agg(F.expr("count(*) AS cnt"))
    return daily.selectExpr("CAST(day AS STRING) AS work_date", "cnt")


def last_days(df: DataFrame, days: int = 7) -> DataFrame:
    """Fixes of the last `days` dates that have any, in ascending order."""
    daily = df.groupBy(F.expr(f"{X.DAY} AS day")).agg(F.expr("count(*) AS value"))
    recent = daily.orderBy(F.desc("day")).limit(days).orderBy("day")
    return recent.selectExpr("CAST(day AS STRING) AS date", "value")


def monthly_points(df: DataFrame) -> DataFrame:
    """Fixes and active vessels per calendar month number, whatever the year."""
    months = df.where("record_time IS NOT NULL").groupBy(F.expr("month(record_time) AS month"))
    return months.agg(*X.exprs("count(*) AS points", "count(DISTINCT vessel_id) AS vessels"))


def days_at_sea(df: DataFrame) -> DataFrame:
    return df.groupBy("vessel_id").agg(F.expr(f"count(DISTINCT {X.DAY}) AS days_at_sea"))


def top_days_at_sea(df: DataFrame, k: int = 30) -> DataFrame:
    """The vessels with most days at sea, fewest first."""
    top = days_at_sea(df).orderBy(F.desc("days_at_sea"), "vessel_id").limit(k)
    return top.orderBy("days_at_sea", F.desc("vessel_id"))


def top_vessels(df: DataFrame, k: int = 20) -> DataFrame:
    """The vessels with most fixes."""
    counts = df.groupBy(F.expr("vessel_id AS ship")).agg(F.expr("count(*) AS value"))
    return counts.orderBy(F.desc("value"), "ship").limit(k)
