"""Current-day views of the cleaned table. The day comes from the day index, so each view scans one folder, once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators import activity, alerts, density, gear, monitor
from fleetlens.operators.filters import current_day
from fleetlens.sources import days
from fleetlens.sources.cleaned import read_cleaned, speed_as_written


class Today:
    """The views of the table's latest day as it was when this was made; a table without a dated fix has empty views."""

    def __init__(self, spark: SparkSession, path: str):
        found = days.latest_day(spark, path)
        self.dt, self.last_time = ("", None) if found is None else (found.dt, found.last_time)
        self.fixes = read_cleaned(spark, path, self.dt)

    def kpi(self) -> DataFrame:
        return monitor.kpi_day(speed_as_written(self.fixes), self.dt)

    def latest_position(self, k: int = 500) -> DataFrame:
        return monitor.latest_position(self.fixes, k, self.dt)

    def latest_status(self) -> DataFrame:
        return monitor.status_rows(speed_as_written(monitor.latest_fix(current_day(self.fixes, self.dt))))

    def abnormal_stops(self, k: int = 30) -> DataFrame:
        """The day's latest time is known from the index, too."""
        return alerts.largest_stops(alerts.slow_groups(self.fixes), k).withColumn("time", F.lit(self.last_time))

    def area_violations(self, k: int = 500) -> DataFrame:
        return alerts.area_violations_today(self.fixes, k, self.dt)

    def gear_counts(self) -> DataFrame:
        return gear.gear_counts_today(self.fixes, self.dt)

    def speed_by_gear(self) -> DataFrame:
        return gear.speed_by_gear_today(speed_as_written(self.fixes), self.dt)

    def hour_hist(self) -> DataFrame:
        return activity.hour_hist_today(self.fixes, self.dt)

    def grid_density(self) -> DataFrame:
        return density.grid_density_today(self.fixes, self.dt)
