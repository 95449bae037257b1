"""Gear mix and speed per gear."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import expressions as X
from fleetlens.operators.filters import current_day, last


def vessels_by_gear(df: DataFrame) -> DataFrame:
    return df.groupBy(F.expr("operation_type AS op_type")).agg(F.expr("count(DISTINCT vessel_id) AS cnt"))


def with_share(counts: DataFrame, count: str, digits: int) -> DataFrame:
    """Put each row's share of the total, in percent, beside its count."""
    share = X.half_up(f"try_divide({count} * 100D, CAST(total AS DOUBLE))", digits)
    totalled = counts.withColumn("total", last(counts, f"sum({count})"))
    return totalled.selectExpr(*counts.columns, f"{share} AS share")


def gear_share(df: DataFrame) -> DataFrame:
    """Fixes per gear with their share in percent; fixes without a gear take no part."""
    counts = df.where("operation_type IS NOT NULL").groupBy("operation_type").agg(F.expr("count(*) AS cnt"))
    return with_share(counts, "cnt", 1)


def gear_counts_today(df: DataFrame, as_of: str | None = None) -> DataFrame:
    gear = F.expr(f"{X.label_if_blank('operation_type')} AS name")
    return current_day(df, as_of).groupBy(gear).agg(F.expr("count(*) AS value"))


def gear_share_today(df: DataFrame, as_of: str | None = None) -> DataFrame:
    return with_share(gear_counts_today(df, as_of), "value", 2)


def speed_by_gear(df: DataFrame) -> DataFrame:
    return df.groupBy(F.expr("operation_type AS op_type")).agg(
        *X.exprs(
            f"{X.half_up('avg(speed)', 2)} AS avg_speed",
            f"{X.half_up('max(speed)', 2)} AS max_speed",
            f"{X.half_up('min(speed)', 2)} AS min_speed",
            "count(*) AS cnt",
        )
    )


def speed_stats_gear(df: DataFrame) -> DataFrame:
    """Unrounded mean, minimum, maximum and sample deviation; fixes without a gear take no part."""
    return (
        df.where("operation_type IS NOT NULL")
        .groupBy("operation_type")
        .agg(
            *X.exprs(
                "avg(speed) AS mean_speed",
                "min(speed) AS min_speed",
                "max(speed) AS max_speed",
                "stddev_samp(speed) AS std_speed",
            )
        )
    )


def speed_by_gear_today(df: DataFrame, as_of: str | None = None) -> DataFrame:
    gear = F.expr(f"{X.label_if_blank('operation_type')} AS type")
    means = current_day(df, as_of).groupBy(gear).agg(F.expr(f"{X.half_up('avg(speed)', 2)} AS value"))
    return means.orderBy(F.desc("value"), "type")
