"""The first fixes of the cleaned table in time order, found by the index of its days and seconds."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions import expressions as X
from fleetlens.operators.filters import cut_by_counts
from fleetlens.sources import days
from fleetlens.sources.cleaned import as_trajectory
from fleetlens import schema as S


def table_prefix(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first `n` fixes by (time, id). The index tells the day and the second of the last one; of the fixes, only those of that
    second are read to find its id. The result scans the folders up to that day, and those that hold fixes without a time.
    """
    index = days.day_index(spark, path)
    timed = index.where("timed > 0").selectExpr("CAST(dt AS DATE) AS step", "timed AS count")
    counts = index.selectExpr("CAST(NULL AS DATE) AS step", "fixes - timed AS count").groupBy("step").agg(F.sum("count").alias("count"))
    counts = counts.where("count > 0").unionAll(timed)

    def seconds(day: date) -> DataFrame:
        return days.second_index(spark, path).where((F.col("dt") == str(day)) & F.col("event_time").isNotNull()).selectExpr("event_time AS step", "fixes AS count")

    # The days up to the last fix's, and those with fixes without a time; both lists are as long as the calendar.
    upto = counts.orderBy("step").collect()
    total, last = 0, None
    for row in upto:
        last = row.step
        total += row["count"]
        if total >= n:
            break
    untimed = [row.dt for row in index.where("fixes > timed").select("dt").collect()]
    chosen = F.col("dt").isin([d for d in untimed if d is not None]) | (F.col("dt").isNull() if None in untimed else F.lit(False))
    if last is not None:
        dated = F.expr(X.DATED)
        chosen = F.coalesce(chosen, F.lit(False)) | F.coalesce(dated <= str(last), F.lit(False))
    table = as_trajectory(spark.read.schema(S.CLEANED_SCHEMA).parquet(path).where(chosen))
    return cut_by_counts(table, n, counts, seconds)
