"""Fixes per day as a tumbling window with a watermark, and the fixes that came too late for it.

A day is closed, and its row written once, when the latest time seen lies more than the delay behind its end. Fixes of a closed day
no longer count; they are kept in a table of their own, so that nothing is lost. Both are streams over the same source; they agree if
both are run with the same steps, as `run` does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions import expressions as X
from fleetlens.streaming.generations import _found
from fleetlens.streaming.replay import run_to_end

DELAY = "1 day"
DAY_END = "date_trunc('DAY', record_time) + INTERVAL 1 DAY"


def start_closed_days(stream: DataFrame, path: str, delay: str = DELAY, trigger: dict | None = None):
    """Append (day, fixes) of every day that the watermark has passed."""
    timed = stream.select("record_time").where("record_time IS NOT NULL").withWatermark("record_time", delay)
    days = timed.groupBy(F.window("record_time", "1 day")).agg(F.count("*").alias("fixes"))
    rows = days.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "fixes")
    return (
        rows.writeStream.format("parquet").outputMode("append").option("path", f"{path}/closed")
        .option("checkpointLocation", f"{path}/_state/closed").trigger(**(trigger or {"availableNow": True})).start()
    )


def start_late_rows(stream: DataFrame, path: str, delay: str = DELAY, trigger: dict | None = None):
    """Keep the fixes whose day was closed when they came, with the batch that brought them.

    The bound is the latest time of earlier batches, of which one row a batch is stored; a repeated batch replaces its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = _found(lambda: spark.read.schema("latest timestamp, batch_id bigint").parquet(f"{path}/marks"))
        seen = None if marks is None else marks.where(F.col("batch_id") < batch_id).agg(F.max("latest").alias("latest"))
        bound = F.lit(None).cast("timestamp") if seen is None else seen.select(F.expr(f"latest - INTERVAL {delay}")).scalar()
        late = batch.where(F.coalesce(F.expr(DAY_END) <= bound, F.lit(False)))
        late.write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        latest = batch.agg(F.max("record_time").alias("latest"))
        latest.write.mode("overwrite").parquet(f"{path}/marks/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/_state/late").trigger(**(trigger or {"availableNow": True})).start()


def run(stream: Callable[[], DataFrame], path: str, delay: str = DELAY) -> None:
    """Work off what is there, in both streams."""
    run_to_end(start_closed_days(stream(), path, delay))
    run_to_end(start_late_rows(stream(), path, delay))


def closed_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("day string, fixes bigint").parquet(f"{path}/closed")


def late_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(f"{path}/late")


def late_days(late: DataFrame) -> DataFrame:
    """Late fixes per day and batch."""
    return late.groupBy(F.expr(f"CAST({X.DAY} AS STRING) AS day"), "batch_id").agg(F.count("*").alias("fixes"))
