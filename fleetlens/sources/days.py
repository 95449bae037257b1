"""The day index of the cleaned table: what each day holds, kept by the writer, so that no scan is needed to find the latest day.

The index lies beside the table's days in folders that readers of the table pass over. It has one row per day, and one per second
with fixes, by which the place of a fix in time order is found; a write replaces the rows of the days it wrote, and of these alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetlens import schema as S
from fleetlens.functions import expressions as X

FOLDER, SECONDS = "_days", "_seconds"
SCHEMA = "fixes bigint, timed bigint, first_time timestamp, last_time timestamp, dt string"


def written_days(frame: DataFrame) -> tuple[DataFrame, Observation]:
    """`frame`, and what tells after it was written which days it had. The days are partitions of the table, so they are few."""
    seen = Observation("written days")
    return frame.observe(seen, F.collect_set("dt").alias("days"), F.count_if(F.col("dt").isNull()).alias("dateless")), seen


def record(spark: SparkSession, path: str, seen: Observation) -> None:
    """Replace the index rows of the days just written; only their folders are read, and of these the time alone."""
    found = seen.get
    days = F.col("dt").isin(*found["days"]) if found["days"] else F.lit(False)
    if found["dateless"]:
        days = days | F.col("dt").isNull()
    _write(spark.read.schema(S.CLEANED_SCHEMA).parquet(path).where(days), path)


def rebuild(spark: SparkSession, path: str) -> None:
    """The index of a table that another writer has filled."""
    _write(spark.read.schema(S.CLEANED_SCHEMA).parquet(path), path)


def _write(rows: DataFrame, path: str) -> None:
    """Seconds first, then the days from them."""
    spark = rows.sparkSession

    def replace(df: DataFrame, folder: str) -> None:
        few = df.repartition("dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        few.partitionBy("dt").parquet(f"{path}/{folder}")

    days = [row.dt for row in rows.select("dt").distinct().collect()]
    replace(rows.groupBy("dt", "event_time").agg(F.count("*").alias("fixes")), SECONDS)
    held = [dt for dt in days if dt is not None]
    written = second_index(spark, path).where(F.col("dt").isin(held) | (F.col("dt").isNull() if None in days else F.lit(False)))
    ends = X.exprs("sum(fixes) AS fixes", "coalesce(sum(fixes) FILTER (WHERE event_time IS NOT NULL), 0L) AS timed")
    replace(written.groupBy("dt").agg(*ends, *X.exprs("min(event_time) AS first_time", "max(event_time) AS last_time")), FOLDER)


def second_index(spark: SparkSession, path: str) -> DataFrame:
    """(event_time, fixes, dt): how many fixes each second of a day has, at most 86,400 rows a day."""
    return spark.read.schema("event_time timestamp, fixes bigint, dt string").parquet(f"{path}/{SECONDS}")


def day_index(spark: SparkSession, path: str) -> DataFrame:
    """(dt, fixes, timed, first_time, last_time): one row per day of the table; `timed` fixes have a time."""
    return spark.read.schema(SCHEMA).parquet(f"{path}/{FOLDER}").select("dt", "fixes", "timed", "first_time", "last_time")


@dataclass(frozen=True)
class Day:
    """A day of the table, with its latest time as text."""

    dt: str
    fixes: int
    last_time: str | None


def latest_day(spark: SparkSession, path: str) -> Day | None:
    """The latest date of the table by its index; None without one."""
    newest = day_index(spark, path).where(F.expr(X.DATED).isNotNull()).orderBy(F.desc("dt")).limit(1)
    row = newest.selectExpr("dt", "fixes", f"{X.time_text('last_time')} AS last_time").first()
    return None if row is None else Day(*row)
