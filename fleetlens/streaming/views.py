"""Indicators kept up to date over a stream.

Each micro-batch is appended, as mergeable summaries, under its batch number. Writing a
batch replaces that number's files, so a batch repeated after a failure is counted once. The work per batch
depends on the batch alone; results are read from the summaries at any time. Late rows need no special
care, since the summaries add up in any order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlens.functions import expressions as X
from fleetlens.operators import alerts, hull, monitor, reach
from fleetlens.operators.filters import current_day, last
from fleetlens.plans import rollup as R
from fleetlens.session import together
from fleetlens.streaming import generations

GROUP = ("vessel_id", "dt")
OF_GROUP = tuple(f"{key} AS of_{key}" for key in GROUP)
# In one streaming aggregation the texts of a fix must be among its values; the state is one row per vessel.
NEWEST = (
    "max_by(struct(record_time, point_id, x, y, speed, operation_type, sea_area, dt), struct(record_time, point_id))"
)


# Stored columns of each part, beside the folder column `batch_id`.
SCHEMAS = {
    "activity": (
        "hour int, text_hour int, vessel_id string, operation_type string, sea_area string, fixes bigint, speeds bigint, "
        "speed_sum double, speed_min double, speed_max double, first_time timestamp, last_time timestamp, "
        "slow_fixes bigint, slow_points bigint, slow_x_sum double, slow_y_sum double, dt string"
    ),
    "grid": "sea_area string, grid_x int, grid_y int, vessel_id string, fixes bigint, dt string",
    "violations": (
        "record_time timestamp, point_id bigint, vessel_id string, sea_area string, x double, y double, dt string"
    ),
    "latest": (
        "vessel_id string, record_time timestamp, point_id bigint, x double, y double, speed double, "
        "operation_type string, sea_area string, dt string"
    ),
    "reach": (
        "vessel_id string, origin struct<record_time: timestamp, point_id: bigint, x: double, y: double>, "
        "x double, y double, dt string"
    ),
    "progress": "batch bigint, fixes bigint, first_time timestamp, last_time timestamp, dt string",
}


def read_part(spark: SparkSession, path: str, name: str) -> DataFrame:
    """All batches of a part, merged or not; without rows when no batch had any."""
    return generations.read(spark, path, name, SCHEMAS[name])


def _replace(df: DataFrame, path: str, name: str, batch_id: int, shuffled: bool = True) -> None:
    """Write a part of this batch, by day. Summaries are first brought to few files per day; rows are not."""
    laid_out = df.hint("rebalance", "dt") if shuffled else df
    laid_out.write.mode("overwrite").partitionBy("dt").parquet(f"{path}/{name}/batch_id={batch_id:08d}")


# --- summaries, one writer per part --------------------------------------------------------------


def write_activity(batch: DataFrame, path: str, batch_id: int) -> None:
    _replace(R.activity_rollup(batch), path, "activity", batch_id)


def write_grid(batch: DataFrame, path: str, batch_id: int) -> None:
    _replace(R.grid_rollup(batch), path, "grid", batch_id)


def write_violations(batch: DataFrame, path: str, batch_id: int) -> None:
    rows = alerts.violating_points(batch).select("dt", "record_time", "point_id", "vessel_id", "sea_area", "x", "y")
    _replace(rows, path, "violations", batch_id, shuffled=False)


def write_latest(batch: DataFrame, path: str, batch_id: int) -> None:
    """Latest fix per vessel and day of this batch."""
    _replace(merge_latest(batch), path, "latest", batch_id)


def _firsts(points: DataFrame, origin: str) -> DataFrame:
    return points.groupBy(*X.exprs(*OF_GROUP)).agg(F.expr(f"min({origin}) AS origin"))


def write_reach(batch: DataFrame, path: str, batch_id: int) -> None:
    """The first fix of each vessel-day of this batch, and the corners of the hull of its fixes.

    Wherever the first fix of all batches turns out to be, the farthest fix from it is such a corner. So a late first fix moves
    the origin when the summaries are read; nothing written before is read or changed.
    """
    points = batch.where(X.HAS_POINT).select(*GROUP, "record_time", "point_id", "x", "y")
    firsts = _firsts(points, "struct(record_time, point_id, x, y)")
    rows = hull.corner_points(points, GROUP)
    rows = rows.join(firsts, reach.same_group(rows, firsts, GROUP)).select(*GROUP, "origin", "x", "y")
    _replace(rows, path, "reach", batch_id)


def write_progress(batch: DataFrame, path: str, batch_id: int) -> None:
    """One row: what this batch brought."""
    seen = batch.agg(*X.exprs("count(*) AS fixes", "min(record_time) AS first_time", "max(record_time) AS last_time"))
    rows = seen.select(F.lit(batch_id).cast("bigint").alias("batch"), "*", F.lit(None).cast("string").alias("dt"))
    _replace(rows, path, "progress", batch_id, shuffled=False)


PARTS: dict[str, Callable[[DataFrame, str, int], None]] = {
    "activity": write_activity,
    "grid": write_grid,
    "violations": write_violations,
    "latest": write_latest,
    "reach": write_reach,
    "progress": write_progress,
}


# --- merging of what several batches wrote for a day -----------------------------------------------


def merge_activity(rows: DataFrame) -> DataFrame:
    sums = ("fixes", "speeds", "speed_sum", "slow_fixes", "slow_points", "slow_x_sum", "slow_y_sum")
    ends = ("min(speed_min) AS speed_min", "max(speed_max) AS speed_max", "min(first_time) AS first_time", "max(last_time) AS last_time")
    keys = ("dt", "hour", "text_hour", "vessel_id", "operation_type", "sea_area")
    return rows.groupBy(*keys).agg(*X.exprs(*[f"sum({c}) AS {c}" for c in sums], *ends))


def merge_grid(rows: DataFrame) -> DataFrame:
    return rows.groupBy("dt", "sea_area", "grid_x", "grid_y", "vessel_id").agg(F.expr("sum(fixes) AS fixes"))


def merge_latest(rows: DataFrame) -> DataFrame:
    return monitor.newest(rows, ("dt", "vessel_id"), ("record_time", "point_id", "x", "y", "speed"))


def merge_reach(rows: DataFrame) -> DataFrame:
    firsts, points = _firsts(rows, "origin"), hull.corner_points(rows, GROUP)
    return points.join(firsts, reach.same_group(points, firsts, GROUP)).select(*GROUP, "origin", "x", "y")


def as_they_are(rows: DataFrame) -> DataFrame:
    return rows


MERGES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "activity": merge_activity,
    "grid": merge_grid,
    "violations": as_they_are,
    "latest": merge_latest,
    "reach": merge_reach,
    "progress": as_they_are,
}


def merge_part(spark: SparkSession, path: str, name: str, upto: int) -> int:
    """Bring the days that batches up to `upto` touched to one generation each; see `generations`."""
    return generations.merge(spark, path, name, SCHEMAS[name], upto, MERGES[name])


def maintain(
    stream: DataFrame,
    path: str,
    parts: Sequence[str] = tuple(PARTS),
    trigger: dict | None = None,
    cache: bool = False,
    merge_every: int | None = None,
) -> StreamingQuery:
    """Start keeping the named summaries under `path`, or go on where an earlier query on it stopped.

    A file source is read once per part, each time only the columns the part needs. For a source that is
    costly to read again, `cache` keeps the batch while its parts are written. After every `merge_every` batches
    the days they touched are merged, so that a day has few files however many batches bring fixes of it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if cache:
            batch.persist()
        together(lambda part: PARTS[part](batch, path, batch_id), parts)
        if cache:
            batch.unpersist()
        if merge_every and (batch_id + 1) % merge_every == 0:
            together(lambda part: merge_part(batch.sparkSession, path, part, batch_id), parts)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{path}/_state/views")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def keep_latest(stream: DataFrame, path: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the latest fix per vessel as streaming state (one row per vessel), writing the changed ones."""
    newest = stream.groupBy("vessel_id").agg(F.expr(f"{NEWEST} AS fix"))

    def write(batch: DataFrame, batch_id: int) -> None:
        _replace(batch.select("vessel_id", "fix.*"), path, "latest", batch_id)

    return (
        newest.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", f"{path}/_state/latest")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


# --- results, read from the summaries ------------------------------------------------------------


def vessel_day_range(reach_rows: DataFrame) -> DataFrame:
    """Per vessel-day: the largest distance of a corner from the earliest first fix of all batches."""
    corners, firsts = reach_rows.select(*GROUP, "x", "y"), _firsts(reach_rows, "origin")
    joined = corners.join(firsts, reach.same_group(corners, firsts, GROUP))
    return joined.groupBy(*GROUP).agg(F.expr(f"max({reach.AWAY_FROM_ORIGIN}) AS dist"))


def progress(rows: DataFrame) -> DataFrame:
    """One row per batch: its fixes, and those of all batches up to it. There are as many rows as batches."""
    upto = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select("batch", "fixes", F.sum("fixes").over(upto).alias("current"), "first_time", "last_time")


def range_vessel_day(reach_rows: DataFrame, k: int = 20) -> DataFrame:
    return reach.label_ranges(vessel_day_range(reach_rows).withColumnRenamed("dt", "day"), k)


def area_violations_today(violations: DataFrame, activity: DataFrame, k: int = 500) -> DataFrame:
    """The first violations of the last day that has fixes, which may be a day without violations."""
    return alerts.first_violations(violations.where(F.col("dt") == last(activity)), k)


def latest_status(latest: DataFrame) -> DataFrame:
    return monitor.status_rows(monitor.latest_fix(current_day(latest)))


def latest_position(latest: DataFrame, k: int = 500) -> DataFrame:
    return monitor.position_rows(monitor.latest_fix(current_day(latest)), k)
