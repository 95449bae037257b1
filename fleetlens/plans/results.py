"""The ten offline results, and their sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlens import schema as S
from fleetlens.operators import alerts, reach
from fleetlens.plans import rollup as R
from fleetlens.session import together
from fleetlens.sources import catalog

RESULT_NAMES = tuple(S.RESULT_TABLES)


def ten_results(df: DataFrame, activity: DataFrame, grid: DataFrame) -> dict[str, DataFrame]:
    """All ten results. Eight come from the two summaries; only range and violations scan the fixes."""
    stops = R.abnormal_stop(activity)
    frames = (
        R.grid_density(grid),
        R.vessels_by_gear(activity),
        R.hour_hist(activity),
        R.work_hours(activity),
        R.days_at_sea(activity),
        R.speed_by_gear(activity),
        R.daily_points(activity),
        reach.max_range(df),
        alerts.stop_record(stops),
        alerts.area_violations(df),
    )
    return dict(zip(RESULT_NAMES, frames, strict=True))


def build_summaries(df: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write the activity and grid summaries per day and read them back.

    Days already summarised and not in `df` are kept, so a daily run only scans the new days.
    """
    frames = {"activity": R.activity_rollup(df), "grid": R.grid_rollup(df)}

    def write(name: str) -> None:
        laid_out = frames[name].hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt")
        laid_out.option("partitionOverwriteMode", "dynamic").parquet(f"{path}/{name}")

    together(write, frames)
    read = {name: df.sparkSession.read.schema(f.schema).parquet(f"{path}/{name}") for name, f in frames.items()}
    return read["activity"], read["grid"]


def write_results(results: dict[str, DataFrame], path: str) -> None:
    """One folder of delimited text per result, replaced as a whole: a rerun leaves the same rows.

    The writes are submitted together, so that the small results fill the gaps the large ones leave.
    """

    def write(name: str) -> None:
        results[name].write.mode("overwrite").option("header", True).csv(f"{path}/{name}")

    together(write, results)


def run_offline(df: DataFrame, path: str) -> dict[str, DataFrame]:
    """Summaries, ten results, sinks; returns the results as read back from their folders."""
    activity, grid = build_summaries(df, f"{path}/summary")
    results = ten_results(df, activity, grid)
    write_results(results, path)
    spark = df.sparkSession
    return {
        name: spark.read.schema(frame.schema).option("header", True).csv(f"{path}/{name}")
        for name, frame in results.items()
    }


def sink_audit(written: dict[str, DataFrame]) -> DataFrame:
    """Rows per result folder."""
    counts = [frame.selectExpr(f"'{name}' AS result", "count(*) AS row_count") for name, frame in written.items()]
    audit = counts[0]
    for count in counts[1:]:
        audit = audit.unionAll(count)
    return audit


def publish(df: DataFrame, database: str, location: str) -> None:
    """Replace the declared result tables with the ten results of the days in `df` and those summarised before under `location`."""
    spark = df.sparkSession
    catalog.create_result_tables(spark, database, location)
    results = ten_results(df, *build_summaries(df, f"{location}/summary"))
    together(lambda name: catalog.replace_result(spark, database, location, name, results[name]), results)


# What identifies a row of each result; the other columns are its measures.
LABELS = {
    "ads_result001": ("sea_area", "grid_x", "grid_y"), "ads_result002": ("op_type",), "ads_result003": ("hour_val",),
    "ads_result004": ("vessel_id", "work_date"), "ads_result005": ("vessel_id",), "ads_result006": ("op_type",),
    "ads_result007": ("work_date",), "ads_result008": ("vessel_id",), "ads_result009": ("vessel_id", "start_time", "end_time"),
    "ads_result010": ("vessel_id", "sea_area", "ts"),
}


def published_values(spark: SparkSession, database: str) -> DataFrame:
    """All measures of the declared result tables: (result, label, measure, value), with NULL and empty labels told apart."""
    frames = []
    for name, keys in LABELS.items():
        table = spark.table(f"{database}.{name}")
        label = "concat_ws('|', " + ", ".join(f"coalesce(CAST({k} AS STRING), 'NULL')" for k in keys) + ")"
        pairs = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in table.columns if c not in keys)
        count = len(table.columns) - len(keys)
        frames.append(table.selectExpr(f"'{name}' AS result", f"{label} AS label", f"stack({count}, {pairs}) AS (measure, value)"))
    values = frames[0]
    for frame in frames[1:]:
        values = values.unionAll(frame)
    return values
