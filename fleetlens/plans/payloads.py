"""Results as JSON for a chart front end: a list of objects, or one object of parallel arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from fleetlens.operators import activity, alerts, density, gear, monitor, reach
from fleetlens.operators.filters import current_day, last
from fleetlens.plans import rollup as R
from fleetlens.session import checkpointed

# As in the published payloads, a missing value is an explicit null.
KEEP_NULLS = "map('ignoreNullFields', 'false')"


def row_payload(df: DataFrame) -> DataFrame:
    """One JSON object per row: stays distributed, and an array file of any length can be written from it."""
    return df.selectExpr(f"to_json(struct({', '.join(df.columns)}), {KEEP_NULLS}) AS payload")


def array_payload(df: DataFrame, order: Sequence[str], **arrays: str) -> DataFrame:
    """One JSON object of parallel arrays, `name=column`, in the given order. It is one row, meant for charts."""
    entry = ", ".join([f"{text} AS o{i}" for i, text in enumerate(order)] + list(arrays.values()))
    columns = ", ".join(f"rows.{column} AS {name}" for name, column in arrays.items())
    listed = df.selectExpr(f"sort_array(collect_list(struct({entry}))) AS rows")
    return listed.selectExpr(f"to_json(struct({columns}), {KEEP_NULLS}) AS payload")


def summary(df: DataFrame, day: DataFrame) -> DataFrame:
    """Day and month figures side by side, from the same rows."""
    month = monitor.kpi_month(df)
    figures = last(month, f"any_value(struct({', '.join(month.columns)}))")
    return monitor.kpi_day(day).withColumn("m", figures).select("*", "m.*").drop("m")


def row_payloads(df: DataFrame) -> dict[str, DataFrame]:
    """The payloads that are lists of objects, by name.

    The current day's rows are stored once; only the month figures go back to the whole table.
    """
    day = checkpointed(current_day(df))
    frames = {
        "sea-grid-heatmap": density.grid_density_today(day),
        "worktype-ratio": gear.gear_counts_today(day),
        "abnormal-stop-points": alerts.abnormal_stop_today(day),
        "cross-border": alerts.area_violations_today(day),
        "ship-locations": monitor.latest_position(day),
        "latest-boats": monitor.latest_status(day),
        "summary": summary(df, day),
    }
    return {name: row_payload(frame) for name, frame in frames.items()}


def array_payloads(df: DataFrame) -> dict[str, DataFrame]:
    """The payloads that are objects of parallel arrays, by name.

    Three of the cumulative ones share one stored summary per vessel and day.
    """
    days = checkpointed(R.vessel_day_rollup(df))
    ships = {"ships": "ship", "values": "value"}
    return {
        "peak-hour": array_payload(activity.hour_hist_today(df), ["CAST(hour AS INT)"], hours="hour", values="value"),
        "work-duration-dist": array_payload(R.work_hours_buckets(days), ["ord"], ranges="range", values="value"),
        "ship-top20": array_payload(R.top_vessels(days), ["-value", "ship"], **ships),
        "avg-speed": array_payload(gear.speed_by_gear_today(df), ["-value", "type"], types="type", values="value"),
        "daily-points": array_payload(R.last_days(days), ["date"], dates="date", values="value"),
        "max-distance-top20": array_payload(reach.range_vessel_day(df, 20, "dist"), ["-dist", "ship"], **ships),
    }


def tagged(payloads: dict[str, DataFrame]) -> DataFrame:
    """All payloads in one frame, with their names beside them."""
    parts = [frame.selectExpr(f"'{name}' AS name", "payload") for name, frame in payloads.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


def write_payloads(payloads: dict[str, DataFrame], path: str) -> None:
    """One folder of JSON lines per payload, replaced as a whole."""
    for name, frame in payloads.items():
        frame.write.mode("overwrite").text(f"{path}/{name}")
