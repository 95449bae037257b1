"""Day and month key figures, latest fix per vessel, and map layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens import schema as S
from fleetlens.functions import expressions as X
from fleetlens.operators.filters import current_day, current_month, last


# Cell of a fix; cells are equal if both numbers are, so that one text stands for both.
CELL = f"IF({X.HAS_CELL}, concat_ws('|', {X.grid_index('x')}, {X.grid_index('y')}), NULL)"


def _figures(rows: DataFrame, points: str, ships: str, speed: str, grids: str) -> DataFrame:
    return rows.selectExpr(
        f"count(*) AS {points}",
        f"count(DISTINCT vessel_id) AS {ships}",
        f"coalesce({X.half_up('avg(speed)', 1)}, 0D) AS {speed}",
        f"count(DISTINCT {CELL}) AS {grids}",
    )


def kpi_day(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Day figures, from one scan: fixes are grouped by vessel and area, by vessel, and by cell at the same time."""
    fixes = current_day(df, as_of).selectExpr("vessel_id", f"{X.label_if_blank('sea_area')} AS area", f"{CELL} AS cell", "speed", f"{X.IS_SLOW} AS slow")
    by_area, by_vessel, by_cell = (F.col("vessel_id"), F.col("area")), (F.col("vessel_id"),), (F.col("cell"),)
    groups = fixes.groupingSets([by_area, by_vessel, by_cell], "vessel_id", "area", "cell").agg(
        F.expr("CASE grouping_id() WHEN 1 THEN 'area' WHEN 3 THEN 'vessel' ELSE 'cell' END AS kind"),
        *X.exprs("count(*) AS fixes", "count(speed) AS speeds", "sum(speed) AS speed_sum", "count_if(slow) AS slow_fixes"),
    )
    mean = "try_divide(sum(speed_sum) FILTER (WHERE kind = 'area'), CAST(sum(speeds) FILTER (WHERE kind = 'area') AS DOUBLE))"
    return groups.selectExpr(
        "coalesce(sum(fixes) FILTER (WHERE kind = 'area'), 0L) AS total_points",
        "count_if(kind = 'vessel' AND vessel_id IS NOT NULL) AS total_ships",
        f"coalesce({X.half_up(mean, 1)}, 0D) AS avg_speed",
        "count_if(kind = 'cell' AND cell IS NOT NULL) AS hot_grid_count",
        f"count_if(kind = 'area' AND slow_fixes >= {S.MIN_STOP_FIXES}) AS abnormal_count",
    )


def kpi_month(df: DataFrame, as_of: str | None = None) -> DataFrame:
    names = ("monthly_points", "monthly_ships", "monthly_avg_speed", "monthly_hot_grid_count")
    return _figures(current_month(df, as_of), *names)


def newest(df: DataFrame, keys: tuple[str, ...], numbers: tuple[str, ...]) -> DataFrame:
    """The last fix per `keys` by (record_time, point_id): keys, `numbers`, and the texts of the fix; from one scan, by hash.

    An aggregation by hash keeps numbers alone. So the texts are first among its keys, of which a vessel has few: what is left
    then is a row per vessel and pair of texts, and only those rows are sorted.
    """
    texts = ("operation_type", "sea_area")
    ranked = df.selectExpr(*keys, *texts, *numbers, f"{X.TIME_RANK} AS time_rank")
    last_of = [f"max_by({number}, time_rank) AS {number}" for number in numbers]
    by_texts = ranked.groupBy(*keys, *texts).agg(*X.exprs(*last_of, "max(time_rank) AS time_rank"))
    fix = f"max_by(struct({', '.join((*numbers, *texts))}), time_rank) AS fix"
    return by_texts.groupBy(*keys).agg(F.expr(fix)).select(*keys, "fix.*")


def latest_fix(df: DataFrame) -> DataFrame:
    """The last fix per vessel by (record_time, point_id)."""
    return newest(df, ("vessel_id",), ("record_time", "x", "y", "speed"))


def position_rows(latest: DataFrame, k: int = 500) -> DataFrame:
    return (
        latest.orderBy("vessel_id")
        .limit(k)
        .selectExpr(
            "vessel_id AS ship_id",
            "coalesce(x, 0D) AS x",
            "coalesce(y, 0D) AS y",
            f"{X.label_if_blank('operation_type')} AS work_type",
            f"{X.label_if_blank('sea_area')} AS sea_area",
        )
    )


def status_rows(latest: DataFrame) -> DataFrame:
    """Latest fixes, newest first."""
    return latest.orderBy(F.desc("record_time"), "vessel_id").selectExpr(
        "vessel_id AS ship",
        f"{X.label_if_blank('sea_area')} AS area",
        f"coalesce({X.half_up('speed', 1)}, 0D) AS speed",
        f"{X.WORK_STATUS} AS status",
        f"{X.time_text('record_time')} AS time",
    )


def latest_position(df: DataFrame, k: int = 500, as_of: str | None = None) -> DataFrame:
    return position_rows(latest_fix(current_day(df, as_of)), k)


def latest_status(df: DataFrame, as_of: str | None = None) -> DataFrame:
    return status_rows(latest_fix(current_day(df, as_of)))


def speed_bands(status: DataFrame) -> DataFrame:
    return status.selectExpr("ship", "speed", f"{X.SPEED_BAND} AS band")


def map_positions(positions: DataFrame) -> DataFrame:
    """Positions as percent of the padded extent of all of them, kept within 0 and 100.

    The extent leaves out (0, 0) unless there is nothing else; a span below 0.1 is widened by 0.5 each way.
    """
    known = "FILTER (WHERE x <> 0D OR y <> 0D)"
    ends = ", ".join(
        f"coalesce({end}({axis}) {known}, {end}({axis})) AS {axis}_{end}" for axis in ("x", "y") for end in ("min", "max")
    )
    placed = positions.withColumn("e", last(positions, f"struct({ends})"))
    padded = []
    for axis in ("x", "y"):
        low, high = f"e.{axis}_min", f"e.{axis}_max"
        widen = f"IF({high} - {low} < 0.1D, 0.5D, 0D)"
        padded += [f"{low} - {widen} AS {axis}0", f"({high} - {low} + 2 * {widen}) AS {axis}_span"]
    placed = placed.selectExpr("ship_id", "work_type", "x", "y", *padded)

    def percent(axis: str) -> str:
        share = f"try_divide({axis} - ({axis}0 - {axis}_span * 0.1D), {axis}_span * 1.2D) * 100D"
        return f"least(100D, greatest(0D, {share}))"

    return placed.selectExpr("ship_id", "work_type", f"{percent('x')} AS left_pct", f"{percent('y')} AS top_pct")
